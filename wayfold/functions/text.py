"""Column functions on identifiers, names and service classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of regions, scopes and defaults.
OUTSIDE, UNMATCHED = "Outside Berlin-Brandenburg", "Unmatched/unknown"
REGIONS = ("Berlin", "Brandenburg")
ALL_REGIONS, ALL_MODES = "All regions", "All modes"
UNKNOWN_MODE, UNKNOWN_AGENCY, UNNAMED = "Unknown mode", "Unknown agency", "Unnamed route"

# Route type codes and their transport modes, of events and of routes.
EVENT_MODES = {3: "Bus", 100: "Regional rail", 106: "Regional rail", 109: "S-Bahn", 400: "U-Bahn", 700: "Bus", 900: "Tram"}
ROUTE_MODES = {0: "Tram", 1: "Subway", 2: "Rail", 3: "Bus", 4: "Ferry", 100: "Railway", 109: "Suburban rail", 400: "Urban railway", 700: "Bus", 900: "Tram"}
# Service categories by start of the short name.
RAIL_CATEGORIES = (("RB%", "Regionalbahn (RB)"), ("RE%", "Regional-Express (RE)"), ("FEX", "Flughafen-Express (FEX)"))
BUS_CATEGORIES = (("M%", "MetroBus (M)"), ("X%", "ExpressBus (X)"), ("N%", "NightBus (N)"))


def mode_of(route_type: Column, modes: dict[int, str] = EVENT_MODES, other: str = "Needs review") -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in modes.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, route_type), F.lit(other))


def _by_name(name: Column, table: tuple[tuple[str, str], ...], other: str) -> Column:
    out = F.lit(None).cast("string")
    for pattern, label in table[::-1]:
        out = F.when(name.like(pattern), F.lit(label)).otherwise(out)
    return F.coalesce(out, F.lit(other))


def service_category(route_type: Column, short_name: Column) -> Column:
    """The finer class: by name within regional rail and bus, else the mode's."""
    name, mode = F.upper(F.coalesce(short_name, F.lit(""))), mode_of(route_type)
    rail, bus = _by_name(name, RAIL_CATEGORIES, "Other regional rail"), _by_name(name, BUS_CATEGORIES, "Numbered bus route")
    return F.when(mode == "Regional rail", rail).when(mode == "Bus", bus).otherwise(mode)


def display_name(short: Column, long: Column, route_id: Column) -> Column:
    return F.coalesce(F.nullif(short, F.lit("")), F.nullif(long, F.lit("")), route_id)


def static_route_id(route_id: Column) -> Column:
    """Realtime route ids have hyphens where static ones have underscores."""
    return F.replace(route_id, F.lit("-"), F.lit("_"))


def normal_stop_id(stop_id: Column) -> Column:
    """The third part of a namespaced id, or the id, without leading zeros."""
    part = F.when(stop_id.contains(":"), F.split_part(stop_id, F.lit(":"), F.lit(3))).otherwise(stop_id)
    return F.ltrim(part, F.lit("0"))


def service_key(mode: Column, agency: Column, name: Column) -> Column:
    return F.concat_ws("|", F.coalesce(mode, F.lit(UNKNOWN_MODE)), F.coalesce(agency, F.lit(UNKNOWN_AGENCY)), F.coalesce(name, F.lit(UNNAMED)))


def station_display(region: Column, station: Column) -> Column:
    """``Berlin, X`` becomes ``X (Berlin)`` within Berlin."""
    city = REGIONS[0]
    return F.when((region == city) & station.ilike(f"{city}, %"), F.concat(F.substr(station, F.lit(len(city) + 3)), F.lit(f" ({city})"))).otherwise(station)


def berlin_time(utc: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit("Europe/Berlin"), utc.cast("timestamp_ntz"))


def enum_name(number: Column, names: dict[int, str]) -> Column:
    """The name of an enumerated value, null for one that has none."""
    pairs = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.try_element_at(pairs, number.cast("int"))


def as_number(text: Column) -> Column:
    """A number, or null where the text is none."""
    return text.try_cast("decimal(38,0)")

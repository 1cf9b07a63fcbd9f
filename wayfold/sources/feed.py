"""Realtime feed messages: decoding from and encoding to their wire format.

The field numbers are those of the public specification; only the fields that the
tables use are read, and any other field is skipped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the enumerated relationships.
TRIP_RELATIONSHIPS = {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED"}
STOP_RELATIONSHIPS = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}

STOP_ROWS = (
    "entity_id string, trip_id string, route_id string, direction_id int, start_date string, stop_id string, stop_sequence int, stop_schedule_relationship string, "
    "arrival_delay_seconds bigint, arrival_time bigint, departure_delay_seconds bigint, departure_time bigint"
)
TRIP_ROWS = (
    "entity_id string, trip_id string, route_id string, direction_id int, start_date string, start_time string, trip_schedule_relationship string, vehicle_id string, "
    "trip_update_time bigint, trip_delay_seconds bigint, stop_time_update_count bigint"
)
FEED_ROWS = (
    "feed_time bigint, gtfs_realtime_version string, entity_count bigint, trip_update_count bigint, stop_time_update_count bigint, vehicle_position_count bigint, "
    "alert_count bigint, deleted_entity_count bigint"
)
#: The three row sets of a message. Here an absent relationship of a stop is null too.
ROW_SETS = {"feed": FEED_ROWS, "trip": TRIP_ROWS, "stop": STOP_ROWS + ", arrival_uncertainty_seconds bigint, departure_uncertainty_seconds bigint"}


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise ValueError("a number is cut off")
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message; a value is a whole number or bytes."""
    at = 0
    while at < len(data):
        value, tag, at = _field(data, at)
        yield tag >> 3, value


def message(data: bytes) -> dict[int, list]:
    """The values of each field, as ``fields`` gives them; what nearly all fields are,
    numbers and lengths of one byte or two, is read in place."""
    out: dict[int, list] = {}
    at, end = 0, len(data)
    while at < end:
        tag = data[at]
        # kinds 0 and 2
        if tag < 0x80 and not tag & 5 and at + 1 < end and ((value := data[at + 1]) < 0x80 or at + 2 < end and data[at + 2] < 0x80):
            at += 2
            if value >= 0x80:
                value, at = value & 0x7F | data[at] << 7, at + 1
            if tag & 2:
                if at + value > end:
                    raise ValueError("a field is cut off")
                value, at = data[at : at + value], at + value
        else:
            value, tag, at = _field(data, at)
        k = tag >> 3
        if k in out:
            out[k].append(value)
        else:
            out[k] = [value]
    return out


def _field(data: bytes, at: int) -> tuple[int | bytes, int, int]:
    """The value and tag of the field that begins at a place, and where it ends."""
    tag, at = _varint(data, at)
    kind = tag & 7
    if kind == 0:
        value, at = _varint(data, at)
        return value, tag, at
    if kind == 2:
        size, at = _varint(data, at)
    elif kind in (1, 5):
        size = 8 if kind == 1 else 4
    else:
        raise ValueError(f"unknown kind of field: {kind}")
    if at + size > len(data):
        raise ValueError("a field is cut off")
    return data[at : at + size], tag, at + size


def _signed(value: int | None) -> int | None:
    return value - (1 << 64) if value is not None and value >> 63 else value


def _text(m: dict, k: int) -> str | None:
    return m[k][-1].decode() if k in m else None


def _number(m: dict, k: int) -> int | None:
    return _signed(m[k][-1]) if k in m else None


#: Of many feeds' stops, events and vehicles few differ; so many that stand again aren't
#: read again.
_KEPT = 65_536


@lru_cache(_KEPT)
def _event_of(data: bytes) -> tuple[int | None, int | None, int | None]:
    own = message(data)
    return _number(own, 1), _number(own, 2), _number(own, 3)


def _event(m: dict, k: int) -> tuple[int | None, int | None, int | None]:
    return _event_of(m[k][-1]) if k in m else (None, None, None)


@lru_cache(_KEPT)
def _stop_of(data: bytes) -> tuple:
    """What a stop's row has beside its trip."""
    s = message(data)
    arrival, departure = _event(s, 2), _event(s, 3)
    return (_text(s, 4), _number(s, 1), STOP_RELATIONSHIPS.get(_number(s, 5)), *arrival[:2], *departure[:2], arrival[2], departure[2])


@lru_cache(_KEPT)
def _first_text(data: bytes) -> str | None:
    return _text(message(data), 1)


def snapshot_rows(data: bytes) -> dict[str, list[tuple]]:
    """Rows of each of ROW_SETS; a field that is absent is null, and never zero.
    Entities marked deleted keep their rows."""
    trips, stops = [], []
    whole = message(data)
    entities = [message(x) for x in whole.get(2, [])]
    for e in entities:
        if 3 not in e:
            continue
        update = message(e[3][-1])
        trip = message(update[1][-1]) if 1 in update else {}
        vehicle = _first_text(update[3][-1]) if 3 in update else None
        own = (_text(e, 1), _text(trip, 1), _text(trip, 5), _number(trip, 6), _text(trip, 3))
        updates = update.get(2, [])
        trips.append((*own, _text(trip, 2), TRIP_RELATIONSHIPS.get(_number(trip, 4)), vehicle, _number(update, 4), _number(update, 5), len(updates)))
        for raw in updates:
            stops.append(own + _stop_of(raw))
    header = message(whole[1][-1]) if 1 in whole else {}
    counts = _kinds(entities)
    row = (_number(header, 3), _text(header, 1), counts["entity_count"], len(trips), len(stops), *[counts[k] for k in ("vehicle_position_count", "alert_count", "deleted_entity_count")])
    return {"feed": [row], "trip": trips, "stop": stops}


def stop_rows(data: bytes) -> Iterator[tuple]:
    """Rows of STOP_ROWS, where an absent relationship is the scheduled one."""
    for row in snapshot_rows(data)["stop"]:
        yield (*row[:7], row[7] or STOP_RELATIONSHIPS[0], *row[8:12])


def entity_counts(data: bytes) -> dict[str, int]:
    """Numbers of entities of each kind in one message."""
    return _kinds([message(x) for x in message(data).get(2, [])])


def _kinds(entities: list[dict[int, list]]) -> dict[str, int]:
    trips = vehicles = alerts = deleted = 0
    for e in entities:
        trips += 3 in e
        vehicles += 4 in e
        alerts += 5 in e
        deleted += 2 in e and bool(_number(e, 2))
    return {"entity_count": len(entities), "trip_update_count": trips, "vehicle_position_count": vehicles, "alert_count": alerts, "deleted_entity_count": deleted}


# The fields whose presence is counted.
PROFILED = (
    "trip.trip_id trip.start_time trip.start_date trip.schedule_relationship trip.route_id trip.direction_id trip_update.vehicle trip_update.vehicle_id trip_update.timestamp trip_update.delay "
    "stop_time_update.stop_sequence stop_time_update.stop_id stop_time_update.arrival stop_time_update.departure stop_time_update.schedule_relationship "
    "arrival.delay arrival.time arrival.uncertainty departure.delay departure.time departure.uncertainty"
).split()
_TRIP = dict(enumerate("trip_id start_time start_date schedule_relationship route_id direction_id".split(), 1))
_EVENT = dict(enumerate("delay time uncertainty".split(), 1))


@lru_cache(_KEPT)
def _names(data: bytes) -> tuple[int, ...]:
    return tuple(message(data))


@lru_cache(_KEPT)
def _stop_shape(data: bytes) -> tuple:
    stop = message(data)
    return (tuple(stop), _number(stop, 5), *(_names(stop[k][-1]) if k in stop else () for k in (2, 3)))


def _shapes(data: bytes) -> tuple[dict[str, int], list[tuple], list[tuple]]:
    """Entities of one message by kind, and of each trip update and each of its stops
    which fields it has and what its relationship is."""
    entities = [message(x) for x in message(data).get(2, [])]
    trips, stops = [], []
    for e in entities:
        if 3 not in e:
            continue
        update = message(e[3][-1])
        trip = message(update[1][-1]) if 1 in update else {}
        vehicle = 3 in update and 1 in _names(update[3][-1])
        trips.append((tuple(trip), _number(trip, 4), tuple(update), vehicle))
        stops += map(_stop_shape, update.get(2, []))
    return _kinds(entities), trips, stops


def _by_name(kinds: dict[str, int], trips: Counter, stops: Counter) -> Counter:
    """Counts by (kind, name) of counted shapes, of which there are few."""
    out = Counter({("total", k): n for k, n in kinds.items()})
    for (trip, relation, update, vehicle), n in trips.items():
        for name in (name for k, name in _TRIP.items() if k in trip):
            out["field", f"trip.{name}"] += n
        if 4 in trip:
            out["relationship", f"trip.{TRIP_RELATIONSHIPS.get(relation)}"] += n
        for name in (name for k, name in ((3, "vehicle"), (4, "timestamp"), (5, "delay")) if k in update):
            out["field", f"trip_update.{name}"] += n
        out["field", "trip_update.vehicle_id"] += n * vehicle
    for (stop, relation, *events), n in stops.items():
        out["total", "stop_time_update_count"] += n
        for name in (name for k, name in ((1, "stop_sequence"), (2, "arrival"), (3, "departure"), (4, "stop_id"), (5, "schedule_relationship")) if k in stop):
            out["field", f"stop_time_update.{name}"] += n
        for name, own in zip(("arrival", "departure"), events):
            for part in (part for k, part in _EVENT.items() if k in own):
                out["field", f"{name}.{part}"] += n
        if 5 in stop:
            out["relationship", f"stop_time_update.{STOP_RELATIONSHIPS.get(relation)}"] += n
    return +out


def profile_counts(data: bytes) -> Counter:
    """Counts by (kind, name) in one message: entities (``total``), fields that are
    there (``field``) and relationships by name (``relationship``)."""
    kinds, trips, stops = _shapes(data)
    return _by_name(kinds, Counter(trips), Counter(stops))


def profile(messages: DataFrame, content: str = "content") -> DataFrame:
    """``kind, name, n`` over all messages. One that doesn't parse or isn't there is
    counted as (``total``, ``snapshots_failed``) and no more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done: Counter = Counter()
            totals, trips, stops = Counter(), Counter(), Counter()
            for data in values(batch.column(0)):
                try:
                    if data is None:
                        raise ValueError("no message")
                    kinds, own_trips, own_stops = _shapes(data)
                except ValueError:
                    done["total", "snapshots_failed"] += 1
                    continue
                done["total", "snapshots_profiled"] += 1
                # only of messages that parse whole
                for into, own in ((trips, own_trips), (stops, own_stops)):
                    for shape in own:
                        into[shape] += 1
                for k, n in kinds.items():
                    totals[k] += n
            found = _by_name(totals, trips, stops) + done
            rows = [(*k, n) for k, n in (+found).items()]
            kinds, names, n = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(names, pa.string()), pa.array(n, pa.int64())], ["kind", "name", "n"])

    counts = messages.select(content).mapInArrow(run, "kind string, name string, n bigint")
    return counts.groupBy("kind", "name").agg(F.sum("n").alias("n"))


def field_availability(messages: DataFrame, content: str = "content") -> DataFrame:
    """``field, present, denominator, percentage`` of every profiled field: of trips for
    the fields of trips and their updates, of stop updates for all others; four
    decimals, and 0.0 where there is nothing to count."""
    spark = messages.sparkSession
    counts = profile(messages, content)
    total = lambda name: F.coalesce(F.sum(F.when((F.col("kind") == "total") & (F.col("name") == name), F.col("n"))), F.lit(0))
    fields = F.map_from_entries(F.collect_list(F.when(F.col("kind") == "field", F.struct("name", "n"))))  # at most PROFILED entries
    wide = counts.agg(total("trip_update_count").alias("trips"), total("stop_time_update_count").alias("stops"), fields.alias("fields"))
    names = spark.createDataFrame([(x,) for x in PROFILED], "field string")
    rows = names.crossJoin(wide)  # a single row
    of_trip = F.col("field").startswith("trip.") | F.col("field").startswith("trip_update.")
    rows = rows.select("field", F.coalesce(F.try_element_at("fields", F.col("field")), F.lit(0)).alias("present"), F.when(of_trip, F.col("trips")).otherwise(F.col("stops")).alias("denominator"))
    share = F.floor(F.lit(1_000_000.0) * F.col("present") / F.col("denominator") + 0.5) / 10_000.0
    return rows.withColumn("percentage", F.when(F.col("denominator") == 0, 0.0).otherwise(share))


def _number_bytes(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


#: Small numbers as they are written.
_SMALL = [_number_bytes(n) for n in range(1 << 12)]


def _varint_of(n: int) -> bytes:
    return _SMALL[n] if 0 <= n < 1 << 12 else _number_bytes(n)


def encode(parts: list[tuple[int, int | str | bytes | None]]) -> bytes:
    """A message of (number, value) pairs; null values are left out."""
    out = []
    for k, v in parts:
        if isinstance(v, int):
            out += _varint_of(k << 3), _varint_of(v)
        elif v is not None:
            raw = v.encode() if isinstance(v, str) else v
            out += _varint_of(k << 3 | 2), _varint_of(len(raw)), raw
    return b"".join(out)


def values(column: pa.Array) -> list:
    """A column of texts, bytes or whole numbers as a list, in a tenth of the time that
    ``to_pylist`` takes."""
    if pa.types.is_integer(column.type):
        return column.to_pandas(integer_object_nulls=True).tolist()
    return column.to_numpy(zero_copy_only=False).tolist()


def decode(messages: DataFrame, content: str = "content", keep: tuple[str, ...] = (), strict: bool = True, rows: str | None = None) -> DataFrame:
    """Rows of all messages of a binary column, with the columns ``keep``: those of
    one of ROW_SETS, with a timestamp for each time, or of STOP_ROWS. A message
    that doesn't parse fails the job, or is left out if not ``strict``."""
    columns_of = ROW_SETS[rows] if rows else STOP_ROWS
    names = [x.split()[0] for x in columns_of.split(", ")]
    own = messages.select(*keep, F.col(content).alias("__content"))
    schema = own.drop("__content").schema
    for field in T._parse_datatype_string(columns_of):
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, all_rows = [], []
            for k, data in enumerate(values(batch.column(len(keep)))):
                try:
                    found = snapshot_rows(data or b"")[rows] if rows else list(stop_rows(data or b""))
                except ValueError:
                    if strict:
                        raise
                    continue
                all_rows += found
                at += [k] * len(found)
            columns = list(zip(*all_rows)) or [()] * len(names)
            kinds = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[x.split()[1]] for x in columns_of.split(", ")]
            kept = [batch.column(i).take(pa.array(at, pa.int64())) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, t) for c, t in zip(columns, kinds)]], [*keep, *names])

    out = own.mapInArrow(run, schema)
    times = [n for n in names if rows and n in ("feed_time", "trip_update_time", "arrival_time", "departure_time")]
    return out.withColumns({n.removesuffix("time") + "timestamp": F.timestamp_seconds(n) for n in times}) if times else out


def decode_whole(messages: DataFrame, content: str = "content", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each message with the columns ``keep`` and, decoded once, its rows of all
    ROW_SETS: the struct ``feed`` and the arrays of structs ``trip`` and ``stop``. One
    that doesn't parse fails the job."""
    own = messages.select(*keep, F.col(content).alias("__content"))
    parts = {k: T._parse_datatype_string(v) for k, v in ROW_SETS.items()}
    schema = own.drop("__content").schema
    for k, part in parts.items():
        schema = schema.add(k, part if k == "feed" else T.ArrayType(part))
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}

    def structs(kind: str, rows: list[tuple]) -> pa.StructArray:
        of = parts[kind].fields
        columns = zip(*rows) if rows else [()] * len(of)
        return pa.StructArray.from_arrays([pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, of)], [f.name for f in of])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feeds, rows, ends = [], {"trip": [], "stop": []}, {"trip": [0], "stop": [0]}
            for data in values(batch.column(len(keep))):
                found = snapshot_rows(data or b"")
                feeds += found["feed"]
                for k in rows:
                    rows[k] += found[k]
                    ends[k].append(len(rows[k]))
            lists = [pa.ListArray.from_arrays(pa.array(ends[k], pa.int32()), structs(k, rows[k])) for k in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], structs("feed", feeds), *lists], [*keep, "feed", *rows])

    return own.mapInArrow(run, schema)


def read_feed(spark: SparkSession, path: str, strict: bool = True, rows: str | None = None, inventory: DataFrame | None = None) -> DataFrame:
    """Decoded rows of message files, with each file's path, name and checksum. With an
    ``inventory`` of ``name, checksum_sha256`` every file is held against its checksum
    before it is decoded; one that differs or isn't listed fails the job."""
    files = spark.read.format("binaryFile").load(path).withColumn("checksum_sha256", F.sha2("content", 256))
    if inventory is not None:
        listed = inventory.select(F.col("name").alias("__name"), F.col("checksum_sha256").alias("__listed"))
        files = files.withColumn("__file", F.element_at(F.split("path", "/"), -1)).join(listed, F.col("__file") == F.col("__name"), "left")
        wrong = F.raise_error(F.concat(F.lit("checksum differs: "), F.col("path"))).cast("binary")
        files = files.withColumn("content", F.when(F.col("checksum_sha256") == F.col("__listed"), F.col("content")).otherwise(wrong)).drop("__file", "__name", "__listed")
    files = files.withColumn("snapshot_id", F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1))
    return decode(files, "content", ("path", "snapshot_id", "checksum_sha256"), strict, rows)

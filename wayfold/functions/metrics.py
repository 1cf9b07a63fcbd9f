"""Column factories for counts, rates and percentiles.

Rates and rounded values are computed in whole numbers where a rounded quotient is
asked for, so that every engine gives the same digits: rounding is half away from
zero, and a zero denominator gives null. Rates are always made from counts; they
are never averaged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits in seconds of the two families of timing classes.
ON_TIME_FROM, ON_TIME_TO = -120, 300
NEAR_FROM, NEAR_TO, MINOR_TO = -60, 60, 300

DELAY = "reported_delay_seconds"


def pct2(n: Column, d: Column) -> Column:
    """100 * n / d to two places; n and d are counts."""
    n, d = n.cast("long"), d.cast("long")
    whole = ((n * 20_000 + d) - (n * 20_000 + d) % (d * 2)) / (d * 2)
    return F.when(d > 0, whole / F.lit(100.0))


def quotient2(total: Column, n: Column) -> Column:
    """total / n to two places for a whole, maybe negative total and a count."""
    total, n = total.cast("long"), n.cast("long")
    size = F.abs(total) * 200 + n
    return F.when(n > 0, F.signum(total.cast("double")) * ((size - size % (n * 2)) / (n * 2)) / F.lit(100.0))


def avg2(value: Column) -> Column:
    """The mean of whole numbers to two places."""
    return quotient2(F.sum(value), F.count(value))


def tenths(percentile: Column) -> Column:
    """A continuous percentile of whole numbers at a tenth, in whole tenths."""
    return F.round(percentile * 10).cast("long")


def seconds2(percentile: Column) -> Column:
    return tenths(percentile) / F.lit(10.0)


def minutes2(percentile: Column) -> Column:
    """A percentile in seconds as minutes to two places."""
    return quotient2(tenths(percentile), F.when(percentile.isNotNull(), F.lit(600)))


def p90(value: Column) -> Column:
    return F.percentile(value, F.lit(0.9))


def reported_delay(arrival: str = "arrival_delay_seconds", departure: str = "departure_delay_seconds") -> Column:
    """Arrival wins; null stays null and is never zero."""
    return F.coalesce(F.col(arrival), F.col(departure))


def timing_counts(delay: str = DELAY, n: str | None = None) -> dict[str, Column]:
    """The additive counts of the five timing classes, exclusive and exhaustive; of rows
    that stand for ``n`` events each, if that is given."""
    d = F.col(delay)
    number = (lambda c: F.coalesce(F.sum(F.when(c, F.col(n))), F.lit(0))) if n else F.count_if
    return {
        "unique_stop_events": F.sum(n) if n else F.count(F.lit(1)),
        "delay_reported_events": number(d.isNotNull()) if n else F.count(d),
        "early_events": number(d < NEAR_FROM),
        "near_schedule_events": number(d.between(NEAR_FROM, NEAR_TO)),
        "minor_delay_events": number((d > NEAR_TO) & (d <= MINOR_TO)),
        "late_events": number(d > MINOR_TO),
        "timing_unavailable_events": number(d.isNull()),
    }


def on_time_counts(delay: str = DELAY) -> dict[str, Column]:
    """Counts and rates of the other family: early, on time and late by limits of
    two and five minutes."""
    d = F.col(delay)
    n, timed = F.count(F.lit(1)), F.count(d)
    early, on_time, late = F.count_if(d < ON_TIME_FROM), F.count_if(d.between(ON_TIME_FROM, ON_TIME_TO)), F.count_if(d > ON_TIME_TO)
    return {
        "stop_events": n,
        "delay_events": timed,
        "delay_coverage_percentage": pct2(timed, n),
        "early_events": early,
        "on_time_events": on_time,
        "late_over_five_minutes_events": late,
        "early_percentage": pct2(early, timed),
        "on_time_percentage": pct2(on_time, timed),
        "late_over_five_minutes_percentage": pct2(late, timed),
        "median_delay_minutes": minutes2(F.median(d)),
        "p90_delay_minutes": minutes2(p90(d)),
    }


def named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(k) for k, c in columns.items()]

"""Column functions for maps: colours, sizes and zoom."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colours by severity, the colour of what can't be read, and zoom by span.
FEW, SEVERE, HIGH, LOW = (107, 114, 128, 180), (239, 68, 68, 220), (249, 115, 22, 220), (245, 158, 11, 210)
UNREADABLE = (100, 116, 139)
ZOOM = ((0.12, 11.0), (0.4, 9.5), (1.0, 8.0))


def _ints(values: tuple[int, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rgba(colour: Column, alpha: int = 220) -> Column:
    """Red, green, blue and alpha of ``#RRGGBB``; a fixed colour for any other text."""
    plain = F.ltrim(F.trim(colour), F.lit("#"))
    parts = [F.conv(F.substring(plain, k, 2), 16, 10).cast("int") for k in (1, 3, 5)]
    return F.when(plain.rlike("^[0-9A-Fa-f]{6}$"), F.array(*parts, F.lit(alpha))).otherwise(_ints((*UNREADABLE, alpha)))


def severity(late_percentage: Column, timed: Column, enough: int = 100) -> Column:
    """The colour of a place: by its late share, grey without enough timed events."""
    return F.when(timed < enough, _ints(FEW)).when(late_percentage >= 20, _ints(SEVERE)).when(late_percentage >= 10, _ints(HIGH)).otherwise(_ints(LOW))


def radius(n: Column, least: float, most: float, factor: float) -> Column:
    """A radius that grows with the square root of a count, within bounds."""
    return F.greatest(F.lit(least), F.least(F.lit(most), F.sqrt(n) * factor))


def zoom(span: Column) -> Column:
    """How near a map should be to show a span of degrees."""
    out = F.lit(7.0)
    for most, value in ZOOM[::-1]:
        out = F.when(span <= most, value).otherwise(out)
    return out

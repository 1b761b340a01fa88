"""Scalar column expressions (FN-*). All JVM-side, inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used by the haversine metric.
EARTH_RADIUS_KM = 6371.0


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unused(df, name: str) -> str:
    """``name``, with as many ``_`` after it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(line, sep: str = " ") -> Column:
    """FN-1: split on one literal separator; empty strings are kept (trap T10)."""
    import re
    return F.split(col_(line), re.escape(sep), -1)


def euclidean(lat1, lon1, lat2, lon2) -> Column:
    """FN-6: planar distance in degrees, ``sqrt(dlat^2 + dlon^2)``."""
    return F.sqrt(F.pow(col_(lat1) - col_(lat2), 2) + F.pow(col_(lon1) - col_(lon2), 2))


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> Column:
    """FN-7: great-circle distance on a sphere of ``radius`` (degrees in)."""
    p1, p2 = F.radians(col_(lat1)), F.radians(col_(lat2))
    dp = p2 - p1
    dl = F.radians(col_(lon2)) - F.radians(col_(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def exact_sum(c) -> Column:
    """Sum of a column as a double that does not depend on the order of summation.

    Three decimal sums: values below 1e19 with 18 places, what those places leave over (times 1e18, so 36 places
    in all), and larger values without places. Digits behind them are rounded; the three sums become
    doubles and are added. Where a value is not finite, is 1e38 or more, or a sum does not fit, it is the plain sum of doubles.
    """
    x, d = col_(c).cast("double"), "decimal(38,18)"
    small = F.abs(x) < 1e19
    m = F.when(small, col_(c)).try_cast(d)
    big = F.when(~small, col_(c)).try_cast("decimal(38,0)")
    # From 0.1 on, a double's shortest digits end within 18 places.
    rest = F.when(F.abs(x) < 0.1, (x - m.cast("double")) * F.lit(1e18)).try_cast(d)

    def part(v, scale):
        return F.when(F.count(v) == 0, 0.0).otherwise(F.try_sum(v).cast("double") * F.lit(scale))
    whole = (F.count(x) > 0) & (F.count(m) + F.count(big) == F.count(x))
    exact = F.when(whole, part(m, 1.0) + part(big, 1.0) + part(rest, 1e-18))
    return F.coalesce(exact, F.sum(x))


def exact_mean(c, empty_value: float | None = None) -> Column:
    """Mean whose value does not depend on summation order: ``exact_sum`` by the count.

    ``empty_value`` replaces the mean of nothing (trap T22: the reference returns 0).
    """
    m = F.try_divide(exact_sum(c), F.count(col_(c)).cast("double"))
    return F.coalesce(m, F.lit(float(empty_value))) if empty_value is not None else m


def equal_width_bucket(c, lo, hi, n: int) -> Column:
    """SRT-3 / PAR-2: bucket of ``n`` equal-width, right-closed buckets over [lo, hi].

    The first bucket also holds ``lo`` (all of a constant column); values outside the range clamp to the
    end buckets. Works for any ``lo`` (the reference's loop is only right for 0).
    """
    width = (col_(hi) - col_(lo)) / F.lit(float(n))
    raw = F.when(width == 0, 0).otherwise(F.ceil(F.try_divide(col_(c) - col_(lo), width)) - 1)
    return F.least(F.greatest(raw, F.lit(0)), F.lit(n - 1)).cast("int")


def tag_tokens(tags) -> Column:
    """FN-3: the ``<tag>`` tokens of a tag string, lower case; null → empty array
    (FN-9: a null tag string never matches, like the reference's ``str(None)``)."""
    return F.coalesce(F.regexp_extract_all(F.lower(col_(tags)), F.lit(r"<([^<>]*)>"), 1),
                      F.array().cast("array<string>"))


def inclusive_day_end(hi: str) -> Column:
    """FIL-6 option: the last instant of day ``hi`` instead of its midnight (trap T7)."""
    return F.to_timestamp(F.lit(hi)) + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND")


def distinct_sorted(c) -> Column:
    """FN-2: ``sorted(set(list))`` of an array column."""
    return F.sort_array(F.array_distinct(col_(c)))


def event_year(c) -> Column:
    """FN-4: calendar year of a timestamp (session time zone pinned to UTC)."""
    return F.year(col_(c))


def to_long(c, strict: bool = False) -> Column:
    """FN-5: text → bigint. ``try_cast`` gives null for dirty text (trap T14);
    ``strict`` raises on it (ANSI ``cast``)."""
    return col_(c).cast("bigint") if strict else col_(c).try_cast("bigint")


def not_every_nth(c, n: int) -> Column:
    """FN-8 / FIL-12: ``c % n != 0`` (drops every n-th id)."""
    return (col_(c) % F.lit(n)) != F.lit(0)


def format_line(fmt: str, *cols) -> Column:
    """FN-10 / PRJ-4: a formatted text line from row values (``format_string``).

    FN-9: a null value prints as ``null``; the reference's ``str(None)`` gives
    ``'None'`` — neither matches a ``<tag>``, so tag lookups are unaffected.
    """
    return F.format_string(fmt, *[col_(c) for c in cols])

"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delay threshold (minutes, strictly greater) and wind buckets.
DELAY_THRESHOLD_MINUTES = 15.0
WIND_BUCKET_EDGES = (0.0, 15.0, 25.0, 35.0, 100.0)
WIND_BUCKET_LABELS = ("0-15 km/h", "15-25 km/h", "25-35 km/h", "35+ km/h")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delay_minutes(actual: str | Column, scheduled: str | Column, missing: str = "zero") -> Column:
    """Departure delay in minutes: whole-second difference / 60, rounded to
    2 decimals, floored at 0.

    ``missing="zero"`` keeps the batch pipeline's behaviour (a missing actual
    time yields 0.0 because ``greatest`` skips nulls); ``"null"`` keeps it null.
    """
    seconds = F.unix_timestamp(_col(actual)) - F.unix_timestamp(_col(scheduled))
    rounded = F.round(seconds / F.lit(60.0), 2)
    if missing == "zero":
        return F.greatest(rounded, F.lit(0.0))
    if missing == "null":
        return F.when(rounded.isNull(), F.lit(None).cast("double")).otherwise(
            F.greatest(rounded, F.lit(0.0))
        )
    raise ValueError(f"missing must be 'zero' or 'null', got {missing!r}")


def is_delayed(delay: str | Column) -> Column:
    return F.coalesce(_col(delay) > F.lit(DELAY_THRESHOLD_MINUTES), F.lit(False))


def route_key(origin: str | Column = "origin_airport", destination: str | Column = "destination_airport") -> Column:
    """``ORIGIN-DEST``; a null side is skipped (``concat_ws``)."""
    return F.concat_ws("-", _col(origin), _col(destination))


def wind_bucket(wind: str | Column) -> Column:
    """Right-closed wind buckets [0,15], (15,25], (25,35], (35,100];
    anything else (negative, above 100, null) is null."""
    w = _col(wind)
    e, lab = WIND_BUCKET_EDGES, WIND_BUCKET_LABELS
    return (
        F.when((w >= e[0]) & (w <= e[1]), F.lit(lab[0]))
        .when((w > e[1]) & (w <= e[2]), F.lit(lab[1]))
        .when((w > e[2]) & (w <= e[3]), F.lit(lab[2]))
        .when((w > e[3]) & (w <= e[4]), F.lit(lab[3]))
    )


def wind_bucket_index(wind: str | Column) -> Column:
    """1-based bucket ordinal matching ``wind_bucket`` (null outside)."""
    w = _col(wind)
    e = WIND_BUCKET_EDGES
    return (
        F.when((w >= e[0]) & (w <= e[1]), F.lit(1))
        .when((w > e[1]) & (w <= e[2]), F.lit(2))
        .when((w > e[2]) & (w <= e[3]), F.lit(3))
        .when((w > e[3]) & (w <= e[4]), F.lit(4))
    )


def safe_rate(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division that yields null instead of raising on zero (ANSI)."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def bool_count(flag: str | Column) -> Column:
    """Sum of a boolean column as a bigint (null when every input is null)."""
    return F.sum(_col(flag).cast("int")).cast("bigint")


def mean_minutes(c: str | Column) -> Column:
    """Mean of minutes that are rounded to two decimals, as delays are by
    definition. They are summed as decimals, so the mean does not depend on
    partitioning, nor does what a report shows after rounding it."""
    c = _col(c)
    return F.try_divide(F.sum(c.cast("decimal(18,2)")).cast("double"), F.count(c).cast("double"))


def pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation that returns null (never raises) for constant or
    single-row input. Built-in ``corr`` raises on constant input under ANSI."""
    x, y = _col(x), _col(y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

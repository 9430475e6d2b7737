"""Weather as of the flight time at the origin airport.

Flights and observations are never paired. Both are laid into time buckets of
each airport, sorted together, and every flight takes the last observation
before it (``last`` over a running window) or the first one after it (the same
over the reverse order), so the work grows with rows, not with pairs.

A flight's observation may lie in an earlier bucket. Only the last observation
of each bucket can be wanted by later ones (the first one by earlier ones), so
exactly these are copied into the buckets that one tolerance reaches:
``buckets_per_tolerance`` copies per bucket, however many observations it has.
Narrower buckets split a busy airport over more tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MEASURES = ("temperature_c", "wind_speed_kmh", "precipitation_mm")
BUCKETS_PER_TOLERANCE = 6


def weather_asof(
    flights: DataFrame,
    weather: DataFrame,
    tolerance_seconds: int = 6 * 3600,
    direction: str = "backward",
    time_col: str = "scheduled_departure_utc",
    airport_col: str = "origin_airport",
    buckets_per_tolerance: int = BUCKETS_PER_TOLERANCE,
) -> DataFrame:
    """Flights (every input row kept, null or repeated ids included) with
    ``origin_observed_at_utc`` and ``origin_*`` measures of the chosen
    observation, null when none lies within ``tolerance_seconds``.

    ``direction="backward"``: latest observation at or before the flight
    time. ``"nearest"``: smallest absolute gap, the earlier one on a tie.
    Observations of equal time are chosen by their measures. Flights without
    airport or time get no weather and are spread by a hash."""
    if direction not in ("backward", "nearest"):
        raise ValueError(f"direction must be 'backward' or 'nearest', got {direction!r}")
    if tolerance_seconds <= 0:
        raise ValueError("tolerance_seconds must be positive")
    tolerance = int(tolerance_seconds) * 1_000_000
    width = F.lit(-(-tolerance // buckets_per_tolerance))
    flight_cols = list(flights.columns)

    def bucket_of(time: Column) -> Column:
        return F.floor(time / width)

    observed = weather.where(F.col("airport_code").isNotNull() & F.col("observed_at_utc").isNotNull()).select(
        F.col("airport_code").alias("_airport"),
        F.unix_micros("observed_at_utc").alias("_t"),
        F.struct("observed_at_utc", *MEASURES).alias("_obs"),
    )
    observed = observed.withColumn("_bucket", bucket_of(F.col("_t")))
    edge = F.struct("_t", "_obs")
    edges = observed.groupBy("_airport", "_bucket").agg(F.max(edge).alias("_last"), F.min(edge).alias("_first"))

    def copies(which: str, sign: int) -> DataFrame:
        reach = F.array(*[F.lit(sign * i) for i in range(1, buckets_per_tolerance + 1)])
        placed = edges.select("_airport", which, F.col("_bucket").alias("_from"), F.explode(reach).alias("_steps"))
        return placed.select("_airport", f"{which}._t", f"{which}._obs", (F.col("_from") + F.col("_steps")).alias("_bucket"))

    # A flight after or before its observations of equal time, whichever way they are read.
    time = F.unix_micros(F.col(time_col))
    placeless = F.col(airport_col).isNull() | time.isNull()
    flown = flights.select(
        F.col(airport_col).alias("_airport"),
        time.alias("_t"),
        F.when(placeless, F.xxhash64(*flight_cols)).otherwise(bucket_of(time)).alias("_bucket"),
        F.struct(*flight_cols).alias("_flight"),
    )
    laid = observed.unionByName(copies("_last", 1))
    if direction == "nearest":
        laid = laid.unionByName(copies("_first", -1))
    laid = laid.unionByName(flown, allowMissingColumns=True)
    is_flight = F.col("_flight").isNotNull()
    bucket = Window.partitionBy("_airport", "_bucket")

    def seen(order: list[Column]) -> Column:
        running = bucket.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return F.last(F.when(~is_flight, F.struct("_t", "_obs")), ignorenulls=True).over(running)

    laid = laid.withColumn("_before", seen([F.col("_t"), is_flight, F.col("_obs")]))
    if direction == "nearest":
        laid = laid.withColumn("_after", seen([F.col("_t").desc(), is_flight, F.col("_obs").desc()]))
    gap = F.col("_t") - F.col("_before._t")
    chosen = F.when(gap <= tolerance, F.col("_before._obs"))
    if direction == "nearest":
        ahead = F.col("_after._t") - F.col("_t")
        closer = (ahead <= tolerance) & (gap.isNull() | (gap > ahead))
        chosen = F.when(closer, F.col("_after._obs")).otherwise(chosen)
    placed = F.col("_airport").isNotNull() & F.col("_t").isNotNull()
    out = laid.where(is_flight).select("_flight.*", F.when(placed, chosen).alias("_w"))
    return out.select(
        *flight_cols,
        F.col("_w.observed_at_utc").alias("origin_observed_at_utc"),
        *[F.col(f"_w.{m}").alias(f"origin_{m}") for m in MEASURES],
    )

"""Data-quality operators: profile (A11), inventory (A12), duplicate keys
(A14), referential orphans (X2) and enrichment gaps (X6).

Each returns a small DataFrame computed by distributed aggregates; nothing is
collected to compute it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.session import materialize


def _missing_flag(df: DataFrame, name: str) -> Column:
    """1 when the cell is null (or NaN for floating columns), else 0."""
    c = F.col(name)
    dtype = df.schema[name].dataType
    missing = c.isNull() | F.isnan(c) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c.isNull()
    return missing.cast("int")


def _row_digest(df: DataFrame) -> list[Column]:
    """A row as two hashes. Both start with which columns are null, since the
    hash passes nulls over; given that, the others stand in fixed places. Equal
    rows have equal digests (-0.0 and 0.0, and all NaN, hash alike)."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    cells = [*[c.isNull() for c in columns], *columns]
    return [F.xxhash64(*cells).alias("_high"), F.xxhash64(F.lit(1), *cells).alias("_low")]


def quality_profile(df: DataFrame, layer: str, dataset: str) -> DataFrame:
    """Rows, duplicate rows (rows equal to an earlier row, nulls equal),
    missing cells and the mean per-column missing rate."""
    return profile_layers({layer: {dataset: df}})


def profile_layers(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """A11 of every dataset, in one pass over all of them.

    Rows are counted by a 128-bit digest, partially in each task, so a few numbers
    per row cross the shuffle instead of the row. Digests that occur more than
    once are written; only datasets that have any are read again, and only the
    rows they match are compared by all their columns, so the counts are exact
    whatever collides."""
    datasets = [(layer, name, df) for layer, tables in layers.items() for name, df in tables.items()]
    digests = []
    for i, (_, _, df) in enumerate(datasets):
        nulls = sum((_missing_flag(df, c) for c in df.columns), F.lit(0))
        digests.append(df.select(F.lit(i).alias("_set"), *_row_digest(df), nulls.alias("_nulls")))
    counted = union_all(digests).groupBy("_set", "_high", "_low").agg(F.count(F.lit(1)).alias("_n"), F.sum("_nulls").alias("_nulls"))
    seen, metrics = Observation(), []
    for i in range(len(datasets)):
        mine = F.col("_set") == i
        metrics += [
            F.coalesce(F.sum(F.when(mine, F.col("_n"))), F.lit(0)).alias(f"rows{i}"),
            F.coalesce(F.sum(F.when(mine, F.col("_nulls"))), F.lit(0)).alias(f"nulls{i}"),
            F.count_if(mine & (F.col("_n") > 1)).alias(f"suspects{i}"),
        ]
    suspects = counted.observe(seen, *metrics).where(F.col("_n") > 1).select("_set", "_high", "_low")
    suspects = materialize(suspects, "suspect-rows")
    found = {k: int(v or 0) for k, v in seen.get.items()}
    profiles = []
    for i, (layer, name, df) in enumerate(datasets):
        if found[f"suspects{i}"]:
            mine = suspects.where(F.col("_set") == i).drop("_set")
            matched = df.select("*", *_row_digest(df)).join(mine, ["_high", "_low"], "left_semi").select(*df.columns)
            groups = matched.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("_more"))
            more = groups.agg(F.coalesce(F.sum("_more"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
        else:
            more = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("duplicate_rows"))
        rows, missing = (F.lit(found[f"{k}{i}"]).cast("bigint") for k in ("rows", "nulls"))
        rate = F.try_divide(missing.cast("double"), (rows * F.lit(len(df.columns))).cast("double"))
        profiles.append(
            more.select(
                F.lit(layer).alias("layer"),
                F.lit(name).alias("dataset"),
                rows.alias("rows"),
                "duplicate_rows",
                missing.alias("missing_values"),
                rate.alias("missing_value_rate"),
            )
        )
    return union_all(profiles)


def dataset_inventory(df: DataFrame, layer: str, dataset: str) -> DataFrame:
    """Rows and columns of one dataset."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(layer).alias("layer"),
        F.lit(dataset).alias("dataset"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Row append by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def inventory_layers(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    return union_all(
        [dataset_inventory(df, layer, name) for layer, tables in layers.items() for name, df in tables.items()]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def referential_orphans(
    flights: DataFrame, airports: DataFrame, weather: DataFrame, events: DataFrame
) -> DataFrame:
    """Records whose reference has no match: flight origin / destination
    not in airports, weather airport not in airports, event flight not in
    flights. Anti joins on the key only (null keys never match)."""
    codes = airports.select(F.col("airport_code").alias("_ref")).distinct()
    flight_ids = flights.select(F.col("flight_id").alias("_ref")).distinct()

    def orphans(check: str, df: DataFrame, key: str, ref: DataFrame) -> DataFrame:
        # Records are counted per key first (map-side combine), so a hot key is one row in the join.
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return (
            per_key.join(ref, F.col(key) == F.col("_ref"), "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_records"))
            .select(F.lit(check).alias("check"), "orphan_records")
        )

    return union_all(
        [
            orphans("flights.origin_airport -> airports", flights, "origin_airport", codes),
            orphans("flights.destination_airport -> airports", flights, "destination_airport", codes),
            orphans("weather.airport_code -> airports", weather, "airport_code", codes),
            orphans("passenger_events.flight_id -> flights", events, "flight_id", flight_ids),
        ]
    )


def enrichment_gaps(flight_performance: DataFrame) -> DataFrame:
    """Enriched flights missing origin airport, destination airport or
    origin weather attributes."""
    return flight_performance.agg(
        F.count(F.lit(1)).alias("flights"),
        F.count_if(F.col("origin_airport_name").isNull()).alias("missing_origin_airport"),
        F.count_if(F.col("destination_airport_name").isNull()).alias("missing_destination_airport"),
        F.count_if(F.col("origin_wind_speed_kmh").isNull()).alias("missing_origin_weather"),
    )


def future_events(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Events stamped after the processing time (default: now)."""
    return events.where(F.col("event_timestamp_utc") > (F.current_timestamp() if processed_at is None else processed_at))


def known_time_zones(spark) -> DataFrame:
    """IANA zone names known to the Python runtime (about 600 rows: a fixed,
    bounded reference list, safe to broadcast)."""
    import zoneinfo

    return spark.createDataFrame([(z,) for z in sorted(zoneinfo.available_timezones())], "timezone string")


def invalid_time_zones(airports: DataFrame) -> DataFrame:
    """Airports whose non-null time zone is not a known zone name."""
    zones = F.broadcast(known_time_zones(airports.sparkSession))
    return airports.where(F.col("timezone").isNotNull()).join(zones, "timezone", "left_anti")

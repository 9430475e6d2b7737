"""Dashboard and notebook metrics as lazy DataFrame operators
(F1–F8, A4–A7, A13, O1).

Every function takes and returns DataFrames; only the final, small result is
meant to be collected by a caller. The column-presence guard (F8) returns an
empty frame with the operator's fixed schema instead of failing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.functions import (
    WIND_BUCKET_LABELS,
    bool_count,
    mean_minutes,
    pearson,
    safe_rate,
    wind_bucket,
    wind_bucket_index,
)
from aerolith.functions.ordering import ascending, ascending_nulls_last, descending, positioned

# --- filters -----------------------------------------------------------------

ROUTE_AWARE_TABLES = ("flight_performance", "route_performance", "passenger_communication")


def filter_tables_by_routes(tables: dict[str, DataFrame], selected_routes: Sequence[str]) -> dict[str, DataFrame]:
    """keep only the selected routes in the route-aware tables; an empty
    selection keeps everything; the airport table is never filtered."""
    if not selected_routes:
        return dict(tables)
    out = dict(tables)
    for name in ROUTE_AWARE_TABLES:
        frame = out.get(name)
        if frame is not None and "route" in frame.columns:
            out[name] = frame.where(F.col("route").isin(list(selected_routes)))
    return out


def filter_flight_performance(
    flights: DataFrame,
    delayed_only: bool = False,
    cancelled_only: bool = False,
    wind_speed_range: tuple[float, float] | None = None,
) -> DataFrame:
    """delayed-only, cancelled-only and an inclusive wind range. Once a
    range is given, flights without weather drop out. No range by default."""
    out = flights
    if delayed_only:
        out = out.where(F.col("is_delayed"))
    if cancelled_only:
        out = out.where(F.col("is_cancelled"))
    if wind_speed_range and "origin_wind_speed_kmh" in flights.columns:
        low, high = wind_speed_range
        out = out.where(F.col("origin_wind_speed_kmh").between(low, high))
    return out


def filter_route_performance(routes: DataFrame, minimum_delay_rate: float) -> DataFrame:
    """routes whose delay rate is at least the minimum."""
    return routes.where(F.col("delay_rate") >= F.lit(minimum_delay_rate))


def route_options(flights: DataFrame) -> DataFrame:
    """distinct non-null routes, sorted."""
    return flights.select("route").where(F.col("route").isNotNull()).distinct().orderBy("route")


def wind_speed_bounds(flights: DataFrame) -> DataFrame:
    """min and max origin wind speed (for the wind range control)."""
    return flights.agg(
        F.min("origin_wind_speed_kmh").alias("min_wind_speed_kmh"),
        F.max("origin_wind_speed_kmh").alias("max_wind_speed_kmh"),
    )


def _has_columns(df: DataFrame, required: Sequence[str]) -> bool:
    return set(required).issubset(df.columns)


def _empty(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


# --- aggregates ----------------------------------------------------------------

KPI_SCHEMA = T.StructType(
    [
        T.StructField("total_flights", T.LongType()),
        T.StructField("delayed_flights", T.LongType()),
        T.StructField("cancelled_flights", T.LongType()),
        T.StructField("delay_rate", T.DoubleType()),
        T.StructField("average_departure_delay_minutes", T.DoubleType()),
    ]
)


def calculate_kpis(flights: DataFrame) -> DataFrame:
    """One row of headline KPIs; all zeros on an empty input."""
    agg = flights.agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.coalesce(bool_count("is_delayed"), F.lit(0).cast("bigint")).alias("delayed_flights"),
        F.coalesce(bool_count("is_cancelled"), F.lit(0).cast("bigint")).alias("cancelled_flights"),
        mean_minutes("departure_delay_minutes").alias("_avg"),
    )
    empty = F.col("total_flights") == 0
    return agg.select(
        "total_flights",
        "delayed_flights",
        "cancelled_flights",
        F.when(empty, F.lit(0.0)).otherwise(safe_rate("delayed_flights", "total_flights")).alias("delay_rate"),
        F.when(empty, F.lit(0.0)).otherwise(F.col("_avg")).alias("average_departure_delay_minutes"),
    )


WEATHER_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("average_wind_speed_kmh", T.DoubleType()),
        T.StructField("wind_delay_correlation", T.DoubleType()),
    ]
)


def calculate_weather_delay_summary(flights: DataFrame) -> DataFrame:
    """Mean wind and the wind/delay Pearson correlation over flights with
    both values; nulls when fewer than two such flights or when either
    series is constant (never an error)."""
    wind, delay = "origin_wind_speed_kmh", "departure_delay_minutes"
    if not _has_columns(flights, [wind, delay]):
        return flights.sparkSession.createDataFrame([(None, None)], WEATHER_SUMMARY_SCHEMA)
    complete = flights.select(wind, delay).where(F.col(wind).isNotNull() & F.col(delay).isNotNull())
    agg = complete.agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(wind).alias("_avg"),
        pearson(wind, delay).alias("_corr"),
    )
    enough = F.col("_n") >= 2
    return agg.select(
        F.when(enough, F.col("_avg")).alias("average_wind_speed_kmh"),
        F.when(enough, F.col("_corr")).alias("wind_delay_correlation"),
    )


WEATHER_VIEW_SCHEMA = T.StructType(
    [
        T.StructField("wind_bucket", T.StringType()),
        T.StructField("total_flights", T.LongType()),
        T.StructField("delayed_flights", T.LongType()),
        T.StructField("average_departure_delay_minutes", T.DoubleType()),
        T.StructField("average_wind_speed_kmh", T.DoubleType()),
        T.StructField("delay_rate", T.DoubleType()),
    ]
)


def build_weather_delay_view(flights: DataFrame) -> DataFrame:
    """A4: delay metrics per wind bucket (observed buckets only, in bucket
    order). Rows with a null in any needed column are dropped first, then
    rows whose wind lies outside every bucket."""
    needed = ["flight_id", "origin_wind_speed_kmh", "departure_delay_minutes", "is_delayed"]
    if not _has_columns(flights, needed):
        return _empty(flights, WEATHER_VIEW_SCHEMA)
    data = (
        flights.select(*needed)
        .dropna(subset=needed)
        .withColumn("wind_bucket", wind_bucket("origin_wind_speed_kmh"))
        .withColumn("_bucket_order", wind_bucket_index("origin_wind_speed_kmh"))
        .where(F.col("wind_bucket").isNotNull())
    )
    return (
        data.groupBy("wind_bucket", "_bucket_order")
        .agg(
            F.count("flight_id").alias("total_flights"),
            bool_count("is_delayed").alias("delayed_flights"),
            mean_minutes("departure_delay_minutes").alias("average_departure_delay_minutes"),
            F.avg("origin_wind_speed_kmh").alias("average_wind_speed_kmh"),
        )
        .withColumn("delay_rate", safe_rate("delayed_flights", "total_flights"))
        .orderBy("_bucket_order")
        .drop("_bucket_order")
    )


def risk_matrix_schema() -> T.StructType:
    return T.StructType(
        [T.StructField("route", T.StringType())] + [T.StructField(lab, T.DoubleType()) for lab in WIND_BUCKET_LABELS]
    )


def build_delay_risk_heatmap(flights: DataFrame, minimum_segment_flights: int) -> DataFrame:
    """A5: route × wind bucket delay probability, one column per bucket label
    (all four, missing = null). Segments with fewer than
    ``minimum_segment_flights`` flights are null; routes with no qualifying
    segment are absent.

    The pivot is written as one conditional aggregation per route, which is a
    single shuffle by route with map-side partial aggregation (a
    group-then-pivot needs two).
    """
    needed = ["route", "flight_id", "origin_wind_speed_kmh", "is_delayed"]
    if not _has_columns(flights, needed):
        return _empty(flights, risk_matrix_schema())
    data = (
        flights.select(*needed)
        .dropna(subset=needed)
        .withColumn("_bucket", wind_bucket("origin_wind_speed_kmh"))
        .where(F.col("_bucket").isNotNull())
    )
    aggs = []
    for i, label in enumerate(WIND_BUCKET_LABELS):
        in_bucket = F.col("_bucket") == F.lit(label)
        aggs.append(F.count(F.when(in_bucket, F.col("flight_id"))).alias(f"_n{i}"))
        aggs.append(F.sum(F.when(in_bucket, F.col("is_delayed").cast("bigint"))).alias(f"_d{i}"))
    per_route = data.groupBy("route").agg(*aggs)
    minimum = F.lit(minimum_segment_flights)
    cells = [
        F.when(F.col(f"_n{i}") >= minimum, safe_rate(f"_d{i}", f"_n{i}")).alias(label)
        for i, label in enumerate(WIND_BUCKET_LABELS)
    ]
    qualifies = None
    for i in range(len(WIND_BUCKET_LABELS)):
        cond = (F.col(f"_n{i}") > 0) & (F.col(f"_n{i}") >= minimum)
        qualifies = cond if qualifies is None else (qualifies | cond)
    return per_route.where(qualifies).select("route", *cells)


def delay_distribution(flights: DataFrame, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Min, p50, p90, max and mean delay, long form (metric, value).

    ``exact=True``: ``percentile`` with linear interpolation (numpy's
    default). Its state is a map of distinct values to counts; delays are
    hundredths of a minute, so it stays small however many flights there
    are. ``exact=False``: ``percentile_approx`` (a quantile sketch of fixed
    size, relative rank error about 1/``accuracy``) for value domains
    without such a bound.
    """
    delay = F.col("departure_delay_minutes")
    if exact:
        p50, p90 = F.percentile(delay, F.lit(0.5)), F.percentile(delay, F.lit(0.9))
    else:
        p50 = F.percentile_approx(delay, 0.5, accuracy).cast("double")
        p90 = F.percentile_approx(delay, 0.9, accuracy).cast("double")
    stats = flights.agg(
        F.min(delay).alias("min"),
        p50.alias("p50"),
        p90.alias("p90"),
        F.max(delay).alias("max"),
        mean_minutes(delay).alias("mean"),
    )
    return stats.select(
        F.expr(
            "stack(5, 'min', min, 'p50', p50, 'p90', p90, 'max', max, 'mean', mean)"
            " AS (metric, departure_delay_minutes)"
        )
    )


# --- top-N ---------------------------------------------------------------------

# Dashboard sort modes → descending sort columns.
ROUTE_SORT_MODES = {
    "Delay rate": ("delay_rate", "average_departure_delay_minutes"),
    "Average delay": ("average_departure_delay_minutes", "delay_rate"),
    "Cancellations": ("cancelled_flights", "delay_rate"),
    "Total flights": ("total_flights", "delay_rate"),
}


def sort_and_limit_routes(routes: DataFrame, sort_by: str, top_n: int) -> DataFrame:
    """O1: top-N routes by one of the four modes, all descending (nulls
    last), ``route`` ascending as the final tie-break. Planned as a
    TakeOrderedAndProject: per-partition top-N, then one small merge."""
    try:
        columns = ROUTE_SORT_MODES[sort_by]
    except KeyError:
        raise ValueError(f"Unknown sort mode: {sort_by}") from None
    order = [F.col(c).desc_nulls_last() for c in columns] + [F.col("route").asc_nulls_last()]
    return routes.orderBy(*order).limit(top_n)


# --- passenger communication follow-up ------------------------------------------


def notification_coverage(flights: DataFrame, events: DataFrame) -> DataFrame:
    """Per route, how many delayed flights received a delay notification
    and how long after the scheduled departure the first one was sent.

    Notifications are reduced to the first one per flight before the join
    (one row per flight id), so the join never multiplies flights."""
    first = (
        events.where(F.col("event_type") == F.lit("delay_notification_sent"))
        .groupBy("flight_id")
        .agg(F.min("event_timestamp_utc").alias("first_notification_utc"))
    )
    delayed = flights.where(F.col("is_delayed")).select(
        "flight_id",
        F.concat_ws("-", "origin_airport", "destination_airport").alias("route")
        if "route" not in flights.columns
        else F.col("route"),
        "scheduled_departure_utc",
    )
    joined = delayed.join(first, "flight_id", "left").withColumn(
        "_minutes",
        F.round(
            (F.unix_timestamp("first_notification_utc") - F.unix_timestamp("scheduled_departure_utc")) / F.lit(60.0), 2
        ),
    )
    return (
        joined.groupBy("route")
        .agg(
            F.count(F.lit(1)).alias("delayed_flights"),
            F.count("first_notification_utc").alias("notified_delayed_flights"),
            mean_minutes("_minutes").alias("average_minutes_to_first_notification"),
        )
        .withColumn("notification_coverage", safe_rate("notified_delayed_flights", "delayed_flights"))
    )


# --- notebook / dashboard views (P12 with O3, O4) --------------------------------

ROUTE_VIEW_COLUMNS = (
    "route", "total_flights", "delayed_flights", "cancelled_flights", "delay_rate", "average_departure_delay_minutes",
)
AIRPORT_VIEW_COLUMNS = (
    "origin_airport", "airport_name", "city", "country", "total_departures", "delayed_departures",
    "cancelled_departures", "delay_rate",
)
COMMUNICATION_VIEW_COLUMNS = (
    "route", "event_type", "channel", "event_count", "delayed_flight_events", "cancelled_flight_events",
)


def route_view(routes: DataFrame) -> DataFrame:
    """Routes by delay rate and mean delay, with their positions."""
    order = [*descending("delay_rate", "average_departure_delay_minutes"), *ascending("route")]
    return positioned(routes, order, ROUTE_VIEW_COLUMNS)


def airport_view(airports: DataFrame) -> DataFrame:
    """P12 + O3: airports by delay rate, cancellations and mean delay."""
    worst = descending("delay_rate", "cancelled_departures", "average_departure_delay_minutes")
    return positioned(airports, [*worst, *ascending_nulls_last("origin_airport")], AIRPORT_VIEW_COLUMNS)


def communication_view(communication: DataFrame) -> DataFrame:
    """P12 + O4: segments by delayed, cancelled and all events; null routes
    last as in the notebook."""
    most = descending("delayed_flight_events", "cancelled_flight_events", "event_count")
    order = [*most, *ascending_nulls_last("route", "event_type", "channel")]
    return positioned(communication, order, COMMUNICATION_VIEW_COLUMNS)


# --- dashboard interaction chain (entry point 3) ---------------------------------


def dashboard_views(
    tables: dict[str, DataFrame],
    selected_routes: Sequence[str] = (),
    delayed_only: bool = False,
    cancelled_only: bool = False,
    wind_speed_range: tuple[float, float] | None = None,
    minimum_delay_rate: float = 0.0,
    sort_by: str = "Delay rate",
    top_n: int = 10,
    minimum_segment_flights: int = 5,
) -> dict[str, DataFrame]:
    """Every view of one dashboard state, as lazy DataFrames: route filter
    (F1) → flight filters (F2) → KPIs, weather summary, weather view and risk
    matrix over the filtered flights; route table (F3 → O1), airport ranking
    (O3) and communication ranking (O4) over the route-filtered gold tables,
    which are not recomputed from the filtered flights."""
    routed = filter_tables_by_routes(tables, selected_routes)
    flights = filter_flight_performance(routed["flight_performance"], delayed_only, cancelled_only, wind_speed_range)
    return {
        "kpis": calculate_kpis(flights),
        "weather_summary": calculate_weather_delay_summary(flights),
        "weather_view": build_weather_delay_view(flights),
        "risk_matrix": build_delay_risk_heatmap(flights, minimum_segment_flights),
        "routes": sort_and_limit_routes(
            filter_route_performance(routed["route_performance"], minimum_delay_rate), sort_by, top_n
        ),
        "airports": airport_view(routed["airport_disruption"]),
        "communication": communication_view(routed["passenger_communication"]),
    }

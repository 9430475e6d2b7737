"""Gold layer: enriched flights (J1–J3, A9, P5–P7) and the three rollups
(A1–A3, J4, J5).

Design notes for scale:
* No action runs while a plan is built. The airport dimension and the
  per-airport first weather row carry no broadcast hint: Spark broadcasts them
  by their size statistics, or at run time (AQE) once the aggregate's real size
  is known, and otherwise splits skewed airports of a sort-merge join.
* Route and airport rollups are computed from the slim flight frame, not
  from the 28-column enriched one: the dimension sides are unique per key,
  so the joins can neither drop nor multiply flights and the results are the
  same, while the aggregation reads five columns.
* Passenger events are pre-aggregated per (flight, type, channel) before the
  join with flights. This removes skew on a hot flight id (it collapses to a
  handful of rows map-side) and shrinks the shuffle to one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions import bool_count, mean_minutes, route_key, safe_rate
from aerolith.operators.asof import weather_asof
from aerolith.operators.silver import add_load_time

WEATHER_MEASURES = ("temperature_c", "wind_speed_kmh", "precipitation_mm")


def first_observation(weather: DataFrame) -> DataFrame:
    """Earliest observation per airport (A9). Ties on time are broken by the
    measures, so the result is deterministic; null times sort last."""
    earliest = F.min(
        F.struct(
            F.col("observed_at_utc").isNull().alias("_late"),
            F.col("observed_at_utc"),
            *[F.col(m) for m in WEATHER_MEASURES],
        )
    ).alias("_first")
    return weather.groupBy("airport_code").agg(earliest).select(
        "airport_code", "_first.observed_at_utc", *[f"_first.{m}" for m in WEATHER_MEASURES]
    )


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """Prefix every column (P5)."""
    return df.select([F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def with_route(flights: DataFrame) -> DataFrame:
    if "route" in flights.columns:
        return flights
    return flights.withColumn("route", route_key("origin_airport", "destination_airport"))


def with_origin_weather(flights: DataFrame, weather: DataFrame) -> DataFrame:
    """Flights with the origin's first observation only (J3): what the wind
    metrics need of the enriched table, with the same values, since the airport
    sides add attributes but no rows."""
    first = first_observation(weather).select(
        F.col("airport_code").alias("origin_airport"), *[F.col(m).alias(f"origin_{m}") for m in WEATHER_MEASURES]
    )
    return flights.join(first, on="origin_airport", how="left")


def enrich_flights(
    flights: DataFrame,
    airports: DataFrame,
    weather: DataFrame,
    with_load_time: bool = False,
    weather_mode: str = "first",
    asof_tolerance_seconds: int = 6 * 3600,
) -> DataFrame:
    """gold_flight_performance: flights ⟕ origin airport ⟕ destination airport
    ⟕ origin weather, plus ``route``. One row per flight.

    ``weather_mode="first"`` (the batch pipeline's choice): the airport's
    earliest observation. ``"asof"``: the latest observation at or before the
    scheduled departure within ``asof_tolerance_seconds`` (X3)."""
    if weather_mode not in ("first", "asof"):
        raise ValueError(f"weather_mode must be 'first' or 'asof', got {weather_mode!r}")
    origin, destination = prefixed(airports, "origin_"), prefixed(airports, "destination_")
    enriched = flights.join(origin, flights["origin_airport"] == origin["origin_airport_code"], "left").join(
        destination, flights["destination_airport"] == destination["destination_airport_code"], "left"
    )
    if weather_mode == "asof":
        asof = weather_asof(enriched, weather, asof_tolerance_seconds, "backward").drop("origin_observed_at_utc")
        # Same column order as the first-observation join (USING puts the key first).
        with_weather = asof.select("origin_airport", *[c for c in asof.columns if c != "origin_airport"])
    else:
        with_weather = with_origin_weather(enriched, weather)
    out = with_weather.withColumn("route", route_key("origin_airport", "destination_airport"))
    return add_load_time(out, "_gold_loaded_at_utc") if with_load_time else out


def disruption_metrics(flights: DataFrame, keys: Sequence[str], names: dict[str, str] | None = None) -> DataFrame:
    """Shared measure set of A1/A2 (and X7's daily variant): count of flight
    ids, delayed and cancelled counts, mean delay and the delay rate."""
    n = {
        "total": "total_flights",
        "delayed": "delayed_flights",
        "cancelled": "cancelled_flights",
        "average": "average_departure_delay_minutes",
        "rate": "delay_rate",
    }
    n.update(names or {})
    return (
        flights.groupBy(*keys)
        .agg(
            F.count("flight_id").alias(n["total"]),
            bool_count("is_delayed").alias(n["delayed"]),
            bool_count("is_cancelled").alias(n["cancelled"]),
            mean_minutes("departure_delay_minutes").alias(n["average"]),
        )
        .withColumn(n["rate"], safe_rate(n["delayed"], n["total"]))
    )


def route_performance(flights: DataFrame, with_load_time: bool = False) -> DataFrame:
    """gold_route_performance (A1)."""
    slim = with_route(flights).select("route", "flight_id", "is_delayed", "is_cancelled", "departure_delay_minutes")
    out = disruption_metrics(slim, ["route"])
    return add_load_time(out, "_gold_loaded_at_utc") if with_load_time else out


def route_performance_daily(flights: DataFrame) -> DataFrame:
    """Route rollup per UTC departure date (same measures as A1)."""
    slim = with_route(flights).select(
        "route",
        F.to_date("scheduled_departure_utc").alias("flight_date"),
        "flight_id",
        "is_delayed",
        "is_cancelled",
        "departure_delay_minutes",
    )
    return disruption_metrics(slim, ["route", "flight_date"])


AIRPORT_METRIC_NAMES = {
    "total": "total_departures",
    "delayed": "delayed_departures",
    "cancelled": "cancelled_departures",
}


def airport_disruption(
    flights: DataFrame,
    airports: DataFrame,
    with_load_time: bool = False,
) -> DataFrame:
    """gold_airport_disruption (A2 then J4): per origin airport, the shared
    measures plus every airport attribute."""
    slim = flights.select("origin_airport", "flight_id", "is_delayed", "is_cancelled", "departure_delay_minutes")
    grouped = disruption_metrics(slim, ["origin_airport"], AIRPORT_METRIC_NAMES)
    out = grouped.join(airports, grouped["origin_airport"] == airports["airport_code"], "left")
    return add_load_time(out, "_gold_loaded_at_utc") if with_load_time else out


def passenger_communication(events: DataFrame, flights: DataFrame, with_load_time: bool = False) -> DataFrame:
    """gold_passenger_communication (J5 then A3): per event type, channel and
    route, the event count and how many events belong to delayed / cancelled
    flights. Events whose flight is unknown have a null route and null flag
    sums."""
    per_flight = events.groupBy("flight_id", "event_type", "channel").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("event_id").alias("_ids"),
    )
    slim = with_route(flights).select("flight_id", "route", "is_delayed", "is_cancelled")
    joined = per_flight.join(slim, on="flight_id", how="left")
    out = joined.groupBy("event_type", "channel", "route").agg(
        F.sum("_ids").cast("bigint").alias("event_count"),
        F.sum(F.col("is_delayed").cast("bigint") * F.col("_rows")).alias("delayed_flight_events"),
        F.sum(F.col("is_cancelled").cast("bigint") * F.col("_rows")).alias("cancelled_flight_events"),
    )
    return add_load_time(out, "_gold_loaded_at_utc") if with_load_time else out


def build_gold_tables(
    flights: DataFrame,
    airports: DataFrame,
    weather: DataFrame,
    events: DataFrame,
    with_load_time: bool = False,
    weather_mode: str = "first",
) -> dict[str, DataFrame]:
    """All four gold tables from silver inputs (lazy)."""
    return {
        "gold_flight_performance": enrich_flights(
            flights, airports, weather, with_load_time, weather_mode
        ),
        "gold_route_performance": route_performance(flights, with_load_time),
        "gold_airport_disruption": airport_disruption(flights, airports, with_load_time),
        "gold_passenger_communication": passenger_communication(events, flights, with_load_time),
    }

"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
supplied tables, mapped to the airline shape by ``sources.testmap``.

The matching DuckDB SQL for the cross-check is in ``plans.oracle``; output
column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith import contracts
from aerolith.operators import calendar, gold, insights, quality
from aerolith.operators.asof import weather_asof
from aerolith.operators import validation as V
from aerolith.operators.dedupe import deduplicate, duplicates_for_review
from aerolith.operators.routing import route
from aerolith.functions.ordering import with_position
from aerolith.plans import jobs, reports
from aerolith.session import ensure_utc, stage_path
from aerolith.sources import landed, versioned
from aerolith.sources import testmap as tm
from aerolith.sources.catalog import load_gold_tables
from aerolith.sources.raw import write_lines

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered dashboard queries (the feature's own inputs).
TOP_N = 10
MIN_SEGMENT_FLIGHTS = 10
MIN_ROUTE_DELAY_RATE = 0.3
WIND_RANGE = (10.0, 60.0)
MAX_WEATHER_AIRPORTS = 12
SELECTED_ROUTES = ("AAA-AAB", "ABC-ADE", "AEE-AAA", "ACA-ACA")


def _flights(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return tm.silver_flights(spark, sf)


def _gold_flights(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return gold.enrich_flights(_flights(spark, sf), tm.silver_airports(spark, sf), tm.silver_weather(spark, sf))


def _weather_flights(spark: SparkSession, sf: str) -> DataFrame:
    return gold.with_origin_weather(gold.with_route(_flights(spark, sf)), tm.silver_weather(spark, sf))


def _route_perf(spark: SparkSession, sf: str) -> DataFrame:
    return gold.route_performance(_flights(spark, sf))


def _airport_disruption(spark: SparkSession, sf: str) -> DataFrame:
    return gold.airport_disruption(_flights(spark, sf), tm.silver_airports(spark, sf))


def _communication(spark: SparkSession, sf: str) -> DataFrame:
    return gold.passenger_communication(tm.silver_passenger_events(spark, sf), _flights(spark, sf))


def _dedupe(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return deduplicate(tm.bronze_flights(spark, sf), ["flight_id"])


def _duplicates(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return duplicates_for_review(tm.bronze_flights(spark, sf), ["flight_id"])


def _clean_null_mode(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return tm.silver_flights(spark, sf, missing_delay="null", cancelled_delay="null")


def _weather_first(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return gold.first_observation(tm.silver_weather(spark, sf))


def _top(mode: str) -> Query:
    return lambda spark, sf: insights.sort_and_limit_routes(_route_perf(spark, sf), mode, TOP_N)


def _selected_routes(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"route_performance": _route_perf(spark, sf)}
    return insights.filter_tables_by_routes(tables, SELECTED_ROUTES)["route_performance"]


def _validated(spark: SparkSession, sf: str, source: str) -> DataFrame:
    ensure_utc(spark)
    return V.validate(source, tm.raw_records(spark, sf, source))


def _contract_errors(source: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return V.error_messages(source, _validated(spark, sf, source)).drop("phase", "position")

    return run


def _gate_summary(mode: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        counts = {s: V.error_counts(s, tm.raw_records(spark, sf, s)) for s in contracts.SOURCES}
        return quality.union_all([V.counted_summary(s, c, mode) for s, c in counts.items()])

    return run


def _dataset_gate(spark: SparkSession, sf: str) -> DataFrame:
    """V10 itself: how many records of each source pass the dataset gate, as
    they are and with the invalid ones left out beforehand. Each source is
    judged and written once; the counts come from the footers of that table."""
    rows = []
    for source in contracts.SOURCES:
        routed = route(source, tm.raw_records(spark, sf, source), stage_path(spark, f"judged-{source}"))
        for variant, judged in (("raw", routed), ("clean", routed.only_accepted())):
            passed, held = (side.agg(F.count(F.lit(1)).alias("n")) for side in judged.gate("dataset"))
            counts = passed.select(F.col("n").alias("passed"), held.scalar().alias("held_back"))
            rows.append(counts.select(F.lit(source).alias("source"), F.lit(variant).alias("variant"), "passed", "held_back"))
    return quality.union_all(rows)


def _airport_csv(spark: SparkSession, sf: str) -> DataFrame:
    return landed.parse_airport_csv(tm.airport_csv_lines(spark, sf))


def _weather_airports(spark: SparkSession, sf: str) -> DataFrame:
    return landed.weather_airports(_airport_csv(spark, sf))


def _hourly_weather(spark: SparkSession, sf: str) -> DataFrame:
    return landed.explode_hourly_weather(tm.hourly_payloads(spark, sf))


# X4 of the registered query: events after this time count as not yet due.
PROCESSED_AT = "2024-01-20T00:00:00Z"


def _future_events(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return quality.future_events(tm.silver_passenger_events(spark, sf), F.lit(PROCESSED_AT).cast("timestamp"))


def _quarantine_flights(spark: SparkSession, sf: str) -> DataFrame:
    _, quarantined = V.gate(_validated(spark, sf, contracts.FLIGHTS), "record")
    typed = V.typed_records(contracts.FLIGHTS, quarantined, keep=("errors",))
    return typed.select(*contracts.field_names(contracts.FLIGHTS), F.size("errors").alias("error_count"))


def _accepted_events(spark: SparkSession, sf: str) -> DataFrame:
    accepted, _ = V.gate(_validated(spark, sf, contracts.PASSENGER_EVENTS), "record")
    return V.typed_records(contracts.PASSENGER_EVENTS, accepted)


ASOF_TOLERANCE_SECONDS = 6 * 3600


def _layers(spark: SparkSession, sf: str) -> dict[str, dict[str, DataFrame]]:
    """Silver and gold tables for the profile and inventory reports, derived
    lazily. Counts of written tables need none of this: ``built_inventory``."""
    ensure_utc(spark)
    flights, airports = tm.silver_flights(spark, sf), tm.silver_airports(spark, sf)
    weather, events = tm.silver_weather(spark, sf), tm.silver_passenger_events(spark, sf)
    return {
        "silver": {"flights": flights, "airports": airports, "weather": weather, "passenger_events": events},
        "gold": {
            "flight_performance": gold.enrich_flights(flights, airports, weather),
            "route_performance": gold.route_performance(flights),
            "airport_disruption": gold.airport_disruption(flights, airports),
            "passenger_communication": gold.passenger_communication(events, flights),
        },
    }


def _orphans(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return quality.referential_orphans(
        tm.silver_flights(spark, sf),
        tm.silver_airports(spark, sf),
        tm.silver_weather(spark, sf),
        tm.silver_passenger_events(spark, sf),
    )


def _asof(direction: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ensure_utc(spark)
        return weather_asof(_flights(spark, sf), tm.silver_weather(spark, sf), ASOF_TOLERANCE_SECONDS, direction)

    return run


def _weather_view_asof(spark: SparkSession, sf: str) -> DataFrame:
    return insights.build_weather_delay_view(_asof("backward")(spark, sf))


def _coverage(spark: SparkSession, sf: str) -> DataFrame:
    return insights.notification_coverage(_flights(spark, sf), tm.silver_passenger_events(spark, sf))


def _dashboard_kpis(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "flight_performance": _gold_flights(spark, sf),
        "route_performance": _route_perf(spark, sf),
        "airport_disruption": _airport_disruption(spark, sf),
        "passenger_communication": _communication(spark, sf),
    }
    views = insights.dashboard_views(tables, SELECTED_ROUTES, delayed_only=True, wind_speed_range=WIND_RANGE)
    return views["kpis"]


def _departure_order(spark: SparkSession, sf: str) -> DataFrame:
    """O5 at any size: flights with their place in the order of departure."""
    flights = _flights(spark, sf).select("flight_id", "scheduled_departure_utc", "origin_airport", "destination_airport")
    return with_position(flights, [F.col(c).asc_nulls_first() for c in ("scheduled_departure_utc", "flight_id")])


BUILT_LAYERS = ("bronze", "silver", "gold")


def _built(spark: SparkSession, sf: str) -> dict[str, str]:
    """The batch build over landed files: raw JSON Lines (invalid records held
    back), then bronze, silver (flights by date) and gold as versioned tables."""
    base = stage_path(spark, "build")
    at = {layer: f"{base}/{layer}" for layer in ("landing", "raw", *BUILT_LAYERS)}
    for source, records in tm.landed_once(spark, sf).items():
        write_lines(records.select("value"), f"{at['landing']}/{source}")
    jobs.ingest(at["raw"], records=jobs.landed_records(spark, at["landing"]), spark=spark, mode="record")
    jobs.build_bronze(at["raw"], at["bronze"], spark=spark, versioned=True)
    jobs.build_silver(at["bronze"], at["silver"], spark=spark, partition_by_date=True, versioned=True)
    jobs.build_gold(at["silver"], at["gold"], spark=spark, versioned=True)
    return at


def _built_route_performance(spark: SparkSession, sf: str) -> DataFrame:
    """K1–K4 end to end: the route table as the gold job wrote it."""
    return load_gold_tables(spark, _built(spark, sf)["gold"])["route_performance"].drop("_gold_loaded_at_utc")


def _built_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """A12 over all written layers, from their commit files."""
    at = _built(spark, sf)
    tables = {layer: list(contracts.SOURCES) for layer in ("bronze", "silver")} | {"gold": list(jobs.GOLD_TABLES)}
    return versioned.inventory(spark, {layer: {t: f"{at[layer]}/{t}" for t in names} for layer, names in tables.items()})


def _invalid_zones(spark: SparkSession, sf: str) -> DataFrame:
    return quality.invalid_time_zones(tm.airports_with_zones(spark, sf)).select("airport_code", "timezone")


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Days of every month that a dated source reaches."""
    return calendar.date_dimension(
        tm.bronze_flights(spark, sf).select("scheduled_departure_utc"),
        tm.weather(spark, sf).select("observed_at_utc"),
        tm.passenger_events(spark, sf).select("event_timestamp_utc"),
        whole_months=True,
    )


QUERIES: dict[str, Query] = {
    "silver_dedupe_flights": _dedupe,
    "silver_duplicate_review": _duplicates,
    "silver_clean_flights": lambda spark, sf: _flights(spark, sf),
    "silver_clean_flights_null_modes": _clean_null_mode,
    "weather_first_observation": _weather_first,
    "gold_flight_performance": _gold_flights,
    "gold_route_performance": _route_perf,
    "gold_airport_disruption": _airport_disruption,
    "gold_passenger_communication": _communication,
    "report_route_delay": lambda spark, sf: reports.run_report("route_delay", _route_perf(spark, sf)),
    "report_airport_disruption": lambda spark, sf: reports.run_report("airport_disruption", _airport_disruption(spark, sf)),
    "report_passenger_communication": lambda spark, sf: reports.run_report("passenger_communication", _communication(spark, sf)),
    "kpi_summary": lambda spark, sf: insights.calculate_kpis(_flights(spark, sf)),
    "weather_delay_summary": lambda spark, sf: insights.calculate_weather_delay_summary(_weather_flights(spark, sf)),
    "weather_delay_view": lambda spark, sf: insights.build_weather_delay_view(_weather_flights(spark, sf)),
    "delay_risk_matrix": lambda spark, sf: insights.build_delay_risk_heatmap(
        _weather_flights(spark, sf), MIN_SEGMENT_FLIGHTS
    ),
    "delay_distribution": lambda spark, sf: insights.delay_distribution(_flights(spark, sf)),
    "top_routes_rate": _top("Delay rate"),
    "top_routes_avg": _top("Average delay"),
    "top_routes_cancel": _top("Cancellations"),
    "top_routes_total": _top("Total flights"),
    "filter_flights_delayed_wind": lambda spark, sf: insights.filter_flight_performance(
        _gold_flights(spark, sf), delayed_only=True, wind_speed_range=WIND_RANGE
    ),
    "filter_routes_min_rate": lambda spark, sf: insights.filter_route_performance(
        _route_perf(spark, sf), MIN_ROUTE_DELAY_RATE
    ),
    "filter_routes_selected": _selected_routes,
    "route_options": lambda spark, sf: insights.route_options(gold.with_route(_flights(spark, sf))),
    "wind_speed_bounds": lambda spark, sf: insights.wind_speed_bounds(_weather_flights(spark, sf)),
    "contract_errors_flights": _contract_errors(contracts.FLIGHTS),
    "contract_errors_passenger_events": _contract_errors(contracts.PASSENGER_EVENTS),
    "contract_errors_weather": _contract_errors(contracts.WEATHER),
    "contract_errors_airports": _contract_errors(contracts.AIRPORTS),
    "contract_gate_dataset": _dataset_gate,
    "airport_csv_parse": _airport_csv,
    "weather_airports": _weather_airports,
    "hourly_weather_explode": _hourly_weather,
    "future_events": _future_events,
    "filter_flights_cancelled": lambda spark, sf: insights.filter_flight_performance(
        _gold_flights(spark, sf), cancelled_only=True
    ),
    "contract_gate_summary": _gate_summary("dataset"),
    "contract_gate_summary_record_mode": _gate_summary("record"),
    "contract_gate_totals": lambda spark, sf: V.validation_totals(_gate_summary("dataset")(spark, sf)),
    "contract_quarantine_flights": _quarantine_flights,
    "contract_accepted_passenger_events": _accepted_events,
    "quality_profile": lambda spark, sf: quality.profile_layers(_layers(spark, sf)),
    "dataset_inventory": lambda spark, sf: quality.inventory_layers(_layers(spark, sf)),
    "duplicate_flight_keys": lambda spark, sf: quality.duplicate_keys(tm.bronze_flights(spark, sf), ["flight_id"]),
    "referential_orphans": _orphans,
    "enrichment_gaps": lambda spark, sf: quality.enrichment_gaps(_gold_flights(spark, sf)),
    "weather_asof": _asof("backward"),
    "weather_asof_nearest": _asof("nearest"),
    "weather_delay_view_asof": _weather_view_asof,
    "notification_coverage": _coverage,
    "route_performance_daily": lambda spark, sf: gold.route_performance_daily(_flights(spark, sf)),
    "date_dimension": _calendar,
    "flights_by_day": lambda spark, sf: calendar.flights_by_day(_flights(spark, sf), _calendar(spark, sf)),
    "calendar_rollup": lambda spark, sf: calendar.calendar_rollup(_flights(spark, sf), _calendar(spark, sf)),
    "flight_totals": lambda spark, sf: calendar.flight_totals(_flights(spark, sf)),
    "communication_totals": lambda spark, sf: calendar.communication_totals(
        tm.silver_passenger_events(spark, sf), _flights(spark, sf)
    ),
    "flights_in_departure_order": _departure_order,
    "built_route_performance": _built_route_performance,
    "built_inventory": _built_inventory,
    "invalid_time_zones": _invalid_zones,
    "weather_airports_limited": lambda spark, sf: landed.weather_airports(_airport_csv(spark, sf), MAX_WEATHER_AIRPORTS),
    "weather_delay_view_without_wind": lambda spark, sf: insights.build_weather_delay_view(
        gold.with_route(_flights(spark, sf))
    ),
    "notebook_route_view": lambda spark, sf: insights.route_view(_route_perf(spark, sf)),
    "notebook_airport_view": lambda spark, sf: insights.airport_view(_airport_disruption(spark, sf)),
    "notebook_communication_view": lambda spark, sf: insights.communication_view(_communication(spark, sf)),
    "dashboard_filtered_kpis": _dashboard_kpis,
}


# Queries that write a table while they are built and read it for their result.
STAGED = {
    "contract_gate_dataset",
    "silver_duplicate_review",
    "quality_profile",
    "flights_in_departure_order",
    "built_route_performance",
    "built_inventory",
}


def _pinned_to_utc(fn: Query) -> Query:
    """Pin the session zone before any frame is built: casts resolve their
    time zone when the DataFrame is created."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf)

    return run


QUERIES = {name: _pinned_to_utc(fn) for name, fn in QUERIES.items()}

"""Gold table catalog (S14) and the dashboard loader with demo fallback
(S15, S16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolith import contracts
from aerolith.operators import gold
from aerolith.operators import validation as V
from aerolith.operators.silver import clean_source
from aerolith.sources import synthetic
from aerolith.sources.raw import require_path
from aerolith.sources.versioned import open_table

# Dashboard table name → gold table name.
GOLD_TABLE_NAMES = {
    "flight_performance": "gold_flight_performance",
    "route_performance": "gold_route_performance",
    "airport_disruption": "gold_airport_disruption",
    "passenger_communication": "gold_passenger_communication",
}


def load_gold_tables(spark: SparkSession, gold_dir: str) -> dict[str, DataFrame]:
    """Read the four gold tables; a missing one raises naming it."""
    tables = {}
    for name, table in GOLD_TABLE_NAMES.items():
        path = f"{gold_dir.rstrip('/')}/{table}"
        require_path(spark, path, "gold")
        tables[name] = open_table(spark, path)
    return tables


def demo_tables(spark: SparkSession, flight_count: int = synthetic.DEFAULT_FLIGHT_COUNT) -> dict[str, DataFrame]:
    """S16, re-aimed: the gold tables built lazily from the synthetic
    sources with the same operators as the batch jobs."""
    silver = {}
    for source, raw in synthetic.raw_sources(spark, flight_count).items():
        typed = V.typed_records(source, V.parse_records(raw))
        silver[source] = clean_source(source, typed)
    built = gold.build_gold_tables(
        silver[contracts.FLIGHTS],
        silver[contracts.AIRPORTS],
        silver[contracts.WEATHER],
        silver[contracts.PASSENGER_EVENTS],
    )
    return {name: built[table] for name, table in GOLD_TABLE_NAMES.items()}


def load_dashboard_tables(spark: SparkSession, gold_dir: str) -> tuple[dict[str, DataFrame], bool]:
    """The gold tables, or the demo tables where one is missing. Returns
    ``(tables, using_demo)``. Tables that exist but cannot be read raise."""
    try:
        return load_gold_tables(spark, gold_dir), False
    except FileNotFoundError:
        return demo_tables(spark), True

"""Batch jobs: ingest (K1), bronze (K2), silver (K3), gold (K4).

Paths are plain strings handed to Spark, so every job runs unchanged on any
Hadoop file system or object store. Each job takes an optional session and
stops it only if it created it. Row counts come from ``Observation`` metrics
on the write itself (S17), so no dataset is evaluated twice.

Lineage: validated raw records are written once, a folder per verdict, and the
accepted, quarantine and error outputs read that table; the gate and the summary
take their counts from the write, so the JSON parse and rule evaluation run once
per record. Gold rollups are
computed from silver flights, not from the written enriched table.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerolith import contracts
from aerolith.operators import gold as gold_ops
from aerolith.operators import validation as V
from aerolith.operators.routing import RECORD_CODEC, VERDICT, route
from aerolith.operators.silver import clean_source
from aerolith.session import build_session, ensure_utc
from aerolith.sources import landed, synthetic
from aerolith.sources.jsonarray import read_json_array
from aerolith.sources.raw import path_exists, read_json_lines, require_path, write_lines
from aerolith.sources.versioned import inventory, is_versioned, open_table, publish

GOLD_TABLES = (
    "gold_flight_performance",
    "gold_route_performance",
    "gold_airport_disruption",
    "gold_passenger_communication",
)


def _join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def _distinct_paths(src: str, dst: str) -> None:
    if src.rstrip("/") == dst.rstrip("/"):
        raise ValueError(f"Output path must differ from input path: {dst}")


def write_observed(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> int:
    """Overwrite ``path`` with ``df`` and return the written row count,
    measured on the write itself."""
    obs = Observation()
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get.get("rows", 0))


def write_table(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), versioned: bool = False, replace: str = "table"
) -> int:
    """Write a layer's table and return its row count: in place, or as the next
    version of a versioned table (``sources.versioned``), whose older versions
    stay readable whatever happens to the job. Rows of a partitioned table are
    rebalanced by partition first: a task writes few partitions, and AQE splits
    the large ones."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if versioned:
        return publish(df, path, partition_by, replace).rows
    if replace != "table":
        raise ValueError("only versioned tables replace single partitions")
    return write_observed(df, path, partition_by=partition_by)


def with_flight_date(df: DataFrame) -> DataFrame:
    """UTC departure date, the partition column of date-partitioned flight
    tables (readers filtering on it skip whole directories)."""
    return df.withColumn("flight_date", F.to_date("scheduled_departure_utc"))


def write_summary(spark: SparkSession, rows: list[dict], output_dir: str, name: str = "_build_summary") -> None:
    """A small summary table (one row per source/table) as JSON."""
    if rows:
        spark.createDataFrame(rows).coalesce(1).write.mode("overwrite").json(_join(output_dir, name))


def total_records(rows: list[dict]) -> int:
    """Total written rows of a job summary (all sources / tables)."""
    return sum(int(r.get("row_count", 0)) for r in rows)


class _Session:
    def __init__(self, spark: SparkSession | None):
        self.owned = spark is None
        self.spark = spark or build_session()
        ensure_utc(self.spark)

    def __enter__(self) -> SparkSession:
        return self.spark

    def __exit__(self, *exc) -> None:
        if self.owned:
            self.spark.stop()


# --- K1 ingest -----------------------------------------------------------------


def _or_synthetic(read, synthetic_frame, source: str, allow_synthetic: bool, fallbacks: dict[str, str]) -> DataFrame:
    """What ``read`` gives; if its path does not exist and that is allowed, the
    synthetic source, noted in ``fallbacks``. Anything else raises."""
    try:
        return read()
    except FileNotFoundError as missing:
        if not allow_synthetic:
            raise
        fallbacks[source] = str(missing)
        return synthetic_frame()


def _raw_json(frame: DataFrame) -> DataFrame:
    # Null fields stay in the record: an empty value is not a missing key.
    return frame.select(F.to_json(F.struct(*frame.columns), {"ignoreNullFields": "false"}).alias("value"))


def source_records(
    spark: SparkSession,
    airport_source: str = "synthetic",
    weather_source: str = "synthetic",
    airport_csv: str | None = None,
    weather_payloads: str | None = None,
    flight_count: int = synthetic.DEFAULT_FLIGHT_COUNT,
    airport_codes: Sequence[str] | None = None,
    max_weather_airports: int | None = None,
    allow_synthetic: bool = False,
    fallbacks: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Raw records per source. ``airport_codes`` and
    ``max_weather_airports`` narrow the landed sources (default: all). With
    ``allow_synthetic`` a landed path that does not exist gives the synthetic
    source instead, and ``fallbacks`` says so. Unknown source names raise."""
    for name, known in ((airport_source, ("synthetic", "csv")), (weather_source, ("synthetic", "hourly"))):
        if name not in known:
            raise ValueError(f"Unsupported source: {name}")
    noted = {} if fallbacks is None else fallbacks
    raw = synthetic.raw_sources(spark, flight_count)
    if airport_source == "csv":
        airports = _or_synthetic(
            lambda: landed.read_airport_csv(spark, airport_csv or "airports.csv", airport_codes),
            lambda: synthetic.airports(spark),
            contracts.AIRPORTS,
            allow_synthetic,
            noted,
        )
    else:
        airports = synthetic.airports(spark)
    if weather_source == "hourly":
        chosen = landed.weather_airports(airports, max_weather_airports).select("airport_code")
        weather = _or_synthetic(
            lambda: landed.read_hourly_weather(spark, weather_payloads or "weather").join(chosen, "airport_code", "left_semi"),
            lambda: synthetic.weather(spark),
            contracts.WEATHER,
            allow_synthetic,
            noted,
        )
    else:
        weather = synthetic.weather(spark)
    raw[contracts.AIRPORTS], raw[contracts.WEATHER] = _raw_json(airports), _raw_json(weather)
    return raw


def landed_records(spark: SparkSession, landing_dir: str, fmt: str = "jsonl") -> dict[str, DataFrame]:
    """Raw records of every source from ``landing_dir/<source>``: JSON Lines
    (``fmt="jsonl"``, splittable) or files holding one JSON array each
    (``fmt="array"``, messages cite the record index)."""
    if fmt not in ("jsonl", "array"):
        raise ValueError(f"fmt must be 'jsonl' or 'array', got {fmt!r}")
    reader = read_json_lines if fmt == "jsonl" else read_json_array
    return {source: reader(spark, _join(landing_dir, source)) for source in contracts.SOURCES}


def ingest(
    output_dir: str,
    records: Mapping[str, DataFrame] | None = None,
    spark: SparkSession | None = None,
    mode: str = "dataset",
    **source_options,
) -> list[dict]:
    """K1: validate every source, land accepted records as JSON Lines (gzip) under
    ``output_dir/<source>``, rejected records under ``_quarantine`` (record
    mode), every message under ``_errors`` and the per-source summary under
    ``_validation_summary``. Every record with its ``errors`` is kept under
    ``_validated``, one folder per verdict (the one evaluation of the rules that
    all other outputs read, and an audit trail). Returns the summary rows (one per source), which
    say where a synthetic source stood in for a missing landed one."""
    with _Session(spark) as s:
        fallbacks: dict[str, str] = {}
        recs = dict(records) if records is not None else source_records(s, fallbacks=fallbacks, **source_options)
        summaries = []
        for source, raw in recs.items():
            routed = route(source, raw, _join(output_dir, "_validated", source))
            accepted, rejected = routed.gate(mode)
            write_lines(accepted.select("value"), _join(output_dir, source))
            if mode == "record":
                quarantine = rejected.drop(VERDICT).write.mode("overwrite").options(**RECORD_CODEC)
                quarantine.parquet(_join(output_dir, "_quarantine", source))
            write_lines(routed.messages(), _join(output_dir, "_errors", source), "json")
            summaries.append(routed.summary(mode).withColumn("synthetic_fallback", F.lit(source in fallbacks)))
        summary = summaries[0]
        for f in summaries[1:]:
            summary = summary.unionByName(f)
        summary.coalesce(1).write.mode("overwrite").json(_join(output_dir, "_validation_summary"))
        return [r.asDict() for r in summary.collect()]  # one row per source


# --- K2 bronze -------------------------------------------------------------------


def raw_source_path(spark: SparkSession, raw_dir: str, source: str) -> tuple[str, bool]:
    """``raw_dir/<source>`` (JSON Lines, as landed by ``ingest``) or, for raw
    folders in the batch pipeline's layout, ``raw_dir/<source>.json`` holding
    one JSON array. Returns (path, is_array_file)."""
    lines = _join(raw_dir, source)
    array_file = _join(raw_dir, f"{source}.json")
    if not path_exists(spark, lines) and path_exists(spark, array_file):
        return array_file, True
    return lines, False


def bronze_frame(spark: SparkSession, raw_dir: str, source: str) -> DataFrame:
    """S1 + S3: contract-typed records with load time and source file."""
    path, is_array = raw_source_path(spark, raw_dir, source)
    raw = read_json_array(spark, path) if is_array else read_json_lines(spark, path)
    typed = V.typed_records(source, V.parse_records(raw), keep=("_source_file",))
    return typed.select(*contracts.field_names(source), F.current_timestamp().alias("_bronze_loaded_at_utc"), "_source_file")


def build_bronze(raw_dir: str, output_dir: str, spark: SparkSession | None = None, versioned: bool = False) -> list[dict]:
    """K2. ``versioned`` (here and below): tables are written as new versions."""
    _distinct_paths(raw_dir, output_dir)
    with _Session(spark) as s:
        for source in contracts.SOURCES:
            require_path(s, raw_source_path(s, raw_dir, source)[0], "raw")
        rows = []
        for source in contracts.SOURCES:
            out = _join(output_dir, source)
            n = write_table(bronze_frame(s, raw_dir, source), out, versioned=versioned)
            rows.append(
                {"source": source, "input_path": raw_source_path(s, raw_dir, source)[0], "output_path": out, "row_count": n}
            )
        write_summary(s, rows, output_dir)
        return rows


# --- K3 silver ---------------------------------------------------------------------


def build_silver(
    bronze_dir: str,
    output_dir: str,
    spark: SparkSession | None = None,
    missing_delay: str = "zero",
    cancelled_delay: str = "keep",
    partition_by_date: bool = False,
    versioned: bool = False,
    replace: str = "table",
) -> list[dict]:
    """K3. ``partition_by_date`` writes flights partitioned by ``flight_date``
    (an added column) for date-pruned reads of very large histories;
    ``replace="partitions"`` then rewrites only the dates of this build."""
    _distinct_paths(bronze_dir, output_dir)
    with _Session(spark) as s:
        for source in contracts.SOURCES:
            require_path(s, _join(bronze_dir, source), "bronze")
        rows = []
        for source in contracts.SOURCES:
            frame = open_table(s, _join(bronze_dir, source))
            options = {"missing_delay": missing_delay, "cancelled_delay": cancelled_delay} if source == "flights" else {}
            cleaned = clean_source(source, frame, with_load_time=True, **options)
            out = _join(output_dir, source)
            parts: tuple[str, ...] = ()
            if partition_by_date and source == contracts.FLIGHTS:
                cleaned, parts = with_flight_date(cleaned), ("flight_date",)
            n = write_table(cleaned, out, parts, versioned, replace if parts else "table")
            rows.append({"source": source, "output_path": out, "row_count": n})
        write_summary(s, rows, output_dir)
        return rows


# --- K4 gold -------------------------------------------------------------------------


def build_gold(
    silver_dir: str,
    output_dir: str,
    spark: SparkSession | None = None,
    partition_by_date: bool = False,
    weather_mode: str = "first",
    versioned: bool = False,
) -> list[dict]:
    """K4. ``partition_by_date`` writes gold_flight_performance partitioned by
    ``flight_date``; ``weather_mode="asof"`` enriches each flight with the
    weather as of its departure instead of the airport's first observation."""
    _distinct_paths(silver_dir, output_dir)
    with _Session(spark) as s:
        for source in contracts.SOURCES:
            require_path(s, _join(silver_dir, source), "silver")
        read = {src: open_table(s, _join(silver_dir, src)) for src in contracts.SOURCES}
        # Flights and both airport roles keep their load columns in the enriched table.
        tables = gold_ops.build_gold_tables(
            read[contracts.FLIGHTS].drop("flight_date"),
            read[contracts.AIRPORTS],
            read[contracts.WEATHER],
            read[contracts.PASSENGER_EVENTS],
            with_load_time=True,
            weather_mode=weather_mode,
        )
        rows = []
        for name in GOLD_TABLES:
            out = _join(output_dir, name)
            frame, parts = tables[name], ()
            if partition_by_date and name == "gold_flight_performance":
                frame, parts = with_flight_date(frame), ("flight_date",)
            rows.append({"table": name, "output_path": out, "row_count": write_table(frame, out, parts, versioned)})
        write_summary(s, rows, output_dir)
        return rows


# --- data-quality profile of the written layers (A11, A12) ----------------------


def build_profile(silver_dir: str, gold_dir: str, output_dir: str, spark: SparkSession | None = None) -> list[dict]:
    """Profile (A11) and inventory (A12) of the written silver and gold
    tables, written under ``output_dir/quality_profile`` and
    ``output_dir/dataset_inventory``. The inventory of versioned tables comes
    from their commit files."""
    from aerolith.operators import quality
    from aerolith.sources.catalog import GOLD_TABLE_NAMES, load_gold_tables

    with _Session(spark) as s:
        for source in contracts.SOURCES:
            require_path(s, _join(silver_dir, source), "silver")
        layers = {
            "silver": {src: open_table(s, _join(silver_dir, src)) for src in contracts.SOURCES},
            "gold": load_gold_tables(s, gold_dir),
        }
        paths = {
            "silver": {src: _join(silver_dir, src) for src in contracts.SOURCES},
            "gold": {name: _join(gold_dir, table) for name, table in GOLD_TABLE_NAMES.items()},
        }
        if all(is_versioned(s, path) for tables in paths.values() for path in tables.values()):
            counted = inventory(s, paths).select("layer", "dataset", "rows", "columns")
        else:
            counted = quality.inventory_layers(layers)
        profile = quality.profile_layers(layers)
        n = write_observed(profile.coalesce(1), _join(output_dir, "quality_profile"))
        m = write_observed(counted.coalesce(1), _join(output_dir, "dataset_inventory"))
        return [
            {"table": "quality_profile", "row_count": n},
            {"table": "dataset_inventory", "row_count": m},
        ]


# --- reports over a written gold folder (R1–R3) -------------------------------


def build_report(gold_dir: str, name: str, output_dir: str, spark: SparkSession | None = None) -> list[dict]:
    """Run report ``name`` (route_delay, airport_disruption,
    passenger_communication) over the written gold tables and write its
    rows, in report order, as one JSON file under ``output_dir/<name>``."""
    from aerolith.plans.reports import report, run_report

    table = report(name).table
    with _Session(spark) as s:
        path = _join(gold_dir, table)
        require_path(s, path, "gold")
        result = run_report(name, open_table(s, path))
        # A report is one row per route / airport / segment: small, so one
        # ordered file is written (coalesce keeps the sort order).
        n = write_observed(result.coalesce(1), _join(output_dir, name), fmt="json")
        return [{"report": name, "row_count": n}]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one layer of the batch build.")
    parser.add_argument("layer", choices=["ingest", "bronze", "silver", "gold", "profile", "report"])
    parser.add_argument("--name", help="report: route_delay | airport_disruption | passenger_communication")
    parser.add_argument("--weather-mode", default="first", choices=["first", "asof"], help="gold: weather enrichment")
    parser.add_argument("--gold", help="profile: gold directory (--input is the silver directory)")
    parser.add_argument("--input", help="input directory (bronze/silver/gold)")
    parser.add_argument("--output", required=True)
    parser.add_argument("--mode", default="dataset", choices=["dataset", "record"])
    parser.add_argument("--airport-source", default="synthetic")
    parser.add_argument("--weather-source", default="synthetic")
    parser.add_argument("--airport-csv")
    parser.add_argument("--weather-payloads")
    parser.add_argument("--airport-codes", nargs="+", help="ingest: only these airports of the CSV (default: all)")
    parser.add_argument("--max-weather-airports", type=int, help="ingest: only the first airports by code (default: all)")
    parser.add_argument("--allow-synthetic", action="store_true", help="ingest: synthetic data for a landed path that is missing")
    parser.add_argument("--versioned", action="store_true", help="bronze/silver/gold: write new table versions")
    parser.add_argument("--landing", help="ingest: folder with one sub-folder of raw files per source")
    parser.add_argument("--format", default="jsonl", choices=["jsonl", "array"])
    args = parser.parse_args(argv)
    if args.layer == "ingest" and args.landing:
        with _Session(None) as s:
            result = ingest(args.output, records=landed_records(s, args.landing, args.format), spark=s, mode=args.mode)
    elif args.layer == "ingest":
        result = ingest(
            args.output,
            mode=args.mode,
            airport_source=args.airport_source,
            weather_source=args.weather_source,
            airport_csv=args.airport_csv,
            weather_payloads=args.weather_payloads,
            airport_codes=args.airport_codes,
            max_weather_airports=args.max_weather_airports,
            allow_synthetic=args.allow_synthetic,
        )
    elif args.layer == "profile":
        result = build_profile(args.input, args.gold, args.output)
    elif args.layer == "report":
        result = build_report(args.input, args.name, args.output)
    elif args.layer == "gold":
        result = build_gold(args.input, args.output, weather_mode=args.weather_mode, versioned=args.versioned)
    else:
        job = {"bronze": build_bronze, "silver": build_silver}[args.layer]
        result = job(args.input, args.output, versioned=args.versioned)
    for row in result:
        print(row)


if __name__ == "__main__":
    main()


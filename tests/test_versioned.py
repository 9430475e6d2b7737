"""Versioned tables: commits, killed writers, single partitions, inventory."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aerolith.plans import jobs
from aerolith.sources import versioned as t


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, day string, v double")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_versions_follow_each_other(spark, scratch):
    path = f"{scratch}/table/"
    first = t.publish(frame(spark, [(1, "a", 0.5), (2, "b", None)]), path)
    second = t.publish(frame(spark, [(3, "c", 1.5)]).withColumn("more", F.lit(True)), path)
    assert (first.version, first.rows, second.version, second.columns) == (1, 2, 2, ["k", "day", "v", "more"])
    assert rows_of(t.open_table(spark, path)) == [(3, "c", 1.5, True)]
    assert rows_of(t.open_table(spark, path, version=1)) == [(1, "a", 0.5), (2, "b", None)]
    with pytest.raises(FileNotFoundError):
        t.open_table(spark, path, version=3)
    empty = t.publish(frame(spark, []), path)
    assert empty.rows == 0 and t.open_table(spark, path).columns == ["k", "day", "v"] and t.open_table(spark, path).count() == 0


def test_a_write_that_dies_leaves_the_old_version(spark, scratch):
    path = f"{scratch}/table"
    t.publish(frame(spark, [(1, "a", 0.5)]), path)
    broken = spark.range(100).select(
        "id", F.when(F.col("id") == 99, F.raise_error(F.lit("killed")).cast("string")).otherwise("x").alias("day"), F.lit(1.0).alias("v")
    )
    with pytest.raises(Exception, match="killed"):
        t.publish(broken.repartition(4), path)
    # A writer killed between data and commit leaves a folder that no version names.
    frame(spark, [(9, "z", 9.0)]).write.parquet(f"{path}/data/part=dead")
    Path(f"{path}/_commits/.draft").write_text("{half")
    assert t.commits(spark, path) == [1] and rows_of(t.open_table(spark, path)) == [(1, "a", 0.5)]
    t.publish(frame(spark, [(2, "a", 0.5)]), path)
    gone = t.vacuum(spark, path, keep=1)
    assert "part=dead" in gone and len(gone) >= 2 and t.commits(spark, path) == [2]
    assert rows_of(t.open_table(spark, path)) == [(2, "a", 0.5)]


def test_the_second_writer_of_a_version_raises(spark, scratch, monkeypatch):
    path = f"{scratch}/table"
    t.publish(frame(spark, [(1, "a", 0.5)]), path)
    stale = t.read_commit(spark, path)
    t.publish(frame(spark, [(2, "b", 0.5)]), path)
    monkeypatch.setattr(t, "read_commit", lambda *_: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        t.publish(frame(spark, [(3, "c", 0.5)]), path)
    monkeypatch.undo()
    assert rows_of(t.open_table(spark, path)) == [(2, "b", 0.5)]


def test_one_new_day_rewrites_one_partition(spark, scratch):
    path = f"{scratch}/dated"
    days = ["2025-11-01", "2025-11-02", None, "a/b: c"]
    first = t.publish(frame(spark, [(i, d, 1.0) for i, d in enumerate(days * 3)]), path, ("day",))
    assert sorted(first.folders.values()) == [3, 3, 3, 3]
    second = t.publish(frame(spark, [(50, "2025-11-02", 2.0), (51, "2025-11-03", 2.0)]), path, ("day",), "partitions")
    kept = {f for f in first.folders if f in second.folders}
    assert len(kept) == 3 and len(second.folders) == 5 and second.rows == 11
    got = rows_of(t.open_table(spark, path).select("day", "k"))
    wanted = [(d, i) for i, d in enumerate(days * 3) if d != "2025-11-02"] + [("2025-11-02", 50), ("2025-11-03", 51)]
    assert got == sorted(wanted, key=repr)
    assert t.open_table(spark, path, version=1).count() == 12
    plan = t.open_table(spark, path).where("day = '2025-11-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    nothing = t.publish(frame(spark, []), path, ("day",), "partitions")
    assert nothing.folders == second.folders and nothing.version == 3
    for rows, by, replace in (([], (), "partitions"), ([], ("k",), "partitions"), ([], ("day",), "some")):
        with pytest.raises(ValueError):
            t.publish(frame(spark, rows), path, by, replace)
    with pytest.raises(ValueError, match="schema"):
        t.publish(frame(spark, []).withColumn("k", F.lit("x")), path, ("day",), "partitions")


def test_inventory_reads_no_table(spark, scratch):
    t.publish(frame(spark, [(1, "a", 0.5), (2, "b", 0.5)]), f"{scratch}/silver/x", ("day",))
    t.publish(frame(spark, [(1, "a", 0.5)]), f"{scratch}/gold/y")
    paths = {"silver": {"x": f"{scratch}/silver/x"}, "gold": {"y": f"{scratch}/gold/y"}}
    for file in Path(scratch).rglob("*.parquet"):
        file.write_text("no Parquet file any more")
    got = [tuple(r) for r in t.inventory(spark, paths).collect()]
    assert got == [("silver", "x", 2, 3, 2, 1), ("gold", "y", 1, 3, 0, 1)]
    with pytest.raises(FileNotFoundError):
        t.inventory(spark, {"gold": {"z": f"{scratch}/gold/z"}})


def test_layers_are_built_as_versions(spark, scratch):
    at = {name: f"{scratch}/{name}" for name in ("raw", "bronze", "silver", "gold")}
    jobs.ingest(at["raw"], spark=spark)
    for _ in range(2):
        jobs.build_bronze(at["raw"], at["bronze"], spark=spark, versioned=True)
    jobs.build_silver(at["bronze"], at["silver"], spark=spark, partition_by_date=True, versioned=True)
    rows = jobs.build_gold(at["silver"], at["gold"], spark=spark, partition_by_date=True, versioned=True)
    assert {r["table"]: r["row_count"] for r in rows}["gold_flight_performance"] == 720
    assert t.commits(spark, f"{at['bronze']}/flights") == [1, 2]
    flights = f"{at['silver']}/flights"
    before = t.read_commit(spark, flights)
    # A build of one day's records replaces that day only.
    day = t.open_table(spark, flights).agg(F.min("flight_date")).first()[0]
    bronze = t.open_table(spark, f"{at['bronze']}/flights").where(F.to_date("scheduled_departure_utc") == F.lit(day))
    one = f"{scratch}/one-day"
    for source in ("airports", "weather", "passenger_events"):
        t.publish(t.open_table(spark, f"{at['bronze']}/{source}"), f"{one}/{source}")
    t.publish(bronze, f"{one}/flights")
    jobs.build_silver(one, at["silver"], spark=spark, partition_by_date=True, versioned=True, replace="partitions")
    after = t.read_commit(spark, flights)
    changed = {f.split("/")[1] for f in before.folders.keys() ^ after.folders.keys()}
    assert changed == {f"flight_date={day}"} and after.rows == before.rows
    profile = jobs.build_profile(at["silver"], at["gold"], f"{scratch}/profile", spark=spark)
    assert {r["table"]: r["row_count"] for r in profile} == {"quality_profile": 8, "dataset_inventory": 8}
    counts = {(r.layer, r.dataset): r["rows"] for r in spark.read.parquet(f"{scratch}/profile/dataset_inventory").collect()}
    assert counts["silver", "flights"] == 720 and counts["gold", "route_performance"] == 6
    assert jobs.build_report(at["gold"], "route_delay", f"{scratch}/reports", spark=spark) == [{"report": "route_delay", "row_count": 6}]

"""Hot keys: one key holds a third of all rows. Results must stay whole and
exact; the plans reduce the hot key before the shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import gold
from aerolith.operators.dedupe import deduplicate, duplicates_for_review
from aerolith.sources import testmap as tm

N = 90_000


def test_dedupe_with_hot_key(spark):
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("flight_id"),
        (F.col("id") % 1000).alias("v"),
    )
    out = deduplicate(df, ["flight_id"])
    assert out.count() == N - N // 3 + 1
    assert out.where("flight_id = 'HOT'").collect()[0].v == 0  # first of the total order
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # partial top-1 per key before the shuffle


def test_flights_once_are_the_survivors_of_all_pairs(spark, scratch):
    """Keys repeat in every table, are missing in some, and a third of all lines
    are of one flight; lines and orders without partner come to nothing."""

    def some(k, n):
        return F.when(F.col("id") % n != 0, k)

    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(7)).otherwise(i * 31 % 401)
    number = F.when(i % 3 == 0, F.lit(2)).otherwise(some((i * 17 % 5).cast("int"), 11))
    tables = {
        "lineitem": spark.range(6000).select(
            some(key, 97).alias("l_orderkey"), number.alias("l_linenumber"), (i * 7919 % 997).alias("l_partkey"),
            some(i * 13 % 23, 41).alias("l_suppkey"), (i * 29 % 50).cast("double").alias("l_quantity"),
            (i * 5 % 7 / 100).alias("l_tax"), (i % 9 / 80).alias("l_discount"),
        ),
        "orders": spark.range(900).select(
            some(i * 3 % 390, 53).alias("o_orderkey"), (i * 11 % 61).alias("o_custkey"),
            some(F.element_at(F.array(*map(F.lit, "OFP")), (i * 7 % 3 + 1).cast("int")), 5).alias("o_orderstatus"),
        ),
        "supplier": spark.range(40).select((i % 20).alias("s_suppkey"), some((i * 7 % 25).cast("int"), 6).alias("s_nationkey")),
        "customer": spark.range(80).select((i % 50).alias("c_custkey"), some((i * 9 % 25).cast("int"), 7).alias("c_nationkey")),
    }
    for name, df in tables.items():
        df.repartition(3).write.parquet(f"{scratch}/{name}.parquet")
    extra = ("o_orderstatus", "l_orderkey", "l_linenumber")
    pairs = tm.bronze_flights(spark, scratch, extra)
    wanted, got = deduplicate(pairs, ["flight_id"]), tm.bronze_flights_once(spark, scratch, extra)
    assert got.schema == wanted.schema and 500 < got.count() == wanted.count() < pairs.count() / 4
    assert got.exceptAll(wanted).count() == wanted.exceptAll(got).count() == 0
    for side in ("origin_airport", "destination_airport", "o_orderstatus", "l_linenumber"):
        assert 0 < got.where(F.col(side).isNull()).count() < got.count()


def test_landed_flights_are_shuffled_before_their_texts_are_made(spark):
    flights = tm.landed_once(spark, "/root/testdata/sf0.001")["flights"]
    plan = flights._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(l_orderkey" in plan and "hashpartitioning(flight_id" not in plan
    # One row per key and task, of lines and of orders, before either is shuffled.
    assert plan.count("row_number(), 1, Partial") == 2
    assert flights.count() == tm.bronze_flights(spark, "/root/testdata/sf0.001").select("flight_id").distinct().count()


def test_review_of_a_row_with_millions_of_copies(spark):
    n = 10_000_000
    df = spark.range(n).select(F.lit("HOT").alias("flight_id"), F.lit(7).alias("v"))
    out = duplicates_for_review(df, ["flight_id"])
    tasks = out.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("rows")).collect()
    assert sum(r.rows for r in tasks) == n - 1 and len(tasks) >= 4
    assert max(r.rows for r in tasks) < n / 2
    ranks = out.agg(F.min("duplicate_rank"), F.max("duplicate_rank"), F.approx_count_distinct("duplicate_rank", 0.02)).first()
    assert ranks[0] == 2 and ranks[1] == n and ranks[2] > 0.9 * n


def test_review_of_a_key_with_many_different_rows(spark):
    hot = spark.range(40_000).select(F.lit("HOT").alias("flight_id"), (F.col("id") * 7919 % 30_011).alias("v"))
    rest = spark.createDataFrame([("a", 1), ("b", 2), ("b", None), (None, 3), (None, 3), ("c", 5)], "flight_id string, v long")
    df = hot.unionByName(rest)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 11)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = sorted(map(tuple, duplicates_for_review(df, ["flight_id"], chunk=3).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    by_key = {}
    for r in df.collect():
        by_key.setdefault(r.flight_id, []).append(r.v)
    wanted = []
    for key, values in by_key.items():
        values.sort(key=lambda v: (v is not None, v))
        wanted += [(key, v, rank) for rank, v in enumerate(values, start=1) if rank > 1]
    assert got == sorted(wanted, key=repr)
    assert duplicates_for_review(df.limit(0), ["flight_id"]).count() == 0


def test_positions_need_no_single_task(spark):
    from aerolith.functions.ordering import with_position

    df = spark.range(20_000).select((F.col("id") * 48_271 % 20_011).alias("k"), F.lit("x").alias("x"))
    got = sorted((r.position, r.k) for r in with_position(df, [F.col("k").desc()]).collect())
    values = sorted((i * 48_271 % 20_011 for i in range(20_000)), reverse=True)
    assert got == list(enumerate(values, start=1))
    assert with_position(df.limit(0), [F.col("k").asc()]).count() == 0


def test_communication_rollup_with_hot_flight(spark):
    events = spark.range(N).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit("F0")).otherwise(F.concat(F.lit("F"), (F.col("id") % 50).cast("string"))).alias(
            "flight_id"
        ),
        F.lit("mobile_check_in").alias("event_type"),
        F.lit("web").alias("channel"),
    )
    flights = spark.range(50).select(
        F.concat(F.lit("F"), F.col("id").cast("string")).alias("flight_id"),
        F.lit("GDN").alias("origin_airport"),
        F.lit("FRA").alias("destination_airport"),
        (F.col("id") % 2 == 0).alias("is_delayed"),
        F.lit(False).alias("is_cancelled"),
    )
    got = gold.passenger_communication(events, flights).collect()
    naive = (
        events.join(flights.withColumn("route", F.lit("GDN-FRA")), "flight_id", "left")
        .groupBy("event_type", "channel", "route")
        .agg(F.count("event_id").alias("n"), F.sum(F.col("is_delayed").cast("int")).alias("d"))
        .collect()
    )
    assert sorted((r.route, r.event_count, r.delayed_flight_events) for r in got) == sorted(
        (r.route, r.n, r.d) for r in naive
    )
    assert sum(r.event_count for r in got) == N


def test_weather_asof_with_hot_airport_matches_brute_force(spark):
    from datetime import datetime, timedelta, timezone

    from aerolith.operators.asof import weather_asof

    base = datetime(2026, 5, 1, tzinfo=timezone.utc)
    flights = [(f"F{i}", "HOT" if i % 3 == 0 else f"A{i % 4}", base + timedelta(minutes=37 * i)) for i in range(1500)]
    obs = [(a, base + timedelta(minutes=50 * k + (7 if a == "HOT" else 0)), float(k)) for a in ("HOT", "A1", "A2") for k in range(800)]
    fdf = spark.createDataFrame(flights, "flight_id string, origin_airport string, scheduled_departure_utc timestamp")
    wdf = spark.createDataFrame(
        [(a, t, 0.0, w, 0.0) for a, t, w in obs],
        "airport_code string, observed_at_utc timestamp, temperature_c double, wind_speed_kmh double, precipitation_mm double",
    )
    tol = 3600
    got = {r.flight_id: r.origin_wind_speed_kmh for r in weather_asof(fdf, wdf, tol, "backward").collect()}
    by_airport = {}
    for a, t, w in obs:
        by_airport.setdefault(a, []).append((t, w))
    for fid, airport, t in flights:
        cands = [(ot, w) for ot, w in by_airport.get(airport, []) if timedelta(0) <= t - ot <= timedelta(seconds=tol)]
        expected = max(cands)[1] if cands else None
        assert got[fid] == expected, fid

"""Duplicate counts of the quality profile: exact whatever the digests say."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators import quality

SCHEMA = "a string, b double, c double, d boolean, e array<int>"


def plain(rows):
    seen, duplicates = [], 0
    for row in rows:
        key = repr(tuple(0.0 if x == 0 and isinstance(x, float) else x for x in row))
        duplicates += key in seen
        seen.append(key)
    missing = sum(x is None or x != x for row in rows for x in row)
    return len(rows), duplicates, missing


def profile(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    (r,) = quality.quality_profile(df, "silver", "t").collect()
    assert (r.layer, r.dataset) == ("silver", "t")
    cells = len(rows) * 5
    assert r.missing_value_rate == (r.missing_values / cells if cells else None)
    return r.rows, r.duplicate_rows, r.missing_values


NAN = float("nan")
CASES = {
    "nulls that move by one column": [("x", None, 5.0, True, [1]), ("x", 5.0, None, True, [1]), ("x", 5.0, 5.0, None, [1])],
    "a null against an empty or false value": [("", 0.0, None, False, []), (None, 0.0, 0.0, False, []), ("", None, 0.0, False, None), ("", 0.0, 0.0, None, [])],
    "equal rows with nulls": [(None,) * 5, (None,) * 5, ("x", None, None, None, [None]), ("x", None, None, None, [None])],
    "zeros and NaN": [("x", 0.0, NAN, None, None), ("x", -0.0, NAN, None, None), ("x", 0.0, 1.0, None, None)],
    "none": [],
    "all the same": [("x", 1.0, 2.0, True, [1, 2])] * 50,
}


@pytest.mark.parametrize("case", CASES)
def test_profile_of_odd_rows(spark, case):
    assert profile(spark, CASES[case]) == plain(CASES[case])


def test_profile_of_random_rows(spark):
    random.seed(11)
    pick = lambda *values: random.choice(values)
    rows = [(pick("x", "y", None), pick(1.0, None), pick(1.0, 2.0, None), pick(True, False, None), pick([1], [], None)) for _ in range(300)]
    assert profile(spark, rows) == plain(rows)


def test_colliding_digests_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(quality, "_row_digest", lambda df: [F.lit(1).alias("_high"), F.lit(2).alias("_low")])
    rows = [("x", 1.0, 2.0, True, [1]), ("y", 1.0, 2.0, True, [1]), ("x", 1.0, 2.0, True, [1])]
    assert profile(spark, rows) == plain(rows) == (3, 1, 0)


def test_only_digests_cross_the_shuffle_without_duplicates(spark):
    df = spark.range(100).select("id", F.repeat(F.col("id").cast("string"), 100).alias("wide"))
    counted = df.select(*quality._row_digest(df)).groupBy("_high", "_low").count()
    assert counted.count() == 100 and counted.where("count > 1").count() == 0
    assert quality.quality_profile(df, "a", "b").first().duplicate_rows == 0

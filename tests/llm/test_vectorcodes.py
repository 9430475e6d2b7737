"""Vector codes against a plain version, one row and entry at a time."""

from __future__ import annotations

import hashlib
import math

import pytest

from aerolith.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            found = [nearest(row[p], books[p])[1] for row in cut]
            for e in set(found):
                members = [row[p] for row, f in zip(cut, found) if f == e]
                books[p][e] = [sum(xs) // len(members) for xs in zip(*members)]
    coded = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in row) for row in coded]
    sha = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    per_label = {}
    for (_, _, label), error in zip(kept, errors):
        per_label[label] = per_label.get(label, 0) + error
    return [(i, "".join(f"{e:02x}" for _, e in row), error, per_label[label], sha) for (i, _, label), row, error in zip(kept, coded, errors)]


def compare(spark, rows, schema=SCHEMA):
    key = lambda row: (row[0] is None, row)
    got = [tuple(r) for r in vectorcodes.vector_code_report(spark.createDataFrame(rows, schema).repartition(5)).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_supplied_vectors(spark, table):
    rows = [(r.vec_id, r.embedding, r.label) for r in table("embeddings").collect()]
    compare(spark, rows[:300])


def test_odd_rows(spark):
    good = [(i, [float((i * k) % 7 - 3) / 2 for k in range(32)], i % 3) for i in range(90)]
    odd = [
        (None, [0.5] * 32, None),
        (None, [-0.25] * 32, None),
        (3, good[3][1], 0),  # repeated
        (3, [0.125] * 32, None),
        (-1, None, 1),
        (-2, [None] + [0.0] * 31, 1),
        (-3, [float("nan")] + [0.0] * 31, 1),
        (-4, [float("-inf")] * 32, 1),
    ]
    compare(spark, good + odd)
    compare(spark, good[:3])
    compare(spark, [(1, [0.3] * 16, 1)] * 70 + [(2, [-1000.7] * 16, None)])


def test_empty_and_wrong_shapes(spark):
    compare(spark, [])
    compare(spark, [(1, None, 1), (2, [None] * 16, 1)])
    for rows in ([(1, [0.0] * 16, 1), (2, [0.0] * 32, 1)], [(1, [0.0] * 17, 1)], [(1, [1e30] * 16, 1)]):
        with pytest.raises(Exception, match="components|too large"):
            vectorcodes.vector_code_report(spark.createDataFrame(rows, SCHEMA)).collect()


def test_codes_stand_for_their_entries(spark):
    rows = spark.createDataFrame([(i, [float(i % 4)] * 32, "x") for i in range(40)], "vec_id long, embedding array<double>, code string")
    books = vectorcodes.fit(rows)
    coded = vectorcodes.compress(rows.withColumn("a.b", vectorcodes.F.lit(1)), books)
    assert coded.columns == ["vec_id", "a.b", "code", "error"]
    back = {r.vec_id: (r.vector, r.error) for r in vectorcodes.decompress(coded, books).collect()}
    assert back == {i: ([float(i % 4)] * 32, 0) for i in range(40)}

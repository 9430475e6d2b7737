"""JSON array files over many splits, against the reader of whole files."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import PySparkException

from aerolith.sources.jsonarray import read_json_array, read_json_array_splits
from aerolith.sources.raw import read_json_array_file


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "400")
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def values(df):
    return sorted((r._source_file, int(r._record_ref), json.dumps(json.loads(r.value), sort_keys=True)) for r in df.collect())


def odd_records(n):
    random.seed(5)
    texts = ['a "quoted" {brace}', "}\\", '\\"}', "],[", "{[", "é☃😀}", "", "\n}\n", "\\\\", '"']
    out = []
    for i in range(n):
        record = {"id": i, "t": random.choice(texts) * random.randint(0, 4), random.choice(texts) + "k": [{"x": random.choice(texts)}, [], {}]}
        out.append(record if i % 7 else {})
    return out


@pytest.mark.parametrize("indent, ascii_only", [(None, True), (2, False), (None, False)])
def test_many_splits_give_what_one_task_gives(spark, scratch, small_splits, indent, ascii_only):
    for name, n in (("a", 200), ("b", 1), ("c", 57)):
        with open(f"{scratch}/{name}.json", "w", encoding="utf-8") as f:
            json.dump(odd_records(n), f, indent=indent, ensure_ascii=ascii_only)
    (open(f"{scratch}/none.json", "w").close(), open(f"{scratch}/empty.json", "w").write(" [\n] \n"))
    text = spark.read.option("lineSep", "}").text(scratch)
    assert text.rdd.getNumPartitions() > 20
    got = values(read_json_array_splits(spark, scratch))
    assert got == values(read_json_array_file(spark, scratch)) and len(got) == 258
    assert values(read_json_array(spark, scratch)) == got


BROKEN = [
    '[{"a": 1}, {"b"',
    '[{"a": 1} {"b": 2}]',
    '[{"a": 1}]]',
    '[{"a": 1}] x',
    'x [{"a": 1}]',
    '[{"a": 1}, ]',
    '[, {"a": 1}]',
    '[{"a": 1}, 7, {"b": 2}]',
    '[{"a": 1}, 7]',
    '[{"a": "1}]',
    '[{"a": 1}, {"b": }]',
    '{"a": 1}',
    "null",
    " ",
    '[{"a": 1}',
    '[[{"a": 1}]]',
    '[{"a": 1}}]',
]


@pytest.mark.parametrize("text", BROKEN)
def test_broken_files_raise_and_are_named(spark, scratch, small_splits, text):
    good = json.dumps(odd_records(30))
    for name, content in (("good", good), ("broken", text)):
        with open(f"{scratch}/{name}.json", "w", encoding="utf-8") as f:
            f.write(content)
    with pytest.raises(PySparkException, match="broken.json"):
        read_json_array_splits(spark, scratch).collect()
    with pytest.raises(PySparkException, match="broken.json"):
        read_json_array_splits(spark, scratch).count()


def test_small_files_are_read_whole(spark, scratch):
    with open(f"{scratch}/a.json", "w") as f:
        json.dump(odd_records(5), f)
    plan = read_json_array(spark, scratch)._jdf.queryExecution().executedPlan().toString()
    assert "array-ends" not in plan and len(values(read_json_array(spark, scratch))) == 5

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def importable_in_workers(spark):
    sys.path.insert(0, ROOT) if ROOT not in sys.path else None
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


@pytest.fixture()
def docs_of(spark):
    """Documents from ``(doc_id, text)`` pairs, or an empty table."""

    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture()
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")

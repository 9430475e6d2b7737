"""A corpus pipeline over ``documents``: quality, lines, near-duplicates,
benchmark contamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; each result is written as Parquet and read again as the next stage's
``docs``. All stages but the last return the columns of ``documents``:

1. ``quality`` drops the documents the classifier rejects;
2. ``line_dedup`` drops repeated lines; ``n_chars`` counts the new text;
3. ``near_dedup`` keeps one document of each near-duplicate group;
4. ``decontaminate`` drops documents contaminated by ``benchmark``;
5. ``packing`` returns the packed pieces with their token ids.

Nulls, empty texts and tables, repeated rows and further columns behave as the
docstrings of the five operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import decontaminate, linededup, packing, quality, simhash
from aerolith.llm.queries import importable
from aerolith.session import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = linededup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    return cleaned.select(*docs.columns)


def keep_one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", importable(keep_good_documents)),
    ("line_dedup", importable(drop_repeated_lines)),
    ("near_dedup", importable(keep_one_near_duplicate)),
    ("decontaminate", importable(drop_contaminated)),
    ("packing", importable(pack)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# A classifier and a packing order are not SQL; tests hold run() against a
# brute-force version.
ORACLE_SQL = None

"""One evaluation of the rules, several outputs.

Validated records are written once, into a folder per verdict, and the same
pass counts records, invalid records and errors (``Observation``). Everything
else reads that table: the gate is a choice between its folders, made from the
counts without a further pass; the summary is the counts themselves; accepted
and quarantined records are one folder each, so the other is not read. A task
writes both folders at once: rows are not sorted by verdict, so the raw text of
a long input does not spill.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators import validation as V

VERDICT = "verdict"
ACCEPTED, REJECTED = "accepted", "rejected"
# Raw text and messages take nearly half the room they take with Spark's default.
RECORD_CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}


@dataclass(frozen=True)
class Routed:
    """Written records of a source with their ``errors`` and ``verdict``, and
    what was counted while writing them."""

    source: str
    table: DataFrame
    records: int
    invalid_records: int
    errors: int

    def of(self, verdict: str) -> DataFrame:
        """The records of one verdict: one folder of the table."""
        return self.table.where(F.col(VERDICT) == verdict)

    def only_accepted(self) -> Routed:
        """The source as if its invalid records had been left out beforehand."""
        return replace(self, table=self.of(ACCEPTED), records=self.records - self.invalid_records, invalid_records=0, errors=0)

    def gate(self, mode: str = "dataset") -> tuple[DataFrame, DataFrame]:
        """(accepted, held back), as ``validation.gate`` splits them."""
        if mode == "record":
            return self.of(ACCEPTED), self.of(REJECTED)
        if mode != "dataset":
            raise ValueError(f"mode must be 'dataset' or 'record', got {mode!r}")
        none = self.table.limit(0)
        return (none, self.table) if self.invalid_records else (self.table, none)

    def summary(self, mode: str = "dataset") -> DataFrame:
        """V11 from the counts: one row, no pass over the records."""
        accepted = (0 if self.invalid_records else self.records) if mode == "dataset" else self.records - self.invalid_records
        row = (self.source, self.records, accepted, self.records - accepted, self.errors)
        schema = "source string, records bigint, accepted_records bigint, rejected_records bigint, error_count bigint"
        return self.table.sparkSession.createDataFrame([row], schema)

    def messages(self) -> DataFrame:
        """Every violation in long form; only rejected records are read."""
        return V.error_messages(self.source, self.of(REJECTED))


@contextmanager
def _open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """Let a task keep ``n`` partition folders open instead of sorting by them."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, n)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def route(source: str, raw: DataFrame, path: str, text_col: str = "value", ref_col: str = V.RECORD_REF) -> Routed:
    """Evaluate the rules of ``source`` once and write every record with its
    errors to ``path``, one folder per verdict (an earlier table is replaced)."""
    validated = V.validate(source, raw, text_col, ref_col).drop(V.DOC)
    broken = F.size("errors")
    seen = Observation()
    judged = validated.withColumn(VERDICT, F.when(broken > 0, REJECTED).otherwise(ACCEPTED)).observe(
        seen,
        F.count(F.lit(1)).alias("records"),
        F.count_if(broken > 0).alias("invalid_records"),
        F.coalesce(F.sum(broken), F.lit(0)).alias("errors"),
    )
    with _open_writers(raw.sparkSession, len((ACCEPTED, REJECTED))):
        judged.write.mode("overwrite").options(**RECORD_CODEC).partitionBy(VERDICT).parquet(path)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    stored = T.StructType([*validated.schema.fields, T.StructField(VERDICT, T.StringType())])
    table = raw.sparkSession.read.schema(stored).parquet(path)
    return Routed(source, table, counts["records"], counts["invalid_records"], counts["errors"])

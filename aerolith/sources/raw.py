"""Raw record sources and sinks.

Raw records are landed as JSON Lines: plain files, which Spark splits across
tasks, or gzip files of bounded length, as the jobs here write them. A
file holding one top-level JSON array is read too: here by one task, which
suits small files; ``sources.jsonarray`` cuts large ones into splits.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.validation import RECORD_REF

# Records of a gzip file, which one task reads whole: some 100 MB of text.
RECORDS_PER_FILE = 500_000


def write_lines(df: DataFrame, path: str, fmt: str = "text") -> None:
    """Overwrite ``path`` with ``df`` as lines of text or JSON (``fmt``). Raw
    records repeat their keys and values, so gzip leaves a sixth to a twentieth
    of them; a longer table makes more files, not longer ones."""
    writer = df.write.mode("overwrite").format(fmt)
    writer.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).save(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One raw record per line: ``value`` (text) and ``_source_file``."""
    require_path(spark, path, "raw")
    return (
        spark.read.text(path)
        .where(F.trim(F.col("value")) != F.lit(""))
        .select("value", F.col("_metadata.file_path").alias("_source_file"))
    )


def read_json_array_file(spark: SparkSession, path: str) -> DataFrame:
    """Records of files that each hold one JSON array; ``_record_ref`` is the
    record's position in its file (what validation messages cite). A file that
    is not one whole JSON array fails the job, naming the file; a file of no
    bytes holds no records."""
    require_path(spark, path, "raw")
    files = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("_source_file")
    )
    records = F.from_json("value", "array<string>")
    broken = F.raise_error(F.concat(F.lit("Not a JSON array of records: "), F.col("_source_file")))
    return files.select(
        "_source_file",
        F.posexplode(F.when(records.isNull(), broken.cast("array<string>")).otherwise(records)).alias(RECORD_REF, "value"),
    ).select("value", F.col(RECORD_REF).cast("string").alias(RECORD_REF), "_source_file")


def records_frame(spark: SparkSession, records: Iterable[Mapping[str, object]]) -> DataFrame:
    """Small in-memory record lists (tests, examples): JSON text plus the
    record's list position as ``_record_ref``."""
    rows = [(json.dumps(r), str(i)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, f"value string, {RECORD_REF} string")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path))


def require_path(spark: SparkSession, path: str, layer: str) -> None:
    """Fail fast, naming the layer and dataset, when an input is missing.
    Uses the Hadoop file system of the path, so it works on object stores."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Missing {layer} input dataset: {path}")

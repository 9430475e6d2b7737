"""Tables of immutable data folders and commit files.

    <table>/data/part=<id>/…                      one folder per write
    <table>/data/part=<id>/flight_date=2024-01-05/…   of a dated table
    <table>/_commits/00000000000000000007.json    what version 7 consists of

A write goes to a folder of its own and counts its rows on the way
(``Observation``); only then is the next commit file made, under a temporary
name and renamed. Readers take the newest commit, so a job killed in between
leaves the old version readable, and what it wrote is never seen. Of two writers
of the same version the second raises, where the store's rename refuses an
existing target.

A dated table replaces the partitions that the new rows have and keeps the
folders of all others: one new day rewrites one partition. Which partitions a
write has comes from the folders it made, so no rows are read again.

The commit holds row counts, columns and their types, per partition where there
are any: an inventory of written tables (A12) reads commit files and no data.
Commits are as long as a table has partitions and are handled on the driver.
Old folders stay until ``vacuum`` removes those no kept version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS, DATA, FOLDER = "_commits", "data", "part"
# A fifth to a third smaller than with Spark's default, of every version kept.
CODEC = "zstd"


@dataclass(frozen=True)
class Commit:
    """A version: its schema, and the folders (below ``data``) it is made of
    with their row counts."""

    version: int
    schema: dict
    partition_by: tuple[str, ...]
    folders: Mapping[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(self.folders.values())

    @property
    def columns(self) -> list[str]:
        return [f["name"] for f in self.schema["fields"]]


class _Files:
    """The Hadoop file system of a path, whatever store it is in."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, file: str, text: str) -> bool:
        """Make ``file`` whole or not at all; false if it exists."""
        target = self.path(file)
        draft = self.path(f"{target.getParent()}/.{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(target) or not self.fs.rename(draft, target):
            self.fs.delete(draft, False)
            return False
        return True

    def delete(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


def _base(path: str) -> str:
    return path.rstrip("/")


def commits(spark: SparkSession, path: str) -> list[int]:
    """Versions of the table, oldest first."""
    names = _Files(spark, path).names(f"{_base(path)}/{COMMITS}")
    return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]


def read_commit(spark: SparkSession, path: str, version: int | None = None) -> Commit | None:
    """The newest commit, or that of ``version``; None if there is none."""
    known = commits(spark, path)
    if not known or (version is not None and version not in known):
        return None
    at = known[-1] if version is None else version
    said = json.loads(_Files(spark, path).read(f"{_base(path)}/{COMMITS}/{at:020d}.json"))
    return Commit(at, said["schema"], tuple(said["partition_by"]), said["folders"])


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(commits(spark, path))


def _partition_rows(spark: SparkSession, folder: str, names: list[str], partition_by: tuple[str, ...]) -> dict[str, int]:
    """Rows per partition folder, from the footers of the files just written:
    no column is read."""
    written = spark.read.option("basePath", folder).parquet(folder)
    counted = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    rows = dict.fromkeys(names, 0)
    for r in counted.collect():  # one row per file
        rows["/".join(map(unquote, r.file.split("/")[-1 - len(partition_by) : -1]))] += r.n
    return rows


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), replace: str = "table") -> Commit:
    """Write ``df`` as the next version. ``replace="table"``: the version is
    these rows; ``"partitions"``: they replace the partitions they have, and all
    others stay. At most one level of ``partition_by`` per column; a table keeps
    the partition columns and schema it began with when partitions are replaced."""
    if replace not in ("table", "partitions"):
        raise ValueError(f"replace must be 'table' or 'partitions', got {replace!r}")
    if replace == "partitions" and not partition_by:
        raise ValueError("replacing partitions needs partition columns")
    spark, base = df.sparkSession, _base(path)
    before = read_commit(spark, path)
    schema = json.loads(df.schema.json())
    if before and replace == "partitions":
        if before.partition_by != tuple(partition_by):
            raise ValueError(f"the table is partitioned by {before.partition_by}, not {tuple(partition_by)}")
        if _types(before.schema) != _types(schema):
            raise ValueError("the new rows' schema differs from the table's")
    folder = f"{FOLDER}={uuid.uuid4().hex}"
    at = f"{base}/{DATA}/{folder}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(at)
    rows = int(seen.get.get("rows", 0))
    files = _Files(spark, base)
    if partition_by and rows:
        folders = {f"{folder}/{p}": n for p, n in _partition_rows(spark, at, _partitions(files, at, len(partition_by)), partition_by).items()}
    else:
        folders = {folder: rows} if not partition_by else {}
    if before and replace == "partitions":
        new = {f.split("/", 1)[1] for f in folders}
        folders = {f: n for f, n in before.folders.items() if f.split("/", 1)[1] not in new} | folders
    version = before.version + 1 if before else 1
    made = {"schema": schema, "partition_by": list(partition_by), "folders": folders}
    if not files.create(f"{base}/{COMMITS}/{version:020d}.json", json.dumps(made, sort_keys=True)):
        raise RuntimeError(f"version {version} of {path} was made by another writer")
    return Commit(version, schema, tuple(partition_by), folders)


def _types(schema: dict) -> dict:
    return {f["name"]: f["type"] for f in schema["fields"]}


def _partitions(files: _Files, folder: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below ``folder``."""
    found = [n for n in files.names(folder) if "=" in n and not n.startswith(".")]
    if depth == 1:
        return found
    return [f"{n}/{rest}" for n in found for rest in _partitions(files, f"{folder}/{n}", depth - 1)]


def open_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version (or ``version``) of a table. A folder without commits
    is read as plain Parquet."""
    commit = read_commit(spark, path, version)
    if commit is None:
        if version is not None:
            raise FileNotFoundError(f"{path} has no version {version}")
        return spark.read.parquet(path)
    schema = T.StructType.fromJson(commit.schema)
    if not commit.folders:
        return spark.createDataFrame([], schema)
    data = f"{_base(path)}/{DATA}"
    at = [f"{data}/{f}" for f in sorted(commit.folders)]
    stored = T.StructType([*schema.fields, T.StructField(FOLDER, T.StringType())])
    return spark.read.schema(stored).option("basePath", data).parquet(*at).select(*[F.col(f"`{c}`") for c in schema.names])


def inventory(spark: SparkSession, layers: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """A12 of written tables: ``layer, dataset, rows, columns, partitions,
    version`` for ``layer -> dataset -> path``, from the commit files alone."""
    rows = []
    for layer, tables in layers.items():
        for dataset, path in tables.items():
            commit = read_commit(spark, path)
            if commit is None:
                raise FileNotFoundError(f"Missing {layer} table: {path}")
            parts = len(commit.folders) if commit.partition_by else 0
            rows.append((layer, dataset, commit.rows, len(commit.columns), parts, commit.version))
    return spark.createDataFrame(rows, "layer string, dataset string, rows bigint, columns int, partitions int, version bigint")


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove commits but the newest ``keep``, and data folders that no kept
    commit names, among them those of writes that never finished. Not to be run
    while a writer is at work. Returns the removed data folders."""
    if keep < 1:
        raise ValueError("keep at least one version")
    files, base = _Files(spark, path), _base(path)
    kept = commits(spark, path)[-keep:]
    used = {f.split("/")[0] for v in kept for f in read_commit(spark, path, v).folders}
    for name in files.names(f"{base}/{COMMITS}"):
        if not (name.endswith(".json") and int(name[:-5]) in kept):
            files.delete(f"{base}/{COMMITS}/{name}")
    gone = [n for n in files.names(f"{base}/{DATA}") if n not in used]
    for name in gone:
        files.delete(f"{base}/{DATA}/{name}")
    return gone

"""Deterministic deduplication by business key (A8) and the duplicate review
side table (X8).

``dropDuplicates`` keeps an arbitrary row per key, and which one survives
changes with the partitioning. Here the survivor is the first row of an
explicit total order, so the result does not depend on partitioning.

Plan shape: ``row_number() over (partition by key order by …) = 1`` is
planned with a partial ``WindowGroupLimit`` before the shuffle, so each map
task forwards at most one row per key; a hot key therefore costs one row per
map task in the shuffle, not all of its duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from aerolith.functions.ordering import PLACE, RANGE, written_in_order
from aerolith.session import materialize

LOAD_ORDER_COLUMNS = ("_bronze_loaded_at_utc", "_source_file")
# Rows of a key that one task ranks, and copies that it lists at a time.
LISTED_TOGETHER = 65_536


def survivor_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> list[Column]:
    """Total order used to pick the survivor.

    Default: load time, then source file (earliest load wins, i.e. file
    order), then every remaining column, ascending with nulls first. Rows that
    tie on all of them are identical, so either survivor gives the same output.
    """
    if order_by is not None:
        return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]
    ordered = [c for c in LOAD_ORDER_COLUMNS if c in df.columns]
    ordered += [c for c in df.columns if c not in ordered and c not in keys]
    return [F.col(c).asc_nulls_first() for c in ordered]


def _ranked(df: DataFrame, keys: Sequence[str], order_by) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*survivor_order(df, keys, order_by))
    return df.withColumn("_dup_rank", F.row_number().over(window))


def deduplicate(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per business key: the first row of the survivor order."""
    return _ranked(df, keys, order_by).where(F.col("_dup_rank") == 1).drop("_dup_rank")


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    """Equal keys, nulls among them, of two aliased tables."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def _carried(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For the keys that go on from one range to the next, how many rows their
    earlier ranges hold: at most one row per range."""
    key = F.struct(*keys)
    ends = table.groupBy(RANGE).agg(F.min_by(key, PLACE).alias("first"), F.max_by(key, PLACE).alias("last"))
    crossing = ends.select(F.explode(F.array("first", "last")).alias("key"), RANGE).distinct()
    crossing = crossing.groupBy("key").agg(F.count(F.lit(1)).alias("ranges")).where("ranges > 1").select("key.*")
    held = table.alias("t").join(F.broadcast(crossing).alias("c"), _same(keys, "t", "c"), "left_semi")
    sums = held.groupBy(RANGE, *keys).agg(F.sum("_copies").alias("_held"))
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(RANGE, *keys, F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_carried"))


def duplicates_for_review(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None, chunk: int = LISTED_TOGETHER
) -> DataFrame:
    """The rows ``deduplicate`` removes, with their rank inside the key.

    Only rows of repeated keys are looked at; keys are counted first (map-side
    combine) and those that repeat are written. Equal rows are counted, so the
    copies of a hot key cross the shuffle once a task. If the largest key has at
    most ``chunk`` rows, each key is ranked and listed by one task. Otherwise the
    different rows are sorted into ranges over all tasks and ranks are sums on two
    levels: inside a range, and carried from the ranges before; a row's copies are
    listed again in runs of at most ``chunk``, dealt over all tasks. So neither a
    key of many rows nor a row of many copies meets in one task."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    seen = Observation()
    repeated = materialize(per_key.observe(seen, F.max("_n").alias("most")).select(*keys), "repeated-keys")
    rows = df.alias("d").join(repeated.alias("k"), _same(keys, "d", "k"), "left_semi")
    counted = rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    order = survivor_order(df, keys, order_by)
    if (seen.get.get("most") or 0) <= chunk:
        earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return _listed(_span(counted.withColumn("_last", F.sum("_copies").over(earlier)), df.columns), df.columns)
    table = written_in_order(counted, [*[F.col(k).asc_nulls_first() for k in keys], *order], "review-ranges")
    inside = Window.partitionBy(RANGE, *keys).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = table.withColumn("_inside", F.sum("_copies").over(inside)).alias("t")
    carried = F.broadcast(_carried(table, keys)).alias("c")  # one row per range at most
    same = (F.col(f"t.{RANGE}") == F.col(f"c.{RANGE}")) & _same(keys, "t", "c")
    last = (F.col("_inside") + F.coalesce("_carried", F.lit(0))).alias("_last")
    ranked = summed.join(carried, same, "left").select(*[F.col(f"t.{c}") for c in df.columns], "_copies", last)
    ranked = materialize(_span(ranked, df.columns), "review-ranks")
    long = F.col("_last") - F.col("_first") >= chunk
    runs = ranked.where(long).withColumn("_first", F.explode(F.sequence("_first", "_last", F.lit(chunk).cast("long"))))
    runs = runs.withColumn("_last", F.least("_last", F.col("_first") + (chunk - 1)))
    runs = runs.repartition(df.sparkSession.sparkContext.defaultParallelism)
    return _listed(ranked.where(~long).unionByName(runs), df.columns)


def _span(ranked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """First and last rank of every row's copies. A key's first row is its survivor."""
    first = F.greatest(F.col("_last") - F.col("_copies") + 1, F.lit(2))
    return ranked.select(*columns, first.alias("_first"), "_last").where(F.col("_last") >= F.col("_first"))


def _listed(spans: DataFrame, columns: Sequence[str]) -> DataFrame:
    listed = spans.withColumn("duplicate_rank", F.explode(F.sequence("_first", "_last")))
    return listed.select(*columns, F.col("duplicate_rank").cast("int").alias("duplicate_rank"))

"""Total orders as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.session import materialize

POSITION = "report_position"
# Columns of a table written in order: its range, and the row's place in it from 0.
RANGE, PLACE = "_range", "_place"


def descending(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def ascending_nulls_last(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def positioned(table: DataFrame, order: Sequence[Column], columns: Sequence[str | Column]) -> DataFrame:
    """``columns`` of ``table`` in ``order``, with each row's place from 1: a
    column survives any later shuffle or unordered sink. For results of one row
    per route, airport or segment, which one task's window can hold."""
    place = F.row_number().over(Window.orderBy(*order)).alias(POSITION)
    return table.select(place, *columns).orderBy(POSITION)


def written_in_order(df: DataFrame, order: Sequence[Column], name: str = "ordered") -> DataFrame:
    """``df`` written as sorted files, one or more per range of ``order``, with
    the row's range and place. Ranges follow each other in order. They are
    sampled, so the table is written before anything is derived from them."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()), name)
    # The id's upper bits number the writing tasks, its lower 33 their rows.
    at = F.col("_id")
    return table.select(*df.columns, F.shiftright(at, 33).alias(RANGE), at.bitwiseAND((1 << 33) - 1).alias(PLACE))


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's place in ``order`` from 1, for tables of any size:
    rows are numbered inside their range, and a range begins where those before
    it end. Only one row per range meets in one task. Ties of ``order`` are
    numbered in no particular order."""
    table = written_in_order(df, order)
    sizes = table.groupBy(RANGE).agg((F.max(PLACE) + 1).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(RANGE, before.alias("_before"))
    joined = table.join(F.broadcast(starts), RANGE)  # one row per range
    return joined.select(*df.columns, (F.col("_before") + F.col(PLACE) + 1).alias(name))

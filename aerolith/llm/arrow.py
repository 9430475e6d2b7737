"""Columns computed from Arrow batches, and vectors as numpy blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_columns(
    df: DataFrame, source: Column, fields: list[T.StructField], make: Callable[[pa.Array], list[pa.Array]], rows: int = 256, without: str = ""
) -> DataFrame:
    """``df`` with the columns ``fields`` that ``make`` computes from ``source``,
    at most ``rows`` rows at a time. Columns of those names are replaced, the
    column ``without`` goes; all others stay as they are, whatever their names."""
    gone = {f.name.lower() for f in fields} | {without.lower()}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in gone]
    schema = T.StructType([*(df.schema.fields[i] for i in kept), *fields])
    names = schema.names
    places = [f"c{i}" for i in range(len(df.columns))]  # names may hold dots or repeat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *make(batch.columns[-1])], names=names)

    placed = df.select("*", source.alias("__source")).toDF(*places, "source")
    return placed.select(*[places[i] for i in kept], "source").mapInArrow(run, schema)


def finite_vectors(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is neither null nor holds a null, NaN or infinity."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(vector).isNotNull() & sound)


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column without nulls as doubles. Every list must have
    ``width`` entries."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != width).any():
        raise ValueError(f"vectors of {width} and of {int(lengths[lengths != width][0])} components in one table")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)

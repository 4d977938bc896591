"""Operators that SQL can call: a table function that packs batches, an aggregate that averages vectors.

``register(spark)`` names them ``pack_batches`` and ``mean_vector``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, UserDefinedTableFunction


class PackBatches:
    """``SELECT * FROM pack_batches(TABLE(t), by => 'k', sort => 'i', size => 'n', limit => 100)``: the table's columns and ``batch``.

    The function itself asks for its rows by key and in order (null keys are one key). Items are not split, and a batch is
    closed before it would exceed the limit; null sizes count as 0. A key is streamed by one task, with a row in memory.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, by: AnalyzeArgument, sort: AnalyzeArgument, size: AnalyzeArgument, limit: AnalyzeArgument) -> AnalyzeResult:
        for each in (by, sort, size):
            if each.value not in table.dataType.names:
                raise ValueError(f"the table has no column {each.value!r}")
        schema = T.StructType([*table.dataType.fields, T.StructField("batch", T.LongType())])
        return AnalyzeResult(schema=schema, partitionBy=[PartitioningColumn(by.value)], orderBy=[OrderingColumn(sort.value)])

    def __init__(self):
        self.batch, self.held = 0, 0

    def eval(self, row, by: str, sort: str, size: str, limit: int) -> Iterator:
        n = row[size] or 0
        if self.held and self.held + n > limit:
            self.batch, self.held = self.batch + 1, 0
        self.held += n
        yield (*row, self.batch)


def pack_batches() -> UserDefinedTableFunction:
    return udtf(PackBatches)


def mean_vector():
    """An aggregate: the mean of vectors by place, over those that have the place; nulls don't count. A group's vectors are one Arrow array."""
    import pyarrow as pa

    def mean(vectors: pa.Array) -> pa.Scalar:
        lengths = np.array([len(v) if v is not None and v.is_valid else 0 for v in vectors], np.int64)
        flat = vectors.flatten()
        at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        good = np.asarray(flat.is_valid())
        values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(float)
        size = int(lengths.max(initial=0))
        total, count = np.bincount(at[good], values[good], size), np.bincount(at[good], minlength=size)
        return pa.scalar([t / c if c else None for t, c in zip(total.tolist(), count.tolist())], pa.list_(pa.float64()))

    mean.__annotations__ = {"vectors": pa.Array, "return": pa.Scalar}
    return arrow_udf(mean, "array<double>")


def register(spark: SparkSession) -> None:
    spark.udtf.register("pack_batches", pack_batches())
    spark.udf.register("mean_vector", mean_vector())

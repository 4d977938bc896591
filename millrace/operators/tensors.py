"""Weights as blocks: tensors of any size are averaged a block at a time, and no row holds a whole one."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096


def blocked(weights: DataFrame, block: int = BLOCK) -> DataFrame:
    """(model, key, values) -> (model, key, block, values): values in pieces of at most ``block``; an empty tensor has no block."""
    pieces = F.sequence(F.lit(0), F.floor((F.size("values") - 1) / block).cast("int"))
    each = weights.where(F.size("values") > 0).select("model", "key", "values", F.explode(pieces).alias("block"))
    return each.select("model", "key", "block", F.slice("values", F.col("block") * block + 1, F.lit(block)).alias("values"))


def soup(blocks: DataFrame) -> DataFrame:
    """(model, key, block, values) -> (key, block, values): the mean of each weight over the models that have it; nulls don't count, a weight that is null in all is null.

    A group is one block of all models; keys are never gathered.
    """
    kind = dict(blocks.dtypes)["key"]

    def mean(table):
        import pyarrow as pa

        column = table.column("values").combine_chunks()
        lengths = np.array([len(v) if v is not None else 0 for v in column], np.int64)
        flat = column.flatten()
        at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        good = np.asarray(flat.is_valid())
        values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(float)
        size = int(lengths.max(initial=0))
        total, count = np.bincount(at[good], values[good], size), np.bincount(at[good], minlength=size)
        out = pa.array(total / np.maximum(count, 1), pa.float64(), mask=count == 0)
        whole = pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), out)
        return pa.Table.from_arrays([table.column("key").slice(0, 1), table.column("block").slice(0, 1), whole], names=["key", "block", "values"])

    return blocks.select("key", "block", "values").groupBy("key", "block").applyInArrow(mean, f"key {kind}, block int, values array<double>")

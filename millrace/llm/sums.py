"""Sums of large vectors over partitions, added up in two levels so that the driver gets few rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WAYS = 16


def vector_sum(df: DataFrame, of: Callable[[pd.DataFrame], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of a function from a batch of rows to a vector of fixed size."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += of(batch)
        yield pd.DataFrame({"v": [total.tobytes()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            for v in batch["v"]:
                total += np.frombuffer(v)
        yield pd.DataFrame({"v": [total.tobytes()]})

    sums = df.mapInPandas(part, "v binary").repartition(WAYS, F.monotonically_increasing_id()).mapInPandas(add, "v binary")
    total = np.zeros(size)
    for (v,) in sums.toLocalIterator():
        total += np.frombuffer(v)
    return total

"""Running totals within keys, for keys of any size.

A window over a key puts all its rows into one task. Here rows are sorted by ranges of
(key, order), so that a hot key spans many tasks; each task adds up its own range, and
what a range has to add to its first key is carried over from the ranges before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import standing_on, stored


def _local(keys: np.ndarray, x: np.ndarray, carried: int, xor: bool) -> np.ndarray:
    """Running totals of sorted rows that start anew with each key; the first key has some already."""
    total = np.bitwise_xor.accumulate(x) if xor else np.cumsum(x)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    before = np.where(new > 0, total[new - 1], 0)
    before[0] = carried if xor else -carried
    of = np.repeat(before, np.diff(np.append(new, len(keys))))
    return total ^ of if xor else total - of


def running(
    df: DataFrame, key: list[str], order: list[str | Column], add: dict[str, str | Column] | None = None, xor: dict[str, str | Column] | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Adds, by name, the total of a whole number over a row and all rows before it that have its key: sums, or bits by exclusive or.

    ``keep``: the columns that are wanted besides (all). Nulls come first in key and order, and count as 0 in totals; null keys
    are one key. Rows equal in key and order follow each other in any order, and are in one range. Sums must fit 64 bits. An
    empty table stays empty. The driver sees a row for each range. The result reads a stored table: drop it when it is spent.
    """
    add, xor = add or {}, xor or {}
    given = [(n, c, False) for n, c in add.items()] + [(n, c, True) for n, c in xor.items()]
    column = lambda c: F.col(c) if isinstance(c, str) else c
    made = [F.coalesce(column(c).cast("long"), F.lit(0).cast("long")).alias(n) for n, c, _ in given]
    by = [column(c).asc_nulls_first() for c in (*key, *order)]
    own = keep if keep is not None else df.columns
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).select(*own, F.xxhash64(*key).alias("__k"), F.spark_partition_id().alias("__p"), *made)
    kinds = ranged.withColumn("__m", F.lit(0).cast("long")).schema
    wanted = [(n, bits) for n, _, bits in given]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last, carried, m = None, [0] * len(wanted), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("__k").to_numpy()
            columns = list(batch.columns)
            totals = []
            for i, (n, bits) in enumerate(wanted):
                at = batch.schema.get_field_index(n)
                total = _local(keys, batch.column(at).to_numpy(), carried[i] if last is not None and keys[0] == last else 0, bits)
                totals.append(int(total[-1]))
                columns[at] = pa.array(total, pa.int64())
            last, carried = keys[-1], totals
            columns.append(pa.array(np.arange(m, m + batch.num_rows), pa.int64()))
            m += batch.num_rows
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "__m"])

    parts = stored(ranged.mapInArrow(run, kinds))
    ends = parts.groupBy("__p").agg(F.max_by(F.struct("__k", *[n for n, _ in wanted]), "__m").alias("last"))
    before, now = [], None
    for p, end in sorted(tuple(r) for r in ends.collect()):  # a row for each range
        if now is not None:
            before.append((p, now[0], *now[1]))
        same = now is not None and now[0] == end["__k"]
        now = end["__k"], [(end[n] ^ t if bits else end[n] + t) if same else end[n] for (n, bits), t in zip(wanted, now[1] if same else [0] * len(wanted))]
    offsets = df.sparkSession.createDataFrame(before, ", ".join(["__q int", "__j long", *[f"__o{i} long" for i in range(len(wanted))]]))
    joined = parts.join(F.broadcast(offsets), (F.col("__p") == F.col("__q")) & (F.col("__k") == F.col("__j")), "left")
    offset = lambda i: F.coalesce(f"__o{i}", F.lit(0).cast("long"))
    whole = [(F.col(n).bitwiseXOR(offset(i)) if bits else F.col(n) + offset(i)).alias(n) for i, (n, bits) in enumerate(wanted)]
    return standing_on(joined.select(*own, *whole), parts)

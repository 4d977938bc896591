"""The first row of each key in a stream, by order and not by arrival."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_of_each(stream: DataFrame, key: str, time: str, order: str, late: str = "1 hour") -> DataFrame:
    """(key, time, order) of the least row of each key by time, then by a whole number ``order``.

    State holds one row for each key, and a timer at its time: when the watermark, ``late`` behind the newest time, has passed
    it, no earlier row can come any more, and the row is given out. Rows that are older than the watermark are late and dropped;
    rows of a key that has been given out are ignored, for which its state stays as a mark without a timer. What the last
    watermark has not passed when the stream ends is not given out yet. Numbers go as text, so none is rounded.
    """
    kind, number = dict(stream.dtypes)[key], dict(stream.dtypes)[order]
    rows = stream.select(F.col(time).cast("timestamp").alias("at"), F.col(key).cast("string").alias("k"), F.col(order).cast("string").alias("o"))
    rows = rows.withColumn("t", F.unix_micros("at").cast("string")).withWatermark("at", late)

    def run(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            t, o, _ = state.get
            state.update((t, o, True))
            yield pd.DataFrame({"k": [name[0]], "t": [t], "o": [o]})
            return
        t, o, done = state.get if state.exists else (None, None, False)
        best = None if t is None else (int(t), int(o))
        if not done:
            for part in parts:
                here = min(((int(a), int(b)) for a, b in zip(part["t"], part["o"])), default=None)
                best = here if best is None else best if here is None else min(best, here)
            if best is not None:
                state.update((str(best[0]), str(best[1]), False))
                state.setTimeoutTimestamp(max(best[0] // 1000 + 1, state.getCurrentWatermarkMs() + 1))

    kept = rows.groupBy("k").applyInPandasWithState(run, "k string, t string, o string", "t string, o string, done boolean", "append", GroupStateTimeout.EventTimeTimeout)
    back = F.timestamp_micros(F.col("t").cast("long")).cast(dict(stream.dtypes)[time])
    return kept.select(F.col("k").cast(kind).alias(key), back.alias(time), F.col("o").cast(number).alias(order))

"""Batches, lines and shares in order, for keys of any size: where each one starts depends on all before it.

A batch that starts at an item ends at an item that the running totals tell: the next
start is the first item whose value reaches a threshold. So every item has a next
start, whether it is a start itself or not, and the starts are what is met by jumping
from the first item on. Items are dealt into blocks of bounded size, which tasks look
through apart: from each item by which a batch could enter a block, the jumps within it
and the last start, whose next one lies in a block after it. Jumps between blocks are then
composed by doubling (one jump, two, four, ...), so a key of n blocks takes log n rounds
of joins over the few items by which blocks can be entered, and no task walks through a key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.scan import running
from millrace.session import dropped, stored

BLOCK = 4096
KEY = ["k1", "k2"]


def _next(v: np.ndarray, t0: np.ndarray, t1: np.ndarray | None) -> np.ndarray:
    """The next start of each item of a block, len(v) or more where the block doesn't tell."""
    out = np.searchsorted(v, t0, "left")
    if t1 is not None:
        at = np.searchsorted(v, t1, "left")
        out = np.where(at == len(v), len(v), np.maximum(out, at + 1))
    return out


def _marked(blocks: DataFrame, two: bool, kind: str):
    """Arrow functions over blocks: exits, places of thresholds, nodes of entries, numbers of batches."""

    def arrays(v, t0, t1):
        return np.asarray(v), np.asarray(t0), np.asarray(t1) if two else None

    @F.pandas_udf(f"array<struct<i: int, t: {kind}, plus: int>>")
    def exits(vs: pd.Series, t0s: pd.Series, t1s: pd.Series) -> pd.Series:
        out = []
        for v, t0, t1 in map(lambda x: arrays(*x), zip(vs, t0s, t1s)):
            found = []
            for i in np.flatnonzero(_next(v, t0, t1) >= len(v)).tolist():
                found.append((i, t0[i].item(), 0))
                if t1 is not None:
                    found.append((i, t1[i].item(), 1))
            out.append(found)
        return pd.Series(out, dtype=object)

    @F.pandas_udf("array<int>")
    def places(vs: pd.Series, ts: pd.Series) -> pd.Series:
        return pd.Series([np.searchsorted(np.asarray(v), np.asarray(t), "left").astype(np.int32) for v, t in zip(vs, ts)], dtype=object)

    @F.pandas_udf("array<struct<j: int, c: long, last: int>>")
    def nodes(vs: pd.Series, t0s: pd.Series, t1s: pd.Series, entries: pd.Series) -> pd.Series:
        out = []
        for (v, t0, t1), js in zip(map(lambda x: arrays(*x), zip(vs, t0s, t1s)), entries):
            after, n = _next(v, t0, t1).tolist(), len(v)
            count, last = [1] * n, list(range(n))
            for i in range(n - 1, -1, -1):
                if after[i] < n:
                    count[i], last[i] = 1 + count[after[i]], last[after[i]]
            out.append([(int(j), count[j], last[j]) for j in js if j < n])  # a place after the last item is no entry
        return pd.Series(out, dtype=object)

    @F.pandas_udf("array<long>")
    def numbers(vs: pd.Series, t0s: pd.Series, t1s: pd.Series, entries: pd.Series, before: pd.Series) -> pd.Series:
        out = []
        for (v, t0, t1), j, held in zip(map(lambda x: arrays(*x), zip(vs, t0s, t1s)), entries, before):
            after, start, at = _next(v, t0, t1).tolist(), np.zeros(len(v), np.int64), int(j)
            while 0 <= at < len(v):
                start[at] = 1
                at = after[at]
            out.append(np.cumsum(start) + (held - 1))
        return pd.Series(out, dtype=object)

    return exits, places, nodes, numbers


def jumped(items: DataFrame, by: list[str], pos: str, value: str, reach: Column, beyond: Column | None, out: str, block: int = BLOCK) -> DataFrame:
    """Adds the number of each item's batch, from 0 within each key, in a column ``out``; the columns that are only needed for it go.

    ``pos`` is the item's place within its key, from 0, and ``value`` doesn't fall along the places. The batch after the one that
    starts at an item starts at the first item whose value is at least ``reach``, and if ``beyond`` is given, after the first
    whose value is at least that. Null keys are one key. A block, a row of the tables used, has at most ``block`` items.
    """
    kind = dict(items.dtypes)[value]
    own = [c for c in items.columns if c not in (pos, value)]
    two = beyond is not None
    key = [F.xxhash64(*by).alias("k1"), F.xxhash64(F.lit(17), *by).alias("k2")]  # 128 bits
    at = F.floor(F.col(pos) / block).cast("long")
    item = F.struct(F.col(pos).alias("pos"), F.col(value).alias("v"), reach.cast(kind).alias("t0"), (beyond if two else reach).cast(kind).alias("t1"), F.struct(*own).alias("own"))
    rows = items.select(*key, at.alias("b"), item.alias("x")).groupBy(*KEY, "b").agg(F.array_sort(F.collect_list("x")).alias("x"))
    field = lambda n: F.transform("x", lambda x: x[n]).alias(n)
    blocks = stored(rows.select(*KEY, "b", field("v"), field("t0"), field("t1"), field("own")))
    exits, places, nodes, numbers = _marked(blocks, two, kind)
    arrays = (F.col("v"), F.col("t0"), F.col("t1"))
    first = blocks.where("b = 0").select(*KEY, F.lit(0).cast("long").alias("j"))
    spent = []
    if blocks.where("b > 0").isEmpty():
        entered = first.select(*KEY, F.lit(0).cast("long").alias("b"), F.lit(0).alias("j"), F.lit(0).cast("long").alias("c"))
    else:
        # Thresholds that a block does not reach: the block that does is found by counting blocks that end below.
        many = blocks.join(blocks.where("b = 1").select(*KEY), KEY)
        left = stored(many.select(*KEY, "b", F.inline(exits(*arrays))).select(*KEY, (F.col("b") * block + F.col("i")).alias("i"), "t", "plus"))
        asked = left.select(*KEY, "t").distinct().withColumn("ends", F.lit(0))
        every = asked.unionByName(blocks.select(*KEY, F.element_at("v", -1).alias("t"), F.lit(1).alias("ends")))
        ranked = running(every, KEY, ["t", "ends"], {"rank": "ends"})
        grouped = ranked.where("ends = 0").groupBy(*KEY, F.col("rank").alias("b")).agg(F.array_sort(F.collect_list("t")).alias("ts"))
        met = grouped.join(blocks.select(*KEY, "b", "v"), [*KEY, "b"]).select(*KEY, "b", F.explode(F.arrays_zip("ts", places("v", "ts").alias("at"))).alias("z"))
        met = met.select(*KEY, F.col("z.ts").alias("t"), (F.col("b") * block + F.col("z.at")).alias("j"))
        reached = left.join(met, [*KEY, "t"], "left").groupBy(*KEY, "i").agg(F.max(F.col("j") + F.col("plus")).alias("to"), F.bool_or(F.col("j").isNull()).alias("none"))
        targets = stored(reached.where("not none").select(*KEY, "i", "to"), ranked, left)
        entries = targets.select(*KEY, F.col("to").alias("j")).unionByName(first).distinct()
        grouped = entries.groupBy(*KEY, F.floor(F.col("j") / block).cast("long").alias("b")).agg(F.collect_list((F.col("j") % block).cast("int")).alias("js"))
        met = grouped.join(blocks, [*KEY, "b"]).select(*KEY, "b", F.inline(nodes(*arrays, F.col("js"))))
        met = stored(met.select(*KEY, "b", (F.col("b") * block + F.col("j")).alias("j"), "c", (F.col("b") * block + F.col("last")).alias("i")))
        step = stored(met.join(targets, [*KEY, "i"]).select(*KEY, "j", "to"), targets)
        reach_ = stored(first)
        while True:
            more = reach_.join(step, [*KEY, "j"]).select(*KEY, F.col("to").alias("j"))
            # Starts at places beyond a key's last item don't exist.
            found = stored(more.join(met.select(*KEY, "j"), [*KEY, "j"], "left_semi"))
            if found.isEmpty():
                break
            far = step.select(*KEY, F.col("j").alias("to"), F.col("to").alias("on"))
            reach_ = stored(reach_.unionByName(found), reach_, found)
            step = stored(step.join(far, [*KEY, "to"]).select(*KEY, "j", F.col("on").alias("to")), step)
        entered = reach_.join(met, [*KEY, "j"]).select(*KEY, "b", (F.col("j") % block).cast("int").alias("j"), "c")
        spent = [met, step, reach_, found]
    told = blocks.select(*KEY, "b").join(entered, [*KEY, "b"], "left").select(*KEY, "b", F.coalesce("j", F.lit(-1)).alias("j"), F.coalesce("c", F.lit(0)).alias("c"))
    total = running(told, KEY, ["b"], {"upto": "c"})
    for each in spent:
        dropped(each)
    whole = blocks.join(total.select(*KEY, "b", "j", (F.col("upto") - F.col("c")).alias("before")), [*KEY, "b"])
    done = whole.select(F.explode(F.arrays_zip("own", numbers(*arrays, F.col("j"), F.col("before")).alias("n"))).alias("z"))
    return done.select(*[F.col("z.own")[c].alias(c) for c in own], F.col("z.n").alias(out))


def packed(df: DataFrame, by: list[str], order: list[str], size: str, limit: int = 32_768, out: str = "batch", block: int = BLOCK) -> DataFrame:
    """(by, order, batch): items in order, none split, a batch closed before it would exceed the limit; keys of any size.

    Null and negative sizes count as 0. A batch holds at least one item of a size above 0 before it closes, so an item above the
    limit is alone with the items of size 0 before it.
    """
    sized = df.select(*by, *order, F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("__size"))
    total = running(sized, by, order, {"__v": "__size", "__pos": F.lit(1)})
    before = F.col("__v") - F.col("__size")
    items = total.withColumn("__pos", F.col("__pos") - 1).withColumn("__t0", before + limit + 1).withColumn("__t1", before + 1)
    made = jumped(items.drop("__size"), by, "__pos", "__v", F.col("__t0"), F.col("__t1"), out, block)
    return made.select(*by, *order, out)


def lines(df: DataFrame, by: list[str], y: str, order: list[str], height: float = 10.0, out: str = "line", block: int = BLOCK) -> DataFrame:
    """Adds the line of each item, from 0, of pages of any size: a line holds what is less than ``height`` below its first item.

    Items go by y, then by ``order``; items without y are left out.
    """

    @F.pandas_udf("double")
    def reach(ys: pd.Series) -> pd.Series:
        """The least number whose difference from y is at least the height, as floating numbers subtract."""
        y = ys.to_numpy(float)
        t = y + height
        for _ in range(4):
            t = np.where(t - y < height, np.nextafter(t, np.inf), t)
        for _ in range(4):
            low = np.nextafter(t, -np.inf)
            t = np.where(low - y >= height, low, t)
        return pd.Series(t)

    rows = df.where(F.col(y).isNotNull()).withColumn("__v", F.col(y).cast("double"))
    placed = running(rows, by, ["__v", *order], {"__pos": F.lit(1)}).withColumn("__pos", F.col("__pos") - 1)
    items = placed.withColumn("__t", reach("__v"))
    return jumped(items, by, "__pos", "__v", F.col("__t"), None, out, block).drop("__t")


def balanced(files: DataFrame, world: int, name: str = "name", size: str = "size") -> DataFrame:
    """(file, rank) of all files in name order: a rank is full once it holds its share of the sizes; what is left goes to the last.

    A round finds where one rank ends, by the running totals; no task and no row holds all files.
    """
    held = files.select(F.col(name).alias("file"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("n")).withColumn("all", F.lit(1))
    total = running(held, ["all"], ["file"], {"upto": "n"}, keep=["file"])
    whole = total.agg(F.coalesce(F.max("upto"), F.lit(0))).first()[0]
    share, ends, before = max(whole // world, 1), [], 0
    for _ in range(world - 1):
        # The first file with which the rank holds its share; files without a size that follow it belong to the next rank.
        end = total.where(F.col("upto") >= before + share).agg(F.min(F.struct("upto", "file"))).first()[0]
        if end is None:
            break
        ends.append(end["file"])
        before = end["upto"]
    rank = F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e < F.col("file"))) if ends else F.lit(0)
    return total.select("file", rank.cast("int").alias("rank"))


def runs(df: DataFrame, by: list[str], order: list[str], hit: Column) -> DataFrame:
    """(by, run, length): lengths of maximal runs of hits, in order, of keys of any size."""
    marked = running(df.select(*by, *[c for c in order if c not in by], hit.cast("long").alias("__hit")), by, order, {"__n": F.lit(1), "__hits": "__hit"})
    grouped = marked.where("__hit = 1").groupBy(*by, (F.col("__n") - F.col("__hits")).alias("__gap")).agg(F.count("*").alias("length"))
    numbered = running(grouped, by, ["__gap"], {"run": F.lit(1)})
    dropped(marked)
    return numbered.select(*by, "run", "length")


"""Row operators: positions and shards, lookups as joins, ordered aggregates, bag unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import basename, last_parts
from millrace.session import cut

_IN_PARTITION = 33


def positioned(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """Adds each row's place in the given order, from 0, without gathering the rows: ranges are sorted apart and their sizes added up."""
    ranged = cut(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()))
    part = F.shiftright("__m", _IN_PARTITION)
    before, total = {}, 0
    for r in sorted(ranged.groupBy(part.alias("p")).count().collect()):  # a row for each partition
        before[r["p"]] = total
        total += r["count"]
    offset = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])[part] if before else F.lit(0)
    return ranged.withColumn(name, (offset + F.col("__m").bitwiseAND(F.lit((1 << _IN_PARTITION) - 1))).cast("long")).drop("__m")


def block_rank(pos: Column, n: Column, world: int) -> Column:
    """Contiguous shards whose sizes differ by at most one; the first n % world are longer."""
    base, extra = F.floor(n / world), n % world
    edge = (base + 1) * extra
    return F.when(pos < edge, F.floor(pos / (base + 1))).otherwise(extra + F.floor((pos - edge) / F.greatest(base, F.lit(1)))).cast("long")


def stride_rank(pos: Column, world: int) -> Column:
    return F.pmod(pos, F.lit(world)).cast("long")


def file_shards(pos: Column, per_shard: int = 400) -> Column:
    return F.floor(pos / per_shard).cast("long")


def shard_count(n: Column, per_shard: int = 400) -> Column:
    """One more than whole shards, so that a last one may be empty."""
    return (F.floor(n / per_shard) + 1).cast("long")


def balanced(files: Column, world: int) -> Column:
    """(file, rank) for (name, size) structs: a rank is full once it holds its share; what is left goes to the last."""
    sizes = F.aggregate(files, F.lit(0).cast("long"), lambda a, f: a + f["size"])
    share = F.greatest(F.floor(sizes / world), F.lit(1))
    start = F.struct(F.lit(0).alias("bucket"), F.lit(0).cast("long").alias("size"), F.array().cast("array<struct<file: string, rank: int>>").alias("out"))

    def step(s: Column, f: Column) -> Column:
        row = F.array(F.struct(f["name"].alias("file"), F.least(s["bucket"], F.lit(world - 1)).alias("rank")))
        full = s["size"] + f["size"] >= share
        return F.struct(
            F.when(full, s["bucket"] + 1).otherwise(s["bucket"]).alias("bucket"),
            F.when(full, F.lit(0).cast("long")).otherwise(s["size"] + f["size"]).alias("size"),
            F.concat(s["out"], row).alias("out"),
        )

    return F.aggregate(F.array_sort(files), start, step, lambda s: s["out"])


def remaining(inputs: DataFrame, done: DataFrame, path: str = "path", only_name: bool = False) -> DataFrame:
    """Inputs whose last component (last two with only_name=False) is not among those done; duplicates stay."""
    key = (lambda c: basename(c)) if only_name else (lambda c: last_parts(c, 2))
    return inputs.withColumn("__k", key(F.col(path))).join(done.select(key(F.col(path)).alias("__k")).distinct(), "__k", "left_anti").drop("__k")


def not_fetched(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """(path, size) rows that are not there with the size expected."""
    return wanted.join(present.select("path", "size").distinct(), ["path", "size"], "left_anti")


def by_stem(left: DataFrame, right: DataFrame, name: str = "name", ends: tuple[str, str] = (".jpg", ".json")) -> DataFrame:
    """Members that share a path without its ending, such as a picture and its description."""
    a = left.where(F.col(name).endswith(ends[0])).withColumn("stem", F.regexp_replace(name, ends[0].replace(".", r"\.") + "$", ""))
    b = right.where(F.col(name).endswith(ends[1])).withColumn("stem", F.regexp_replace(name, ends[1].replace(".", r"\.") + "$", ""))
    return a.join(b.select("stem", *[F.col(c).alias(f"{c}_2") for c in right.columns]), "stem")


def looked_up(key: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    """A small constant mapping; keys without an entry get the default (null)."""
    found = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]
    return F.coalesce(found, default) if default is not None else found


def first_of_each(df: DataFrame, key: str | list[str], order: list[str], keep_all: Column) -> DataFrame:
    """All rows that meet a condition; of the others the first of each key."""
    w = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order)
    rest = df.where(~F.coalesce(keep_all, F.lit(False))).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return df.where(keep_all).unionByName(rest)


def runs(df: DataFrame, by: str, order: list[str], hit: Column) -> DataFrame:
    """Lengths of maximal runs of hits, in order, for each key: (key, run, length)."""
    w = Window.partitionBy(by).orderBy(*order)
    marked = df.select(by, *[c for c in order if c != by], hit.alias("hit")).withColumn("i", F.row_number().over(w))
    island = F.col("i") - F.row_number().over(Window.partitionBy(by, "hit").orderBy(*order))
    grouped = marked.withColumn("g", island).where("hit").groupBy(by, "g").agg(F.count("*").alias("length"), F.min("i").alias("at"))
    return grouped.select(by, F.row_number().over(Window.partitionBy(by).orderBy("at")).cast("long").alias("run"), "length")


def merged_status(df: DataFrame, rank: str, status: str) -> DataFrame:
    """Maps of many ranks as key -> values in rank order."""
    rows = df.select(F.col(rank).alias("rank"), F.explode(status).alias("key", "value"))
    return rows.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda s: s["value"]).alias("values"))


def all_true(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.coalesce(F.bool_and(flag), F.lit(True)).alias("all_finished"))


def bag_union(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_constant_rows(df: DataFrame, file: str, content: str) -> DataFrame:
    """One row (id, type image, content) more for each file."""
    extra = df.select(file).distinct().select(F.col(file), F.col(file).alias("id"), F.lit("image").alias("type"), F.lit(content).alias("content"))
    return df.unionByName(extra, allowMissingColumns=True)


def soup(weights: DataFrame) -> DataFrame:
    """(model, key, values) -> (key, values): the mean of each weight over models, for keys of every model."""
    flat = weights.select("key", F.posexplode("values").alias("i", "v"))
    mean = flat.groupBy("key", "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return mean.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("values"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in an order that depends on their keys and a seed alone: shuffle and limit, repeatably."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def between(df: DataFrame, start: int, end: int, *order: str) -> DataFrame:
    """Rows of a half-open range of places."""
    return positioned(df, *order).where((F.col("pos") >= start) & (F.col("pos") < end)).drop("pos")


def zipped(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows of two tables that have the same place in their orders, with ``pos``; it is an error if one has more rows."""
    a, b = positioned(left, *left_order), positioned(right, *right_order)
    both = a.withColumn("__a", F.lit(True)).join(b.withColumn("__b", F.lit(True)), "pos", "full")
    fail = F.raise_error(F.lit("tables of different lengths")).cast("boolean")
    return both.where(F.when(F.col("__a") & F.col("__b"), F.lit(True)).otherwise(fail)).drop("__a", "__b")


def within(df: DataFrame, path: str, part: str) -> DataFrame:
    """Rows whose path contains a part."""
    return df.where(F.contains(path, F.lit(part)))


def flattened_roots(roots: DataFrame, folders: DataFrame) -> DataFrame:
    """Roots replaced by their first-level folders; a root without any stays. (root), (root, folder) -> (root)"""
    inner = roots.join(folders, "root").select(F.col("folder").alias("root"))
    return inner.unionByName(roots.join(folders, "root", "left_anti").select("root"))

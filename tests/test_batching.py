import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import batching


def packed(rows, limit):
    out, seen = [], {}
    for k, o, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        n = max(n or 0, 0)
        batch, held = seen.get(k, (0, 0))
        if held and held + n > limit:
            batch, held = batch + 1, 0
        seen[k] = batch, held + n
        out.append((k, o, batch))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SIZES = {"even": lambda r: r.randint(1, 30), "zeros": lambda r: r.choice([0, 0, 0, 5, 40]), "large": lambda r: r.choice([1, 2, 100, 101, 250, 0, -4, None])}


@pytest.mark.parametrize("kind", SIZES)
def test_packed_equals_a_walk(spark, kind):
    r = random.Random(5)
    rows = [(r.choice(["hot"] * 6 + ["a", None]), 2**60 + i, SIZES[kind](r)) for i in range(260)]
    df = spark.createDataFrame(rows, "k string, o long, n int").repartition(3)
    assert got(batching.packed(df, ["k"], ["o"], "n", 100, block=8)) == packed(rows, 100)


def test_one_key_is_packed_by_many_tasks(spark):
    df = spark.range(30_000).selectExpr("'all' AS k", "id AS o", "(id * 7919) % 400 AS n")
    rows = [tuple(r) for r in df.collect()]
    assert got(batching.packed(df, ["k"], ["o"], "n", 3_000, block=512)) == packed(rows, 3_000)
    assert batching.packed(df.where("false"), ["k"], ["o"], "n").count() == 0


def test_null_keys_that_are_numbers(spark):
    rows = [(None, i, 60) for i in range(4)] + [(2**60 + 1, i, 60) for i in range(3)]
    df = spark.createDataFrame(rows, "k long, o long, n int")
    assert got(batching.packed(df, ["k"], ["o"], "n", 100)) == sorted(rows_of(rows), key=repr)


def rows_of(rows):
    return [(k, o, o) for k, o, _ in rows]


def test_lines(spark):
    r = random.Random(2)
    items = [(r.choice([1, 1, 1, 2, None]), r.choice([r.uniform(0, 300), r.randint(0, 30) * 5.0, 0.1 * r.randint(0, 900)]), i) for i in range(300)] + [(1, None, 999)]
    want, seen = [], {}
    for p, y, i in sorted((x for x in items if x[1] is not None), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])):
        line, anchor = seen.get(p, (-1, None))
        if anchor is None or not abs(y - anchor) < 10:
            line, anchor = line + 1, y
        seen[p] = line, anchor
        want.append((i, line))
    df = spark.createDataFrame(items, "page long, y double, i long").repartition(3)
    assert sorted(tuple(x) for x in batching.lines(df, ["page"], "y", ["i"], block=8).select("i", "line").collect()) == sorted(want)


def test_balanced(spark):
    from millrace.operators import relational

    r = random.Random(4)
    for sizes in ([r.randint(0, 50) for _ in range(60)], [0] * 7, [5], [1000, 0, 0, 1, 1], []):
        df = spark.createDataFrame([(f"f{i:03d}", n) for i, n in enumerate(sizes)], "name string, size long")
        one = df.agg(F.collect_list(F.struct("name", "size")).alias("files"))
        for world in (1, 4, 9):
            want = got(one.select(F.explode(relational.balanced(F.col("files"), world)).alias("x")).select("x.file", "x.rank"))
            assert got(batching.balanced(df, world)) == want


def test_runs(spark):
    from millrace.operators import relational

    r = random.Random(6)
    df = spark.createDataFrame([(r.choice([1, 1, 2, None]), i, r.random() < 0.6) for i in range(400)], "u long, ts long, hit boolean").repartition(4)
    assert got(batching.runs(df, ["u"], ["ts"], F.col("hit"))) == got(relational.runs(df, "u", ["ts"], F.col("hit")))

import random

from pyspark.sql import functions as F

from millrace.operators.scan import running


def brute(rows):
    out, seen = [], {}
    first = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])
    for k, o, i, v in sorted(rows, key=first):
        s, x, n = seen.get(k, (0, 0, 0))
        seen[k] = s, x, n = s + (v or 0), x ^ (v or 0), n + 1
        out.append((k, o, i, v, s, x, n))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame(rows, "k string, o long, i long, v long").repartition(5)
    return sorted((tuple(r) for r in running(df, ["k"], ["o", "i"], {"s": "v", "n": F.lit(1)}, {"x": "v"}).select("k", "o", "i", "v", "s", "x", "n").collect()), key=repr)


def test_running_totals_over_ranges(spark):
    r = random.Random(1)
    rows = [(r.choice(["hot"] * 8 + ["a", "b", "", None]), r.choice([None, *range(40)]), 2**60 + i, r.choice([None, -5, 0, 7, 2**40 + i])) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(spark, rows) == brute(rows)
        assert got(spark, [("x", i, i, 1) for i in range(500)]) == brute([("x", i, i, 1) for i in range(500)])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got(spark, []) == []


def test_a_hot_key_is_summed_by_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select(F.lit("one").alias("k"), "id", F.lit(None).cast("string").alias("other"))
        made = running(df, ["k"], ["id"], {"n": F.lit(1)}, keep=["id"])
        assert made.columns == ["id", "n"] and made.where("n <> id + 1").isEmpty()
        assert made.select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_stored_tables_are_cleared(spark):
    from millrace import session

    table = session.stored(spark.range(5))
    other = session.stored(spark.range(7))
    session.dropped(other)
    assert table.count() == 5 and session.clear_stored(spark) >= 1 and session.clear_stored(spark) == 0

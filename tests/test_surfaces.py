"""Block tensors, functions for SQL, nested JSON and first rows of streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import nested, tables
from millrace.operators import packing, relational, tensors
from millrace.streaming.firsts import first_of_each


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def weights(spark):
    r = random.Random(1)
    made = [(m, k, [r.choice([None, r.random(), 1.0]) for _ in range(n + (m == 2))]) for m in range(4) for k, n in (("a", 23), ("b", 8), (None, 3), ("e", 0))]
    return spark.createDataFrame(made + [(9, "z", None)], "model int, key string, values array<double>")


def test_soup_by_blocks(spark):
    w = weights(spark)
    cut = tensors.blocked(w, 8)
    assert cut.agg(F.max(F.size("values"))).first()[0] == 8
    got = {(r["key"], r["block"] * 8 + i): v for r in tensors.soup(cut).collect() for i, v in enumerate(r["values"])}
    want = {(r["key"], i): v for r in relational.soup(w).collect() for i, v in enumerate(r["values"])}
    assert got.keys() == want.keys() and all(v == pytest.approx(want[x]) if v is not None else want[x] is None for x, v in got.items())
    assert tensors.soup(tensors.blocked(w.where("false"))).count() == 0


def test_functions_that_sql_calls(spark):
    tables.register(spark)
    r = random.Random(2)
    df = spark.createDataFrame([(r.choice([2**60 + 1, None, 3]), 2**60 + i, r.choice([None, 0, 30, 70, 200]), "x") for i in range(200)], "k long, o long, n int, extra string")
    df.createOrReplaceTempView("items")
    got = spark.sql("SELECT k, o, batch FROM pack_batches(TABLE(items), by => 'k', sort => 'o', size => 'n', limit => 100)")
    assert rows(got) == rows(packing.packed_batches(df, "k", "o", "n", 100))
    with pytest.raises(Exception, match="no column 'zz'"):
        spark.sql("SELECT * FROM pack_batches(TABLE(items), by => 'zz', sort => 'o', size => 'n', limit => 100)").collect()
    weights(spark).where("key <> 'e'").createOrReplaceTempView("w")
    made = {x["key"]: x["v"] for x in spark.sql("SELECT key, mean_vector(values) AS v FROM w WHERE model < 9 GROUP BY key").collect()}
    want = {x["key"]: x["values"] for x in relational.soup(weights(spark)).collect()}
    assert made.keys() == {k for k in want if k and k != "e"} and all(a == pytest.approx(b) for k in made for a, b in zip(made[k], want[k]))


def brute(value, depth=1, path=""):
    pairs = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    for k, v in pairs:
        here = f"{path}.{k}" if path else str(k)
        yield depth, here, k if isinstance(k, str) else None, v
        yield from brute(v, depth + 1, here)


def test_nested_json(spark):
    docs = [{"a": 1, "b": {"a": [1, {"a": "x\"y"}], "c": None}}, {"list": [[{"deep": {"a": True}}], 1.5]}, {}, [1, [2, [3]]], "alone", 2**60 + 1]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(2**60 + 1, None), (None, "{broken"), (None, '{"a": "é"}')], "id long, j string")
    got = [(r["id"], r["depth"], r["path"], r["key"], json.loads(r["value"])) for r in nested.places(df, "j", ["id"]).collect()]
    want = [(i, *x) for i, d in [*enumerate(docs), (None, {"a": "é"})] for x in brute(d)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    found = [(r["id"], r["path"], json.loads(r["value"])) for r in nested.search(df, "j", "a", ["id"]).collect()]
    assert sorted(found, key=repr) == sorted(((i, p, v) for i, _, p, k, v in want if k == "a"), key=repr)
    flat = {(r["id"], r["path"]): r["value"] for r in nested.strings(df, "j", ["id"]).collect()}
    assert flat[0, "b.a.1.a"] == 'x"y' and flat[0, "b.c"] == "null" and flat[1, "list.0.0.deep.a"] == "true" and flat[1, "list.1"] == "1.5" and flat[3, "1.1.0"] == "3"
    assert nested.places(df.where("false"), "j", ["id"]).count() == 0


def test_the_first_of_each_in_a_stream(spark, tmp_path):
    r = random.Random(3)
    events = [(2**60 + r.randrange(30), f"2024-01-{r.randint(1, 28):02d} 0{r.randrange(3)}:00:00", 2**60 + i) for i in range(400)]
    r.shuffle(events)
    late = [(2**60 + 1, "2023-01-01 00:00:00", 5)]
    for k, part in enumerate([events[:150], events[150:300], events[300:], [(99, "2024-06-01 00:00:00", 1)], late]):
        spark.createDataFrame(part, "u long, ts string, e long").selectExpr("u", "ts::timestamp AS ts", "e").coalesce(1).write.parquet(str(tmp_path / "in" / f"f{k}"))
    stream = spark.readStream.schema("u long, ts timestamp, e long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    out = first_of_each(stream, "u", "ts", "e", "40 days")
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination(300)
    want = {}
    for u, t, e in events:
        want[u] = min(want.get(u, (t, e)), (t, e))
    got = spark.read.parquet(str(tmp_path / "out")).selectExpr("u", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS t", "e").collect()
    assert sorted(tuple(x) for x in got) == sorted((u, *x) for u, x in want.items())

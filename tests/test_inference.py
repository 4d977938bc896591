import threading
import time

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import images
from millrace.operators import inference, packing
from millrace.sources import media

WIDE = [(2**60 + 1, "a"), (None, "b"), (2**60 + 3, None), (2**60 + 5, "d")]


def echo():
    return lambda prompt, shown: prompt.upper()


def test_integers_beside_nulls_stay(spark):
    df = spark.createDataFrame(WIDE, "id long, prompt string").coalesce(1)
    got = {(r["id"], r["answer"]) for r in inference.ask(df, echo).collect()}
    assert got == {(i, p and p.upper()) for i, p in WIDE}
    got = {(r["id"], bytes(r["content"]) if r["content"] else None) for r in media.fetched(df, lambda: lambda u: (200, u.encode()), "prompt").collect()}
    assert got == {(i, p and p.encode()) for i, p in WIDE}
    df = spark.createDataFrame([(k, 2**60 + i, 60) for i, k in enumerate([None, None, None, 2**60 + 1, 2**60 + 1, 2**60 + 3])], "k long, o long, n int").coalesce(1)
    got = sorted(((r["k"] or 0, r["o"] - 2**60, r["batch"]) for r in packing.packed_batches(df, "k", "o", "n", 100).collect()), key=lambda r: r[1])
    assert got == [(0, 0, 0), (0, 1, 1), (0, 2, 2), (2**60 + 1, 3, 0), (2**60 + 1, 4, 1), (2**60 + 3, 5, 0)]


def slow():
    lock, now = threading.Lock(), [0]

    def call(prompt, shown):
        with lock:
            now[0] += 1
            here = now[0]
        time.sleep(0.05)
        with lock:
            now[0] -= 1
        return f"{prompt}/{here}"

    return call


def test_calls_of_a_task_run_at_the_same_time(spark):
    df = spark.range(40, numPartitions=1).select("id", F.col("id").cast("string").alias("prompt"))
    took = {}
    for n in (1, 8):
        began = time.time()
        rows = inference.ask(df, slow, concurrency=n).collect()
        took[n] = time.time() - began
        assert [r["answer"].split("/")[0] for r in rows] == [str(r["id"]) for r in rows]  # every answer is at its row
        assert max(int(r["answer"].split("/")[1]) for r in rows) <= n
    assert took[8] < took[1] / 2


def one_dead_host():
    calls = []

    def dead(prompt, shown):
        calls.append(prompt)
        raise ConnectionError

    return [dead, lambda prompt, shown: f"{prompt} {len(calls)}"]


def test_a_dead_host_is_left_out(spark):
    df = spark.range(50, numPartitions=1).select("id", F.col("id").cast("string").alias("prompt"))
    rows = inference.ask(df, one_dead_host, retry=inference.Retry(3, sleep=lambda s: None, budget=4)).collect()
    assert [r["answer"].split()[0] for r in rows] == [str(i) for i in range(50)]
    assert max(int(r["answer"].split()[1]) for r in rows) == 4
    gone = inference.ask(df, lambda: [one_dead_host()[0]], retry=inference.Retry(2, sleep=lambda s: None))
    assert gone.where("answer is not null").isEmpty()


def test_answers_of_samples_by_file_keep_their_places(spark):
    talk = [{"role": "user", "text": "q", "responses": {}}, {"role": "assistant", "text": "a", "responses": {}}]
    df = spark.createDataFrame([(f"/in/f{i}.jsonl", f"s{i}", talk) for i in range(10)], "file string, id string, conversations array<struct<role:string,text:string,responses:map<string,string>>>")
    done = spark.createDataFrame([(f"/out/f{i}.jsonl",) for i in range(5)], "file string")
    told = lambda a, b, d: sorted(r["id"] for r in inference.by_file(df, "/out", echo, "m", a, b, d, concurrency=4).collect())
    assert told(5, 10, done) == [f"s{i}" for i in range(5, 10)]
    assert told(3, 7, done) == ["s5", "s6"] and told(0, 5, done) == []


def test_large_images_are_shrunk_before_they_are_sent(spark):
    import base64

    import numpy as np

    picture = base64.b64encode(images.encode(np.full((40, 60, 3), 9, np.uint8))).decode()
    df = spark.createDataFrame([("big", picture)], "id string, content string")

    def sizes():
        return lambda prompt, shown: str(images.decode(base64.b64decode(shown[0])).shape[:2])

    told = inference.distilled(df, sizes, retry=inference.Retry(1), max_pixels=600).where("degrees = 0").first()
    assert told["conversations"][1]["text"] == "(20, 30)"
    assert inference.distilled(df, sizes, retry=inference.Retry(1)).where("degrees = 0").first()["conversations"][1]["text"] == "(40, 60)"


def test_batches_by_an_injected_tokenizer(spark):
    turns = [("user", "one two three"), ("assistant", None)]
    raw = spark.createDataFrame([(f"r{i}", None, turns, None, None) for i in range(5)], "id string, images array<struct<name:string,content:string>>, conversations array<struct<role:string,text:string>>, fps double, total_frames int")

    def words(texts: pd.Series) -> pd.Series:
        return texts.str.split().str.len()

    told = raw.unionByName(raw.withColumn("id", F.lit("r0")))  # rows of one id share a shard
    for tokens, each in ((F.pandas_udf(words, "int"), 3), (packing._quarter, 4)):
        _, batches = packing.prepare(told, 9, tokens=tokens)
        got = sorted(r["batch"] for r in batches.where("id = 'r0'").collect())
        assert batches.count() == 10 and got == [i // (9 // each) for i in range(6)]

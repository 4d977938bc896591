"""Queries of block tensors, functions that SQL calls, nested JSON and streams; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import nested, tables
from millrace.operators import tensors
from millrace.plans.queries import SQL, _fresh, query
from millrace.streaming.firsts import first_of_each


def _weights(t):
    return t("embeddings").select(F.col("vec_id").alias("model"), F.col("label").alias("key"), F.col("embedding").alias("values"))


@query(SQL["model_soup"])
def model_soup_blocks(t):
    mean = tensors.soup(tensors.blocked(_weights(t), 16)).select("key", "block", F.posexplode("values").alias("i", "v"))
    return mean.select(F.col("key").alias("label"), (F.col("block") * 16 + F.col("i")).alias("i"), F.round("v", 6).alias("v"))


@query(SQL["model_soup"])
def model_soup_sql(t):
    w = _weights(t)
    tables.register(w.sparkSession)
    w.createOrReplaceTempView("weights")
    return w.sparkSession.sql("SELECT label, i, round(v, 6) AS v FROM (SELECT key AS label, posexplode(mean_vector(values)) AS (i, v) FROM weights GROUP BY key)")


@query(SQL["token_pack"])
def token_pack_sql(t):
    docs = t("documents")
    tables.register(docs.sparkSession)
    docs.select("source", "doc_id", "n_chars").createOrReplaceTempView("sized")
    return docs.sparkSession.sql("SELECT source, doc_id, batch FROM pack_batches(TABLE(sized), by => 'source', sort => 'doc_id', size => 'n_chars', limit => 32768)")


@query("""
WITH k AS (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, 'a.k' AS path, k AS value FROM k UNION ALL SELECT event_id, 'list.0.k', k FROM k UNION ALL SELECT event_id, 'list.1.0.k', '"' || k || 'x"' FROM k""")
def key_search(t):
    own = F.get_json_object("props", "$.k")
    whole = F.concat(F.lit('{"a": '), "props", F.lit(', "list": ['), "props", F.lit(', [{"k": "'), own, F.lit('x"}]], "kk": 0}'))
    return nested.search(t("events").select("event_id", whole.alias("j")), "j", "k", ["event_id"])


@query("SELECT user_id, ts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def stream_first(t):
    """A replay in an order that has nothing to do with time; a last row, of no user, moves the watermark past all others."""
    events, root = t("events").select("user_id", "ts", "event_id"), _fresh(t, "replay")
    spark = events.sparkSession
    end = events.agg((F.max("ts") + F.expr("INTERVAL 400 DAYS")).alias("ts")).select(F.lit(None).cast("long").alias("user_id"), "ts", F.lit(-1).cast("long").alias("event_id"))
    shuffled = events.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(3)))
    for k in range(3):
        shuffled.where(F.col("part") == k).drop("part").write.parquet(f"{root}/in/f{k}")
    end.coalesce(1).write.parquet(f"{root}/in/f9")
    stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").option("latestFirst", "false").option("maxFilesPerTrigger", 8).parquet(f"{root}/in")
    out = first_of_each(stream, "user_id", "ts", "event_id", "365 days")
    run = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/check").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{root}/out")

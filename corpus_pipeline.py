"""A corpus pipeline of five stages over the documents table.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before
kept; what it returns is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents; where a stage shortens a text,
n_chars follows it.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bagminhash, bpe, decontaminate, line_dedup, toxicity
from millrace.llm.common import bucket_of, small_batches, stored, table

TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores below TOXIC, with all their columns.

    Null and empty texts have the score of a text without evidence; repeated rows are scored alike; without labels nothing is
    dropped; an empty table stays empty.
    """
    small_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", bucket_of("doc_id", 3) != 1)
    return docs.where(toxicity.scorer(spark, model)("text") < TOXIC)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are similar to an earlier one.

    A null text stays null; a text of which no line goes stays as it is; rows that share an id count as one document; ties go by
    document id (null first) and place; an empty table stays empty.
    """
    clean = line_dedup.dedup(docs)
    return clean.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the least id (a null one only if there is no other).

    Null and empty texts are copies of each other; of repeated rows one stays; an empty table stays empty.
    """
    small_batches(spark)
    return bagminhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows hit less than a twentieth of the words, with all their columns.

    Null and empty texts have no words and stay; repeated rows are judged each for itself; an empty table stays empty.
    """
    small_batches(spark)
    names = [f"c{i}" for i in range(len(docs.columns))]  # whatever the columns are called, none has the name of a result
    judged = decontaminate.scan(docs.toDF(*names), table(spark, sf_dir, "benchmark"), text=names[docs.columns.index("text")], keep=tuple(names))
    return judged.where(~F.col("contaminated")).select(*names).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian, 32 bits each), and the digest of what they decode to.

    A null text counts as empty and has no ids; repeated rows are encoded each for itself; an empty table gives no rows.
    """
    small_batches(spark)
    vocab, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(docs, vocab, pattern), vocab, pattern)
    n_tokens = F.floor(F.length("ids") / 4).cast("long").alias("n_tokens")
    return decoded.select("doc_id", n_tokens, "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: Trained dictionaries, hashed signatures and merges have no SQL form: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; a stage's rows are stored for the next, and deleted when that has run."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(partial(stage, spark, docs, sf_dir), docs)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Packing and repetition flags over a growing folder of JSON lines; the checkpoint remembers what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import sequences, text

SAMPLE = "id string, conversations array<struct<role: string, text: string>>"


def conversations(spark: SparkSession, folder: str, schema: str = SAMPLE, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of samples from the lines of files as they arrive; blank lines are skipped."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return lines.where(F.trim("value") != "").select(F.from_json("value", schema).alias("r")).select("r.*")


def packed(stream: DataFrame) -> DataFrame:
    """Stateless: (id, type, text, repetitive) of each sample."""
    joined = text.strip(sequences.joined_turns(F.col("conversations")))
    rows = stream.select("id", F.lit("conversation").alias("type"), joined.alias("text"))
    return rows.withColumn("repetitive", text.is_repetitive("text"))


def first_arrivals(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """One row for each key within a watermark: which of the equal keys stays is decided by arrival, so batch dedup is the exact one."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def written(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Sessions with the settings that the engine's results rely on, and tables written to shared storage."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Unchunked base64, half-open ANSI semantics by Spark's defaults, UTC everywhere.
SETTINGS = {
    "spark.sql.legacy.chunkBase64String.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configured(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def session(app: str = "millrace", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it; only a session in one process may go without."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "millrace-checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """Evaluate once and cut the lineage, in the folder that spark.checkpoint.dir names (our own where it is unset)."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


_PATHS: dict[int, str] = {}
_EVERY: set[str] = set()


def stored(made: DataFrame | Callable[[], DataFrame], *spent: DataFrame) -> DataFrame:
    """Written as a table to the shared folder and read again: evaluated once, and safe from lost executors.

    ``spent`` are earlier tables that nothing reads any more: they are deleted. What was shuffled for the table is of no more
    use either; the engine removes shuffle files when the driver collects its garbage, which is asked for here (unless
    spark.millrace.clean is false, as in tests on few rows) so that the disk holds one step's files at a time. Given a
    function that makes the table, no caller still holds on to its plan then.
    """
    df = made() if callable(made) else made
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/millrace-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = df.schema
    del df, made
    for each in spent:
        dropped(each)
    if spark.conf.get("spark.millrace.clean", "true") == "true":
        spark.range(1).collect()  # else the engine's listeners hold on to the last query's plan, and its shuffle files stay
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    _EVERY.add(path)
    return _named(spark.read.schema(schema).parquet(path), path)


def _named(table: DataFrame, path: str) -> DataFrame:
    _PATHS[id(table)] = path
    weakref.finalize(table, _PATHS.pop, id(table), None)
    return table


def standing_on(df: DataFrame, table: DataFrame) -> DataFrame:
    """What is made of a stored table alone: it is spent, or dropped, together with the table."""
    return _named(df, _PATHS[id(table)])


def dropped(table: DataFrame) -> None:
    """Deletes the files of a table that ``stored`` made."""
    path = _PATHS.pop(id(table), None)
    if path:
        _deleted(table.sparkSession, path)


def _deleted(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _EVERY.discard(path)


def clear_stored(spark: SparkSession) -> int:
    """Deletes all tables that this process has stored and not dropped; how many. For when the results that read them are written."""
    paths = sorted(_EVERY)
    for path in paths:
        _deleted(spark, path)
    return len(paths)

"""A sink of named files: each row says which file it goes to, and each file is written whole or not at all.

Tasks write to a staging folder; only when all have ended well are their files moved to
their names, and a manifest of the run is written. A run that fails leaves nothing, a
task that is lost or run twice leaves no rows twice, and a second run writes what is
missing. Moving is the store's: one call for each file, no bytes pass the driver.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from millrace.sources.stores import exists, store

MANIFESTS = "_manifests"


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: (name, staged path, rows, bytes)."""

    files: list[tuple[str, str, int, int]]


class RoutedWriter(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root, self.run = root.rstrip("/"), uuid.uuid4().hex
        self.staging = f"{self.root}/_staging-{self.run}"

    def write(self, iterator: Iterator) -> Written:
        """Lines of sorted names: a file is open at a time, and memory holds a batch."""
        fs, staging = store(self.staging)
        attempt = f"{staging}/{uuid.uuid4().hex}"  # a task that is run again writes to another folder
        fs.create_dir(attempt, recursive=True)
        files: list[tuple[str, str, int, int]] = []
        name, out, rows, size = None, None, 0, 0

        def close() -> None:
            if out is not None:
                out.close()
                files.append((name, f"{attempt}/{len(files)}", rows, size))

        for batch in iterator:
            for path, value in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
                if path is None or posixpath.normpath(path) != path or path.startswith(("/", "..", "_", ".")):
                    raise ValueError(f"not the name of a file below the root: {path!r}")
                if path != name:
                    close()
                    name, out, rows, size = path, fs.open_output_stream(f"{attempt}/{len(files)}"), 0, 0
                line = value.encode() + b"\n"
                out.write(line)
                rows, size = rows + 1, size + len(line)
        close()
        return Written(files)

    def commit(self, messages: list) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        names = [f[0] for f in files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("rows of a file came from several tasks: deal them out by path")
        fs, root = store(self.root)
        for name, staged, *_ in files:
            fs.create_dir(posixpath.dirname(f"{root}/{name}"), recursive=True)
            fs.move(staged, f"{root}/{name}")
        if files:
            fs.create_dir(f"{root}/{MANIFESTS}", recursive=True)
            with fs.open_output_stream(f"{root}/{MANIFESTS}/{self.run}.jsonl") as out:
                for name, _, rows, size in sorted(files):
                    out.write(json.dumps({"path": name, "rows": rows, "bytes": size}).encode() + b"\n")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        fs, staging = store(self.staging)
        if exists(self.staging):
            fs.delete_dir(staging)


class RoutedLines(DataSource):
    """``df.write.format("routed_lines").option("path", root)``: (path, value), sorted by path, a path's rows in one partition."""

    @classmethod
    def name(cls) -> str:
        return "routed_lines"

    def schema(self) -> str:
        return "path string, value string"

    def writer(self, schema, overwrite: bool) -> RoutedWriter:
        if overwrite:
            raise ValueError("files are only added: use mode append, and delete what is to be written anew")
        return RoutedWriter(self.options["path"])


def written(spark: SparkSession, root: str) -> DataFrame:
    """(path) of the files below the root, by the store's own listing; none where there is no root."""
    if not exists(root):
        return spark.createDataFrame([], "path string")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    inner = store(root)[1].strip("/")
    return found.select(F.substring_index("path", f"/{inner}/", -1).alias("path"))


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """(path, rows, bytes) of all files that runs have written below the root."""
    return spark.read.schema("path string, rows long, bytes long").json(f"{root.rstrip('/')}/{MANIFESTS}")


def write_files(df: DataFrame, root: str, path: str = "path", order: tuple[str | Column, ...] = (), skip_done: bool = True, leave: tuple[str, ...] = ()) -> None:
    """The other columns (but those to ``leave``) as JSON lines, in order, in exactly one file for each path (relative to the root).

    Files that exist stay as they are, unless ``skip_done`` is false: then they are written anew. A file is written by one task, as it comes, with a batch in memory. Without rows nothing is written. A null path, or one
    that leaves the root, fails the job.
    """
    spark = df.sparkSession
    spark.dataSource.register(RoutedLines)
    if skip_done:
        df = df.join(written(spark, root).withColumnRenamed("path", "__done"), F.col(path) == F.col("__done"), "left_anti")
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != path and c not in leave]), {"ignoreNullFields": "false"})
    by = [F.col(path), *(F.col(c) if isinstance(c, str) else c for c in order)]
    rows = df.repartition(F.col(path)).sortWithinPartitions(*by).select(F.col(path).alias("path"), value.alias("value"))
    rows.write.format("routed_lines").mode("append").option("path", root).save()

"""Members of tar and zip archives as rows (archive, member, size, is_file, content).

An archive has an index: a zip's central directory, the headers of a plain tar. From it
each member's place is known, so members of one archive are read by many tasks, and
members that are not wanted (by their endings) are neither read nor unpacked. A packed
tar has no index and is one task's stream.

``members`` reads archives of up to SMALL bytes through Spark's own file source, so any
store that it reads will do; those above are opened by path in the tasks: one task
reads an archive's index, and its members are dealt out by their places.
``Archives`` is the same as a data source, ``spark.read.format("archive")``: its reader
plans ranges of members when the query is planned, and takes endings from filters.
"""

from __future__ import annotations

import io
import json
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, StringEndsWith

from millrace.functions import text
from millrace.sources.stores import found, opened

SMALL = 256 << 20
#: Packed bytes of members that one task reads in a row.
SPLIT = 64 << 20
_MEMBER = "archive string, member string, size long, is_file boolean, content binary"
_PLACE = "member string, size long, is_file boolean, at long, packed long, method int, crc long"
#: Ways of packing that are undone here; others are the library's.
_PLAIN, _DEFLATED = zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED


def _tar(file: BinaryIO) -> Iterator[tuple[str, int, bool, bytes | None]]:
    with tarfile.open(fileobj=file, mode="r|*") as t:  # as a stream: what was read is not kept
        for m in t:
            yield m.name, m.size, m.isfile(), t.extractfile(m).read() if m.isfile() else None


def _zip(file: BinaryIO) -> Iterator[tuple[str, int, bool, bytes | None]]:
    with zipfile.ZipFile(file) as z:
        for m in z.infolist():
            yield m.filename, m.file_size, not m.is_dir(), None if m.is_dir() else z.read(m)


#: Where a member is: name, size, whether it is a file, place, packed bytes, way of packing, check sum (-1: none).
Place = tuple[str, int, bool, int, int, int, int]


def index(file: BinaryIO, kind: str) -> list[Place] | None:
    """The places of an archive's members, by its index alone; null if it has none."""
    if kind == "zip":
        with zipfile.ZipFile(file) as z:
            return [(m.filename, m.file_size, not m.is_dir(), m.header_offset, m.compress_size, m.compress_type if not m.flag_bits & 1 else -1, m.CRC) for m in z.infolist()]
    try:
        with tarfile.open(fileobj=file, mode="r:") as t:
            every = list(t)
    except tarfile.ReadError:
        return None
    if any(m.issparse() for m in every):
        return None
    return [(m.name, m.size, m.isfile(), m.offset_data, m.size, _PLAIN, -1) for m in every]


def content(file: BinaryIO, kind: str, place: Place) -> bytes | None:
    """A member's bytes, read from its place; a folder has none."""
    name, size, is_file, at, packed, method, crc = place
    if not is_file:
        return None
    if kind == "zip":
        if method not in (_PLAIN, _DEFLATED):
            with zipfile.ZipFile(file) as z:
                return z.read(next(m for m in z.infolist() if m.header_offset == at))
        file.seek(at)
        at += 30 + sum(struct.unpack("<HH", file.read(30)[26:30]))
    file.seek(at)
    raw = file.read(packed)
    out = zlib.decompress(raw, -15) if method == _DEFLATED else raw
    if len(out) != size or (crc >= 0 and zlib.crc32(out) != crc):
        raise ValueError(f"the archive's member {name!r} is broken")
    return out


def _wanted(name: str, is_file: bool, any_of: tuple[str, ...] | None, all_of: tuple[str, ...] = ()) -> bool:
    return (any_of is None or is_file and name.endswith(any_of)) and all(name.endswith(x) for x in all_of)


def members(spark: SparkSession, path: str | list[str], kind: str, suffixes: str | tuple[str, ...] = "any", small: int = SMALL, split: int = SPLIT) -> DataFrame:
    """Members that are files and end with a suffix; 'any' gives all, folders included."""
    unpack = {"tar": _tar, "zip": _zip}[kind]
    any_of = None if suffixes == "any" else (suffixes,) if isinstance(suffixes, str) else tuple(suffixes)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, raw in zip(batch["path"], batch["content"]):
                for m in unpack(io.BytesIO(raw)):
                    yield pd.DataFrame([(archive, *m)], columns=["archive", "member", "size", "is_file", "content"])

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["archive", *[x.split()[0] for x in _PLACE.split(", ")]]
        for batch in batches:
            for archive in batch["path"]:
                with opened(archive) as file:
                    places = index(file, kind)
                if places is None:  # the whole archive, as one member that is read as a stream
                    yield pd.DataFrame([(archive, None, 0, False, 0, 0, 0, -1)], columns=names)
                else:
                    yield pd.DataFrame([(archive, *p) for p in places if _wanted(p[0], p[2], any_of)], columns=names)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, file = None, None
        for batch in batches:
            for archive, *place in batch.itertuples(index=False, name=None):
                if archive != now:
                    if file is not None:
                        file.close()
                    now, file = archive, opened(archive)
                if place[0] is None:
                    found_here = (m for m in unpack(file) if _wanted(m[0], m[2], any_of))
                else:
                    found_here = [(place[0], place[1], place[2], content(file, kind, tuple(place)))]
                for m in found_here:
                    yield pd.DataFrame([(archive, *m)], columns=["archive", "member", "size", "is_file", "content"])
        if file is not None:
            file.close()

    files = spark.read.format("binaryFile").load(path)
    few = files.where(F.col("length") <= small).select("path", "content").mapInPandas(whole, _MEMBER)
    if any_of is not None:
        few = few.where(F.col("is_file") & text.ends_with_any(F.col("member"), any_of))
    places = files.where(F.col("length") > small).select("path").mapInPandas(indexed, f"archive string, {_PLACE}")
    dealt = places.withColumn("part", F.floor(F.col("at") / split)).repartition("archive", "part").sortWithinPartitions("archive", "at").drop("part")
    return few.unionByName(dealt.mapInPandas(read, _MEMBER))


@dataclass
class Range(InputPartition):
    """What one task reads: archives with the members wanted of each, or with null, as a stream."""

    parts: list[tuple[str, list[Place] | None]]


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.kind, self.split = options["kind"], int(options.get("splitbytes", options.get("splitBytes", SPLIT)))
        endings = options.get("suffixes")
        self.any_of: tuple[str, ...] | None = tuple(endings.split(",")) if endings else None
        self.all_of: tuple[str, ...] = ()

    def partitions(self) -> list[Range]:
        """Small archives together, up to the split; of larger ones the index is read here, and ranges of its members are dealt out."""
        out, held, size = [], [], 0
        for path in self.paths:
            for archive, n in found(path):
                places = None
                if n > self.split:
                    with opened(archive) as file:
                        places = index(file, self.kind)
                if places is None:
                    held.append((archive, None))
                    size += n
                else:
                    now: list[Place] = []
                    packed = 0
                    for p in sorted((p for p in places if _wanted(p[0], p[2], self.any_of, self.all_of)), key=lambda p: p[3]):
                        now.append(p)
                        packed += p[4]
                        if packed >= self.split:
                            out.append(Range([(archive, now)]))
                            now, packed = [], 0
                    if now:
                        out.append(Range([(archive, now)]))
                if size >= self.split:
                    out.append(Range(held))
                    held, size = [], 0
        return [*out, Range(held)] if held or not out else out

    def read(self, partition: Range) -> Iterator:
        import pyarrow as pa

        names = ["archive", "member", "size", "is_file", "content"]
        kinds = pa.schema(list(zip(names, (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.binary()))))
        for archive, places in partition.parts:
            with opened(archive) as file:
                if places is None:
                    places = index(file, self.kind)
                    file.seek(0)
                if places is None:
                    rows = (m for m in _tar(file) if _wanted(m[0], m[2], self.any_of, self.all_of))
                else:
                    rows = ((*p[:3], content(file, self.kind, p)) for p in places if _wanted(p[0], p[2], self.any_of, self.all_of))
                for row in rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, (archive, *row)))], schema=kinds)


class FilteringReader(ArchiveReader):
    """Takes the endings that a query's filters ask of ``member``."""

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            if isinstance(f, StringEndsWith) and f.attribute == ("member",):
                self.all_of += (f.value,)
            else:
                yield f


class Archives(DataSource):
    """``spark.read.format("archive")``: options path, kind (tar or zip), suffixes (joined by commas), splitBytes, pushdown.

    With pushdown "true" the reader takes filters, which needs spark.sql.python.filterPushdown.enabled.
    """

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return _MEMBER

    def reader(self, schema) -> ArchiveReader:
        return (FilteringReader if self.options.get("pushdown") == "true" else ArchiveReader)(dict(self.options))


def as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("text", F.decode("content", "UTF-8")).drop("content")


def as_base64(rows: DataFrame) -> DataFrame:
    return rows.withColumn("content", text.base64_text(F.col("content")))


def as_json(rows: DataFrame, schema: str) -> DataFrame:
    return as_text(rows).select("archive", "member", F.from_json("text", schema).alias("r")).select("archive", "member", "r.*")


def as_json_lines(rows: DataFrame, schema: str, skip_blank: bool = True) -> DataFrame:
    """Lines of members; a blank line is skipped or, with skip_blank=False, fails the job."""
    lines = as_text(rows).select("archive", "member", F.posexplode(F.split(F.rtrim("text", F.lit("\n")), "\n")).alias("line", "value"))
    if skip_blank:
        lines = lines.where(F.trim("value") != "")
    return lines.select("archive", "member", "line", F.from_json("value", schema, {"mode": "PERMISSIVE" if skip_blank else "FAILFAST"}).alias("r")).select("archive", "member", "line", "r.*")


def saved_name(member, prefix=None):
    """The flat file name that a member is saved under."""
    flat = F.array_join(F.split(member, "/"), "_")
    return F.concat_ws("_", prefix, flat) if prefix is not None else flat


def save_members(rows: DataFrame, root: str, prefix: str | None = None, deep: bool = False) -> DataFrame:
    """Writes members as files below a root, under their flat names (or their own, with ``deep``); (archive, member, saved) of each.

    A file is written beside its name and moved there, so that a task that is run again leaves whole files. The result is
    what was saved; it is evaluated once, here.
    """
    from millrace.session import stored
    from millrace.sources.stores import store

    named = rows.where("is_file").withColumn("saved", F.col("member") if deep else saved_name(F.col("member"), F.lit(prefix) if prefix else None))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import posixpath
        import uuid

        fs, inner = store(root.rstrip("/"))
        for batch in batches:
            for name, raw in zip(batch["saved"], batch["content"]):
                if posixpath.normpath(name) != name or name.startswith(("/", "..")):
                    raise ValueError(f"not the name of a file below the root: {name!r}")
                to = f"{inner}/{name}"
                fs.create_dir(posixpath.dirname(to), recursive=True)
                part = f"{posixpath.dirname(to)}/_{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as out:
                    out.write(raw)
                fs.move(part, to)
            yield batch[["archive", "member", "saved"]]

    return stored(named.select("archive", "member", "saved", "content").mapInPandas(write, "archive string, member string, saved string"))


def write_zips(rows: DataFrame, root: str) -> None:
    """(archive, member, content) as zip archives below a root; an archive is one task's stream, and moved to its name when it is whole."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from millrace.sources.stores import store

        fs, inner = store(root.rstrip("/"))
        fs.create_dir(inner, recursive=True)
        now, out, z = None, None, None

        def close() -> None:
            if z is not None:
                z.close()
                out.close()
                fs.move(part, f"{inner}/{now}")

        for batch in batches:
            for archive, member, raw in zip(batch["archive"], batch["member"], batch["content"]):
                if archive != now:
                    close()
                    now, part = archive, f"{inner}/_{uuid.uuid4().hex}"
                    out = fs.open_output_stream(part)
                    z = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                z.writestr(zipfile.ZipInfo(member), raw, zipfile.ZIP_DEFLATED)
            yield batch[["archive"]].iloc[:0]
        close()

    dealt = rows.select("archive", "member", "content").repartition("archive").sortWithinPartitions("archive", "member")
    dealt.mapInPandas(write, "archive string").write.format("noop").mode("overwrite").save()

"""Videos, PDFs and pictures from the web behind injected readers: no codec or network library is needed here.

A reader is opened once in each task. Whatever a reader cannot read gives no rows, or null for a fetch.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Video(Protocol):
    """What a video reader gives for a path: the number of frames, frames a second, and the frames at given places as image bytes."""

    n: int
    fps: float

    def frames(self, places: list[int]) -> list[bytes]: ...


class Pages(Protocol):
    """What a PDF reader gives for a path."""

    n: int

    def slice(self, pages: list[int]) -> bytes: ...

    def render(self, page: int, zoom: float) -> bytes: ...


def even_places(n: int, fps: float, rate: float, most: int, span: tuple[float, float] | None = None) -> list[int]:
    """``rate`` frames a second spread evenly over the clip, or over seconds [from, to] of it; at most ``most``."""
    a, b = (0, n) if span is None else (min(max(int(span[0] * fps), 0), n), min(max(int(span[1] * fps), 0), n))
    total = b - a
    count = int(min(total / fps * rate, most)) if fps else 0
    return [a + int(x) for x in np.round(np.linspace(0, total - 1, count))] if count > 0 else []


def _each(df: DataFrame, path: str, schema: str, open_reader: Callable[[], Callable], rows: Callable) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = open_reader()
        for batch in batches:
            for p in batch["path"]:
                try:
                    made = rows(read(p))
                except Exception:
                    continue
                yield pd.DataFrame([(p, *r) for r in made], columns=["path", *[c.split()[0] for c in schema.split(", ")]])

    return df.select(F.col(path).alias("path")).mapInPandas(run, f"path string, {schema}")


def video_frames(df: DataFrame, open_reader: Callable[[], Callable[[str], Video]], path: str = "path", rate: float = 1, most: int = 10, span: tuple[float, float] | None = None) -> DataFrame:
    """(path, i, place, content) of the sampled frames; without a span of seconds, of the whole video."""

    def rows(video: Video):
        places = even_places(video.n, video.fps, rate, most, span)
        return [(i, p, base64.b64encode(f).decode()) for i, (p, f) in enumerate(zip(places, video.frames(places)))]

    return _each(df, path, "i int, place int, content string", open_reader, rows)


def page_counts(df: DataFrame, open_reader: Callable[[], Callable[[str], Pages]], path: str = "path") -> DataFrame:
    return _each(df, path, "pages int", open_reader, lambda pdf: [(pdf.n,)])


def slice_of(page: Column, size: int) -> Column:
    return F.floor(page / size).cast("int")


def pdf_slices(df: DataFrame, open_reader: Callable[[], Callable[[str], Pages]], path: str = "path", size: int = 1, first: int = 0, end: int | None = None) -> DataFrame:
    """(path, slice, pages, content): each run of ``size`` pages in [first, end) as a document of its own, all pages by default."""

    def rows(pdf: Pages):
        pages = range(max(first, 0), min(pdf.n if end is None else end, pdf.n))
        slices: dict[int, list[int]] = {}
        for p in pages:
            slices.setdefault(p // size, []).append(p)
        return [(k, ps, pdf.slice(ps)) for k, ps in slices.items()]

    return _each(df, path, "slice int, pages array<int>, content binary", open_reader, rows)


def pdf_pages(df: DataFrame, open_reader: Callable[[], Callable[[str], Pages]], path: str = "path", first: int = 0, end: int | None = None, zoom: float = 2.0) -> DataFrame:
    """(path, page, content) of the rendered pages in [first, end)."""
    return _each(df, path, "page int, content string", open_reader, lambda pdf: [(p, base64.b64encode(pdf.render(p, zoom)).decode()) for p in range(max(first, 0), min(pdf.n if end is None else end, pdf.n))])


def fetched(df: DataFrame, open_fetch: Callable[[], Callable[[str], tuple[int, bytes]]], url: str = "url") -> DataFrame:
    """Adds ``content``: what an injected fetch (address -> status, body) returns with status 200, else null."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fetch = open_fetch()

        def one(address: str | None) -> bytes | None:
            try:
                status, body = fetch(address) if address else (0, None)
            except Exception:
                return None
            return body if status == 200 else None

        for batch in batches:
            yield pd.Series([one(a) for a in batch], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("content", F.pandas_udf(run, "binary").asNondeterministic()(F.col(url)))


def write_images(df: DataFrame, folder: str, name: str = "name", content: str = "content") -> int:
    """Each base64 image as a file of its name below a folder that all tasks reach; how many were written. A file is whole or not there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import posixpath
        import uuid

        from millrace.sources.stores import store

        fs, root = store(folder.rstrip("/"))
        for batch in batches:
            done = 0
            for n, c in zip(batch["name"], batch["content"]):
                if n is None or c is None:
                    continue
                if posixpath.normpath(n) != n or n.startswith(("/", "..")):
                    raise ValueError(f"not the name of a file below the folder: {n!r}")
                to = f"{root}/{n}"
                fs.create_dir(posixpath.dirname(to), recursive=True)
                part = f"{posixpath.dirname(to)}/_{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as f:
                    f.write(base64.b64decode(c))
                fs.move(part, to)
                done += 1
            yield pd.DataFrame({"n": [done]})

    return df.select(F.col(name).alias("name"), F.col(content).alias("content")).mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

"""Byte-level BPE encoding and decoding.

Long texts are cut into chunks that overlap. Every chunk is pre-tokenised on its
own; where two neighbours name the same pre-token boundary inside their overlap
they have resynchronised, and from there on both see the same pre-tokens. The
pieces between such boundaries are encoded independently and their ids joined.
A text of one chunk needs no stitching and never leaves its task. Decoding
concatenates the raw bytes of the ids.

Defined results: a null text counts as empty (no ids); repeated rows are encoded
each for itself; other columns are ignored unless named in ``keep``; an empty
table gives an empty table. A run of one pre-token longer than a chunk leaves no
common boundary: the rest of that text is then encoded as one piece, which is
slower and gives the same ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import tidied

CHUNK = 32_768
OVERLAP = 1_024
#: A boundary closer than this to the end of a chunk may move when more text follows.
UNSURE = 4


def _ranks(vocab_path: str) -> dict[bytes, int]:
    with open(vocab_path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=4)
def _codec(vocab_path: str, pattern: str):
    """The encoder; the vocabulary is read once in a worker."""
    import tiktoken

    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=_ranks(vocab_path), special_tokens={})


@lru_cache(maxsize=4)
def _bytes(vocab_path: str) -> list[bytes]:
    """Bytes by id: all that decoding needs, so that its workers hold no encoder."""
    ranks = _ranks(vocab_path)
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    return by_id


@lru_cache(maxsize=4)
def _pattern(pattern: str):
    import regex

    return regex.compile(pattern)


def _plain(c: str) -> bool:
    """Characters whose class no version of Unicode tables disputes: ASCII, Latin, CJK."""
    return " " <= c < "\x7f" or c == "\n" or "\xc0" <= c < "\u0250" or "\u3041" <= c <= "\u9fff"


def boundaries(text: str, pattern: str, stop: int) -> list[int]:
    """Starts of pre-tokens where a text may be cut.

    The end at ``stop`` cannot move them, and no white space stands before them: white space at the end of a piece would be
    split as if nothing followed.
    """
    starts = (m.start() for m in _pattern(pattern).finditer(text))
    return [b for b in starts if b <= stop - UNSURE and (b == 0 or not text[b - 1].isspace() and _plain(text[b - 1]) and _plain(text[b]))]


def _ids(texts, vocab_path: str, pattern: str) -> list[bytes]:
    import numpy as np

    encode = _codec(vocab_path, pattern).encode_ordinary
    return [np.array(encode(t), "<u4").tobytes() if t else b"" for t in texts]


def _encoder(vocab_path: str, pattern: str):
    @F.pandas_udf("binary")
    def encode_pieces(texts: pd.Series) -> pd.Series:
        return pd.Series(_ids(texts, vocab_path, pattern), dtype=object)

    return encode_pieces


def encode(
    df: DataFrame, vocab_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """The columns in ``keep`` and ``ids``: token ids as little-endian unsigned 32-bit integers."""
    encode_pieces = _encoder(vocab_path, pattern)
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    named = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    rows = df.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("t"))
    size = F.length("t")
    whole = rows.where(size <= chunk).select(*named, encode_pieces("t").alias("ids"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each chunk, each text walked through once. head, tail: boundaries in the overlap with the chunk before, and after."""
        for batch in batches:
            for row in batch.to_dict("records"):
                t = row.pop("t")
                starts = range(0, len(t), chunk)
                for k in range(0, len(starts), 16):
                    made = []
                    for n, x in enumerate(starts[k : k + 16], k):
                        core, extra = t[x : x + chunk], t[x + chunk : x + chunk + overlap]
                        found = boundaries(core + extra, pattern, len(core) + len(extra))
                        head = [b for b in found if b < overlap] if n else []
                        made.append((*row.values(), n, core, extra, head, [b - len(core) for b in found if b >= len(core)] if extra else []))
                    frame = pd.DataFrame(made, columns=[*row, "number", "core", "extra", "head", "tail"])
                    yield frame.astype({c: batch[c].dtype for c in row})

    kinds = dict(df.dtypes)
    # Integers go as text: pandas would turn those of a batch with nulls into floats.
    kinds = {c: "string" if k in ("bigint", "int", "smallint", "tinyint") else k for c, k in kinds.items()}
    own = "".join(f"k{i} {kinds[c]}, " for i, c in enumerate(keep))
    in_row = Window.partitionBy("row").orderBy("number")
    long = rows.where(size > chunk).select(*[F.col(f"k{i}").cast(kinds[c]).alias(f"k{i}") for i, c in enumerate(keep)], F.monotonically_increasing_id().alias("row"), "t")
    chunks = long.mapInPandas(cut, f"{own}row long, number int, core string, extra string, head array<int>, tail array<int>")
    # The first boundary that a chunk shares with the one before; once a chunk has none, what follows stays with the last that had one.
    synced = chunks.withColumn("sync", F.array_min(F.array_intersect(F.lag("tail").over(in_row), "head")))
    good = F.min(F.when((F.col("number") == 0) | F.col("sync").isNotNull(), 1).otherwise(0)).over(in_row)
    synced = synced.withColumn("good", good).withColumn("sync", F.when(F.col("number") == 0, 0).when(F.col("good") == 1, F.col("sync")))
    pieces = (
        synced.withColumn("until", F.lead("sync").over(in_row))
        .withColumn("piece", F.sum("good").over(in_row))
        .groupBy("row", "piece", *[f"k{i}" for i in range(len(keep))])
        .agg(
            F.array_sort(F.collect_list(F.struct("number", "core", "extra", "until"))).alias("c"),
            F.max(F.when(F.col("good") == 1, F.col("sync"))).alias("start"),
        )
    )
    joined = F.array_join(F.transform("c", lambda x: x["core"]), "")
    last = F.element_at("c", -1)
    end = F.when(last["until"].isNull(), F.length(joined)).otherwise(F.length(joined) + last["until"])
    pieces = pieces.select("row", "piece", *[f"k{i}" for i in range(len(keep))], F.substring(F.concat(joined, last["extra"]), F.col("start") + 1, end - F.col("start")).alias("t"))

    @F.pandas_udf("binary")
    def join(parts: pd.Series) -> pd.Series:
        return pd.Series([b"".join(p["b"] for p in ps) for ps in parts], dtype=object)

    stitched = (
        pieces.withColumn("b", encode_pieces("t"))
        .groupBy("row", *[f"k{i}" for i in range(len(keep))])
        .agg(F.array_sort(F.collect_list(F.struct("piece", "b"))).alias("parts"))
        .select(*[F.col(f"k{i}").cast(dict(df.dtypes)[c]).alias(c) for i, c in enumerate(keep)], join("parts").alias("ids"))
    )
    return whole.unionByName(stitched)


def decode(df: DataFrame, vocab_path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """Adds the raw bytes that the ids stand for; a null counts as no ids."""

    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        by_id = _bytes(vocab_path)
        for batch in tidied(batches):
            yield pd.Series([b"".join(map(by_id.__getitem__, np.frombuffer(b, "<u4").tolist())) if b else b"" for b in batch], dtype=object)

    # Iterator typing is what tells the engine to load the vocabulary once per task.
    raw.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(out, F.pandas_udf(raw, "binary")(F.col(ids)))

"""Benchmark decontamination by a broadcast set of normalised n-grams.

Windows are ``n`` consecutive words of a benchmark item; an item of fewer words,
but not none, is one window. Every document is scanned once against a set of
window hashes that is broadcast; hits are verified word by word. The set's size
is known before it is sent: items are dealt into blocks of at most
``block_windows`` windows, so what is broadcast at a time never grows with the
benchmark; with more than one block, documents are scanned a block at a time, only
hits are kept, by digest of the text, and the hit intervals merged.

Defined results: a null or empty text has no words and is clean; an item without
words has no window; a null item id counts as ''; repeated items count once for
each distinct id; repeated documents are judged each for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored, tidied, words

N = 13
BLOCK_WINDOWS = 2_000_000
#: Odd multiplier of the rolling window hash (fixed, so that all workers agree).
_BASE = 0x9E3779B97F4A7C15


class Windows:
    """The n-gram set of one block of items: word numbers, window hashes by length, items by window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], n: int):
        import numpy as np

        self.number: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        at = {name: i for i, name in enumerate(self.names)}
        self.items: dict[tuple[int, ...], set[int]] = {}
        for name, ws in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in ws]
            size = min(n, len(ids))
            for p in range(len(ids) - size + 1) if size else ():
                self.items.setdefault(tuple(ids[p : p + size]), set()).add(at[name])
        self.hashes = {}
        for size in {len(w) for w in self.items}:
            each = np.array([w for w in self.items if len(w) == size], "u8")
            self.hashes[size] = np.unique(self._hash(each.T))

    @staticmethod
    def _hash(columns):
        import numpy as np

        h = np.zeros(len(columns[0]), "u8")
        with np.errstate(over="ignore"):
            for c in columns:
                h = (h ^ c) * np.uint64(_BASE)
        return h

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit intervals [from, to) in words, merged, and the numbers of the items hit."""
        import numpy as np

        found, items = [], set()
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in ws), "u8", len(ws))
        # run[p]: how many known words in a row start at p.
        stop = np.append(np.flatnonzero(ids == 0), len(ids))
        if not len(ids):
            return [], set()
        run = stop[np.searchsorted(stop, np.arange(len(ids)))] - np.arange(len(ids))
        for size, known in self.hashes.items():
            at = np.flatnonzero(run >= size)
            if not len(at):
                continue
            h = self._hash([ids[at + k] for k in range(size)])
            near = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for p in at[known[near] == h].tolist():
                if (who := self.items.get(tuple(ids[p : p + size].tolist()))) is not None:
                    found.append((p, p + size))
                    items |= who
        return merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, n: int, block_windows: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items by blocks of a bounded number of windows, read through an iterator: the driver holds the words of a block at a time.

    An item of more windows than a block is dealt over several blocks.
    """
    block, size = [], 0
    for name, t in benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(text)).toLocalIterator():
        ws = words(t)
        for start in range(0, max(len(ws) - n + 1, 1), block_windows):
            part = ws[start : start + block_windows + n - 1]
            if block and size + len(part) > block_windows:
                yield block
                block, size = [], 0
            block.append((name, part))
            size += len(part)
    yield block


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), item_id: str = "item_id", item_text: str = "text",
    n: int = N, min_share: float = 0.05, action: str | None = None, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The columns in ``keep``, n_words, n_hit, n_items, items_sha256, contaminated and, with ``action``, the text that stays.

    action 'spans' removes the words of hit intervals (from the first to the last character of each) from contaminated documents;
    'documents' leaves the text and the caller drops rows by ``contaminated``.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))
    own = rows.columns[:-1]
    blocks = _blocks(benchmark, item_id, item_text, n, block_windows)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        found = rows.withColumn("hits", _hits(spark.sparkContext.broadcast(Windows(block, n)))("t"))
    else:
        # Hits depend on the text alone: those of each block are kept by the text's digest, and no text is written or shuffled twice.
        digest = F.sha2(F.coalesce("t", F.lit("")), 256)
        texts, hits = rows.select(digest.alias("d"), "t"), None
        while block is not None:
            one = texts.select("d", _hits(spark.sparkContext.broadcast(Windows(block, n)))("t").alias("hits")).where(F.size("hits.spans") > 0)
            one = stored(one.dropDuplicates(["d"]))
            hits = one if hits is None else hits.unionByName(one)
            block, following = following, next(blocks, None)
        merged_hits = hits.groupBy("d").agg(F.flatten(F.collect_list("hits.spans")).alias("spans"), F.flatten(F.collect_list("hits.names")).alias("names"))
        none = lambda kind: F.array().cast(f"array<{kind}>")
        joined = rows.withColumn("d", digest).join(merged_hits, "d", "left")
        found = joined.select(*rows.columns, F.struct(F.coalesce("spans", none("int")).alias("spans"), F.coalesce("names", none("string")).alias("names")).alias("hits"))
    out = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean" + (", clean string" if action == "spans" else "")
    names = [x.split()[0] for x in out.split(", ")]

    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, every, items in tidied(batches):
            got = []
            for t, flat, who in zip(texts, every, items):
                n_words, spans = len(words(t)), merged(list(zip(flat[::2].tolist(), flat[1::2].tolist())))
                hit = sum(b - a for a, b in spans)
                bad = hit > 0 and hit >= min_share * n_words
                row = [n_words, hit, len(set(who)), hashlib.sha256(",".join(sorted(set(who))).encode()).hexdigest(), bad]
                if action == "spans":
                    row.append(without(t, spans) if bad else t)
                got.append(row)
            yield pd.DataFrame(got, columns=names)

    judge.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    judged = found.select(*own, F.pandas_udf(judge, out)("t", "hits.spans", "hits.names").alias("judged")).select(*own, *[F.col(f"judged.{c}").alias(f"r{i}") for i, c in enumerate(names)])
    return judged.toDF(*keep, *names)


def _hits(windows):
    """The hits of one block of items in texts: spans (starts and ends in a row) and names. Only texts go to Python."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans, names = [], []
            for t in batch:
                new, items = windows.value.scan(words(t))
                spans.append([x for span in new for x in span])
                names.append([windows.value.names[i] for i in sorted(items)])
            yield pd.DataFrame({"spans": spans, "names": names})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "spans array<int>, names array<string>")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the intervals; white space around a cut becomes one space."""
    import re

    places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : places[a][0]].rstrip())
        last = places[b - 1][1]
    out.append(text[last:].lstrip() if out else text[last:])
    return " ".join(x for x in out if x)

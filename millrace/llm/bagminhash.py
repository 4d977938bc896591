"""Near-duplicate documents by weighted minwise hashing.

A document is the multiset of its five-word shingles. For every shingle a Poisson
process runs over time and weight; its weight axis is cut into blocks that double
in width ([0,1), [1,2), [2,4), ...), so a heavy shingle costs a few processes, and
a point counts for a document if it lies below the shingle's weight there. Every
point falls into one of M registers, which keep the earliest. Two documents agree
in a register with probability equal to their weighted Jaccard similarity.

BANDS bands of ROWS registers deal documents into buckets; documents that share a
bucket, directly or through others, form a cluster of candidates. Every pair in a
cluster is verified on the exact multisets, through an inverted index, in blocks
of bounded size (a large cluster is dealt into blocks, and every pair of blocks is
a task); a task returns a spanning forest of the links, not the links. At
similarity 0.8 a pair misses all buckets with probability below 1e-4, and then
only counts as missed if no chain of other links joins it.

Defined results: words are lower-cased at A-Z and split at ASCII characters that
are neither letters nor digits; documents of equal words are copies; one of fewer
than five words is a single shingle; a null or empty text has the empty shingle,
so such texts are copies of each other. A class is named by its least id (null
only if all are null). Repeated rows keep one row each in ``classes``; ``keep_one``
keeps one row of each class: that of the least id, then the least digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, free_names, tidied, words
from millrace.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
#: Shingles of a block in verification.
BLOCK_SHINGLES = 400_000
_U = np.uint64
_STEP, _PLACE, _SLOT = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)
#: Up to how many expected points a process is stepped how far at once.
_LIKELY, _STEPS = (0.4, 1.2, 4, 12, 40), (1, 2, 4, 12, 32, 96)
_CACHE_WORDS = 100_000
_known: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def digest(ws: list[bytes]) -> bytes:
    """128 bits that name a word sequence."""
    return xxhash.xxh3_128_digest(b" ".join(ws))


def shingles(ws: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles, and how often each occurs."""
    if len(ws) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(ws), len(ws) + 1)], "u8"), np.ones(1, np.int64)
    if len(_known) > _CACHE_WORDS:
        _known.clear()
    each = list(map(_known.get, ws))
    if None in each:
        for i, h in enumerate(each):
            if h is None:
                each[i] = _known[ws[i]] = xxhash.xxh64_intdigest(ws[i])
    h = np.array(each, "u8")
    n = len(ws) - size + 1
    total = np.zeros(n, "u8")
    for k in range(size):
        total = _mix(total + h[k : k + n])
    return np.unique(total, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """For each multiset the earliest time in each register; times of one point are equal in all documents that have it."""
    out = np.full((len(bags), registers), np.inf)
    points = registers * (np.log(registers) + 3)
    todo = np.arange(len(bags))
    while len(todo):
        sizes = np.array([len(bags[i][0]) for i in todo])
        element, weight = (np.concatenate([bags[i][k] for i in todo]) for k in (0, 1))
        of = np.repeat(np.arange(len(todo)), sizes)
        horizon = points / np.bincount(of, weight)
        best = np.full(len(todo) * registers, np.inf)
        block = 0
        at = np.arange(len(element))
        while len(at):
            low, width = (0, 1) if block == 0 else (1 << (block - 1), 1 << (block - 1))
            at = at[weight[at] > low]
            if len(at):
                _run(best, element[at], of[at], horizon[of[at]], block, low, width, weight[at], registers)
            block += 1
        best = best.reshape(len(todo), registers)
        full = np.isfinite(best).all(axis=1)
        out[todo[full]] = best[full]
        todo, points = todo[~full], points * 2
    return out


def _run(best, element, of, horizon, block, low, width, weight, registers) -> None:
    """One process for each element, as far as its document's horizon; points below the weight go into the registers."""
    seed, t, k = _mix(element ^ _mix(_U([block + 1]) * _SLOT)), np.zeros(len(element)), np.zeros(len(element), "u8")
    whole = weight >= low + width
    on = np.arange(len(element))
    while len(on):
        expected = (horizon[on] - t[on]) * width
        order = np.searchsorted(_LIKELY, expected)
        for j, steps in enumerate(_STEPS):
            # Elements that have as many points to go are stepped together.
            every = on[order == j]
            for a in range(0, len(every), (1 << 19) // steps):
                e = every[a : a + (1 << 19) // steps]
                h = _mix(seed[e, None] + (k[e, None] + np.arange(1, steps + 1, dtype="u8")) * _STEP)
                gap = -np.log(((h >> _U(11)).astype(float) + 0.5) * 2.0**-53) / width
                gap[:, 0] += t[e]
                times = np.cumsum(gap, axis=1) if steps > 1 else gap
                t[e] = times[:, -1]
                row, col = np.nonzero(times < horizon[e, None])
                x, when, of_row = h[row, col], times[row, col], e[row]
                if not whole[e].all():
                    place = low + (_mix(x ^ _PLACE) >> _U(11)).astype(float) * 2.0**-53 * width
                    good = place < weight[of_row]
                    x, when, of_row = x[good], when[good], of_row[good]
                np.minimum.at(best, of[of_row] * registers + (_mix(x ^ _SLOT) % _U(registers)).astype(np.int64), when)
            k[every] += _U(steps)
        on = on[t[on] < horizon[on]]


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = signature.view("u8").reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype="u8") * _STEP, bits.shape[:2]).copy()
    for k in range(rows):
        out = _mix(out ^ bits[:, :, k]) + _PLACE
    return out.view(np.int64)


def prints(docs: DataFrame, text: str, doc_id: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, h (hash of the text as it is), digest, n (shingles), bands of every row. Only texts go to Python: ids stay what they are."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in tidied(batches):
            lists = [words(t) for t in batch]
            bags = [shingles(ws) for ws in lists]
            hashed = band_hashes(signatures(bags, bands * rows), bands, rows) if bags else []
            yield pd.DataFrame({"digest": [digest(ws) for ws in lists], "n": [int(c.sum()) for _, c in bags], "bands": list(hashed)})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    made = F.pandas_udf(run, "digest binary, n long, bands array<long>")
    hashed = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), made(F.col(text)).alias("p"))
    return hashed.select("id", "h", "p.digest", "p.n", "p.bands")


def forest(bags: list[tuple[np.ndarray, np.ndarray]], threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs at or above the threshold: every pair is compared unless all are connected already."""
    n = len(bags)
    root = np.arange(n)
    total = np.array([c.sum() for _, c in bags], float)
    hashes, doc, count = np.concatenate([h for h, _ in bags]), np.repeat(np.arange(n), [len(h) for h, _ in bags]), np.concatenate([c for _, c in bags])
    _, number = np.unique(hashes, return_inverse=True)
    order = np.argsort(number, kind="stable")
    doc, count, sorted_number = doc[order], count[order], number[order]
    first = np.searchsorted(sorted_number, np.arange(sorted_number[-1] + 2))
    ends, own, edges = np.cumsum([len(h) for h, _ in bags]), number, []
    for i in range(n - 1):
        if (root == root[0]).all():
            break
        mine = own[ends[i] - len(bags[i][0]) : ends[i]]
        length = first[mine + 1] - first[mine]
        at = np.repeat(first[mine] - np.cumsum(length) + length, length) + np.arange(length.sum())
        shared = np.bincount(doc[at], np.minimum(count[at], np.repeat(bags[i][1], length)), minlength=n)
        near = np.flatnonzero(shared >= threshold * (total[i] + total - shared) - 1e-9)
        for j in near[near > i].tolist():
            if root[i] != root[j]:
                edges.append((i, j))
                root[root == root[j]] = root[i]
    return edges


def links(members: DataFrame, docs: DataFrame, text: str, doc_id: str, threshold: float, block: int) -> DataFrame:
    """a, b: a spanning forest of the verified links between members (cluster, node, id, h, digest, n) of the same cluster."""
    sizes = members.groupBy("cluster").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    tasks = (
        members.join(sizes, "cluster")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "id", "h", "digest")
    )
    # The text's hash beside the id: rows without an id, or with the same one, don't all meet each other.
    texts = docs.select(F.col(doc_id).alias("id2"), F.xxhash64(text).alias("h2"), F.col(text).alias("t"))
    rows = tasks.join(texts, (F.col("h") == F.col("h2")) & F.col("id").eqNullSafe(F.col("id2"))).select("cluster", "i", "j", "node", "digest", "t")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        now = None

        def out():
            nodes = sorted(held)
            found = forest([held[x] for x in nodes], threshold) if len(nodes) > 1 else []
            held.clear()
            return [(nodes[i], nodes[j]) for i, j in found]

        for batch in tidied(batches):
            edges = []
            for c, i, j, node, d, t in batch.itertuples(index=False):
                if (c, i, j) != now:
                    edges += out() if held else []
                    now = (c, i, j)
                ws = words(t)
                if digest(ws) == d:  # else another row of the same id
                    held[node] = shingles(ws)
            yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")
        if held:
            yield pd.DataFrame(out(), columns=["a", "b"], dtype="int64")

    dealt = rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return dealt.mapInPandas(run, "a long, b long")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, block: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, digest, class_id and class_digest (of the row that stands for the class) of every row."""
    every = cut(prints(docs, text, doc_id))
    nodes = cut(
        every.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("one"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select("digest", "one.id", "one.h", "n", "bands").withColumn("node", F.monotonically_increasing_id())
    )
    dealt = nodes.select("node", F.explode("bands").alias("bucket"))
    full = dealt.groupBy("bucket").agg(F.min("node").alias("least"), F.count("*").alias("c")).where("c > 1").select("bucket", "least")
    near = dealt.join(full, "bucket").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    clusters = components(near).withColumnRenamed("root", "cluster")
    members = cut(nodes.drop("bands").join(clusters, "node"))
    roots = components(links(members, docs, text, doc_id, threshold, block))
    placed = nodes.select("node", "digest", "id").join(roots, "node", "left").select("digest", "id", F.coalesce("root", "node").alias("root"))
    named = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("digest").alias("digest"))).alias("first"))
    of = placed.join(named, "root").select("digest", F.col("first.id").alias("class_id"), F.col("first.digest").alias("class_digest"))
    return every.select(F.col("id").alias(doc_id), "digest").join(of, "digest").select(doc_id, "digest", "class_id", "class_digest")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that stand for their classes, with all their columns."""
    kept = classes(docs, text, doc_id, threshold).where(F.col("digest") == F.col("class_digest")).where(F.col(doc_id).eqNullSafe(F.col("class_id")))
    own_digest, id_, digest_ = free_names(docs, 3)
    kept = kept.select(F.col(doc_id).alias(id_), F.col("digest").alias(digest_)).distinct()

    @F.pandas_udf("binary")
    def named(texts: pd.Series) -> pd.Series:
        return pd.Series([digest(words(t)) for t in texts], dtype=object)

    own = docs.withColumn(own_digest, named(F.col(text)))
    return own.join(kept, (F.col(own_digest) == F.col(digest_)) & F.col(doc_id).eqNullSafe(F.col(id_))).dropDuplicates([own_digest]).select(*docs.columns)

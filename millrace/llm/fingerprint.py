"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: at line ends, and inside a line after words whose
hash says so, MEAN_WORDS words long on the average whatever the size of the text, so
that an edit changes the paragraphs it touches and no others.

A sketch adds every paragraph's digest into one cell of each of three subtables
(count, sum of digests; a digest carries its own check). A fingerprint is the sketch in
the least size, by powers of two, at which it can be listed: peeling cells that hold a
single digest recovers all of them. So a fingerprint grows with its text (it is about
half as long) and none of its paragraphs is left out.

Likeness is taken from two fingerprints alone. Their sketches are subtracted cell by
cell (the larger folded to the size of the smaller); what they share cancels out, and
peeling recovers the paragraphs that differ. Where that gets stuck, both are listed,
built anew four times as large, and subtracted again, until it succeeds. Likeness is
shared paragraphs over all paragraphs (a repeated paragraph counts as often as it
occurs).

Defined results: a null text counts as empty, an empty text is one empty paragraph;
equal texts have equal fingerprints; documents follow each other by id (null first),
equal ids by a hash of the text and the text, and after the last comes the first;
repeated rows are each a document; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MEAN_WORDS = 8
WAYS = 3
#: Cells for each digest that a sketch starts with, before its size is made a power of two.
ROOM = 1.25
PAIRS, PAIR_CHARS = 256, 4_000_000
RANGE_BYTES = 64 << 20
_CACHE_WORDS = 500_000
_U = np.uint64
_CHECK_BITS = _U(20)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiplications and shifts that spread every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _check(x: np.ndarray) -> np.ndarray:
    return _mix(x ^ _U(0xA0761D6478BD642F)) >> (_U(64) - _CHECK_BITS)


def _starts(hashes: np.ndarray, line_end: int, mean: int) -> np.ndarray:
    ends = (hashes % _U(mean) == 0) | (hashes == _U(line_end))
    return np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1])


def _digests(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Digests made distinct: the k-th occurrence of a paragraph has one of its own. 44 bits, and a check of 20 of them."""
    place = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))
    keys = np.sort(_mix(np.add.reduceat(_mix(hashes + place.astype("u8") * _U(0x9E3779B97F4A7C15)), starts)))
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    run = np.flatnonzero(first)
    times = np.arange(len(keys)) - np.repeat(run, np.diff(np.append(run, len(keys))))
    x = np.unique(_mix(keys + times.astype("u8") * _U(0xD1B54A32D192ED03)) >> _CHECK_BITS)
    return (x << _CHECK_BITS) | _check(x)


class Digests:
    """Paragraph digests of texts, a set for each kind of paragraph (there is one); remembers word hashes."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> list[np.ndarray]:
        if len(self.known) > _CACHE_WORDS:
            self.known.clear()
        known, h = self.known, xxhash.xxh64_intdigest
        ws = text.encode("utf-8", "surrogatepass").replace(b"\n", b" \n ").split(b" ")
        each = list(map(known.get, ws))
        if None in each:
            for i, v in enumerate(each):
                if v is None:
                    each[i] = known[ws[i]] = h(ws[i])
        hashes, end = np.array(each, "u8"), h(b"\n")
        return [_digests(hashes, _starts(hashes, end, MEAN_WORDS))]


def _cells(keys: np.ndarray, of: np.ndarray, size: int) -> list[np.ndarray]:
    """For each subtable, the cell of each key, in the sketch numbered ``of``."""
    return [(of * WAYS + j) * size + (_mix(keys + _U(j + 1)) & _U(size - 1)).astype(np.int64) for j in range(WAYS)]


def _size(n: int) -> int:
    """The least power of two with which the subtables have room for so many digests."""
    return 1 << max(2, int(np.ceil(np.log2(max(n, 1) * ROOM / WAYS))))


class Sketches:
    """Many sketches of one size, side by side."""

    def __init__(self, n: int, size: int):
        self.n, self.size = n, size
        self.count, self.keys = np.zeros(n * WAYS * size, np.int64), np.zeros(n * WAYS * size, "u8")

    def add(self, keys: np.ndarray, of: np.ndarray, sign: np.ndarray) -> None:
        signed = keys * sign.astype(np.int64).view("u8")
        for at in _cells(keys, of, self.size):
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, signed)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Recovered keys, the sketch of each and its sign; and of each sketch whether nothing is left."""
        out = [(np.zeros(0, "u8"), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        budget = len(self.count) + 1  # a cell taken for a single digest by chance could go on for ever
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look) and budget > 0:
            sign = self.count[look]
            keys = self.keys[look] * sign.view("u8")
            pure = keys & ((_U(1) << _CHECK_BITS) - _U(1)) == _check(keys >> _CHECK_BITS)
            keys, sign, of = keys[pure], sign[pure], look[pure] // (WAYS * self.size)
            if not len(keys):
                break
            _, first = np.unique(_mix(keys) + of.astype("u8") * _U(0x9E3779B97F4A7C15), return_index=True)
            keys, sign, of = keys[first], sign[first], of[first]
            out.append((keys, of, sign))
            budget -= len(keys)
            self.add(keys, of, -sign)
            look = np.unique(np.concatenate(_cells(keys, of, self.size)))
            look = look[np.abs(self.count[look]) == 1]
        left = (self.count != 0) | (self.keys != 0)
        keys, of, sign = (np.concatenate([o[i] for o in out]) for i in range(3))
        return keys, of, sign, ~left.reshape(self.n, -1).any(axis=1)


#: A sketch read from a fingerprint: number of digests, size, counts, sums.
Sketch = tuple[int, int, np.ndarray, np.ndarray]


def _listed(sketches: list[Sketch]) -> list[np.ndarray]:
    """All digests of each sketch."""
    out: list[np.ndarray] = [np.zeros(0, "u8")] * len(sketches)
    for size in {s[1] for s in sketches}:
        which = [i for i, s in enumerate(sketches) if s[1] == size]
        many = Sketches(len(which), size)
        many.count, many.keys = (np.concatenate([sketches[i][k] for i in which]) for k in (2, 3))
        keys, of, _, done = many.peel()
        if not done.all():
            raise ValueError("not a fingerprint: its digests can't be listed")
        order = np.argsort(of, kind="stable")
        for i, part in zip(which, np.split(keys[order], np.cumsum(np.bincount(of, minlength=len(which)))[:-1])):
            out[i] = part
    return out


def sketched(digests: list[np.ndarray]) -> list[Sketch]:
    """The least sketch of each set of digests that can be listed."""
    out: list[Sketch | None] = [None] * len(digests)
    todo = [(i, _size(len(d))) for i, d in enumerate(digests)]
    while todo:
        again = []
        for size in {s for _, s in todo}:
            which = [i for i, s in todo if s == size]
            many, own = Sketches(len(which), size), WAYS * size
            keys = np.concatenate([digests[i] for i in which])
            many.add(keys, np.repeat(np.arange(len(which)), [len(digests[i]) for i in which]), np.ones(len(keys), np.int64))
            made = many.count.copy(), many.keys.copy()
            *_, done = many.peel()
            for k, i in enumerate(which):
                if done[k] and made[0][k * own : (k + 1) * own].max() < 128:
                    out[i] = len(digests[i]), size, made[0][k * own : (k + 1) * own], made[1][k * own : (k + 1) * own]
                else:
                    again.append((i, size * 2))
        todo = again
    return out


def written(levels: list[Sketch]) -> str:
    parts = []
    for n, size, count, keys in levels:
        parts += [np.array([n, size], "<u4").tobytes(), count.astype("u1").tobytes(), keys.astype("<u8").tobytes()]
    return base64.b64encode(b"".join(parts)).decode()


def read(fingerprint: str) -> list[Sketch]:
    raw, at, out = base64.b64decode(fingerprint), 0, []
    while at < len(raw):
        n, size = np.frombuffer(raw, "<u4", 2, at).tolist()
        cells = WAYS * size
        out.append((n, size, np.frombuffer(raw, "i1", cells, at + 8).astype(np.int64), np.frombuffer(raw, "<u8", cells, at + 8 + cells).astype("u8")))
        at += 8 + 9 * cells
    return out


def fingerprints(texts: list[str], digests: Digests) -> list[str]:
    levels = [digests(t) for t in texts]
    made = iter(sketched([d for each in levels for d in each]))
    return [written([next(made) for _ in each]) for each in levels]


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    return x.reshape(WAYS, -1, size).sum(axis=1, dtype=x.dtype).ravel()


def likeness(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Shared over all digests of each pair of fingerprints."""
    kept = {f: read(f) for pair in pairs for f in pair}
    same = [min(len(kept[a]), len(kept[b])) - 1 for a, b in pairs]
    both = [(kept[a][k], kept[b][k]) for (a, b), k in zip(pairs, same)]
    out, stuck = np.ones(len(pairs)), []
    sizes = [min(a[1], b[1]) for a, b in both]

    def settle(which, many):
        _, of, sign, done = many.peel()
        plus, minus = (np.bincount(of[sign == s], minlength=many.n) for s in (1, -1))
        for k, i in enumerate(which):
            if done[k]:
                out[i] = np.clip((both[i][0][0] - plus[k]) / max(both[i][0][0] + minus[k], 1), 0, 1)
            else:
                stuck.append(i)

    for size in set(sizes):
        which = [i for i, s in enumerate(sizes) if s == size]
        many = Sketches(len(which), size)
        many.count, many.keys = (np.concatenate([_folded(both[i][0][k], size) - _folded(both[i][1][k], size) for i in which]) for k in (2, 3))
        settle(which, many)
    todo, stuck = sorted(stuck), []
    if todo:
        # Each fingerprint is listed once, however many pairs it is in.
        wanted = {(f, same[i]): kept[f][same[i]] for i in todo for f in pairs[i]}
        listed = dict(zip(wanted, _listed(list(wanted.values()))))
        by = 4
        while todo:
            for size in {sizes[i] * by for i in todo}:
                which = [i for i in todo if sizes[i] * by == size]
                many = Sketches(len(which), size)
                keys = [(listed[pairs[i][0], same[i]], listed[pairs[i][1], same[i]]) for i in which]
                lengths = [len(k) for pair in keys for k in pair]
                many.add(np.concatenate([k for pair in keys for k in pair]), np.repeat(np.repeat(np.arange(len(which)), 2), lengths), np.repeat(np.tile([1, -1], len(which)), lengths))
                settle(which, many)
            todo, stuck, by = sorted(stuck), [], by * 4
    return out


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (b, end, k, h, id, t), in each range b of ids sorted and followed by the first row of the range after (end 1).

    There are as many ranges as shuffles have partitions, or more where they would be larger than RANGE_BYTES; an id
    with more rows than a range is dealt over several by the hash of the text. What is broadcast has a row for each range.
    """
    spark = docs.sparkSession
    k = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)))
    rows = docs.select(k.alias("k"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2, -(-size // RANGE_BYTES))
    cuts = rows.select(F.col("k").cast("double")).approxQuantile("k", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    shared = spark.sparkContext.broadcast(np.sort(np.array(cuts)))

    @F.pandas_udf("int")
    def dealt(keys: pd.Series, hashes: pd.Series) -> pd.Series:
        """The range of each id; one at which several ranges end is dealt over them by the hash, in its order."""
        at = keys.to_numpy(float)
        below, upto = (np.searchsorted(shared.value, at, side) for side in ("left", "right"))
        equal = upto - below
        part = np.minimum(np.floor((hashes.to_numpy(float) / 2.0**64 + 0.5) * np.maximum(equal, 1)), np.maximum(equal, 1) - 1)
        return pd.Series(below + np.where(equal > 0, 1 + part, 0).astype(np.int64)).astype("int32")

    rows = rows.withColumn("b", dealt("k", "h"))
    # The first row of each range goes to the range before it as well: a row for each range.
    firsts = rows.groupBy("b").agg(F.min(F.struct("k", "h")).alias("first"))
    last = firsts.agg(F.max("b").alias("last"))
    before = F.coalesce(F.lag("b").over(Window.orderBy("b")), F.col("last"))
    firsts = firsts.join(F.broadcast(last), F.lit(True)).select(F.col("first.k").alias("k1"), F.col("first.h").alias("h1"), before.alias("to"))
    ends = rows.join(F.broadcast(firsts), (F.col("k") == F.col("k1")) & (F.col("h") == F.col("h1"))).withColumn("b", F.col("to"))
    wanted = ["b", "end", "k", "h", "id", "t"]
    both = rows.withColumn("end", F.lit(0)).select(*wanted).unionByName(ends.withColumn("end", F.lit(1)).select(*wanted))
    return both.repartition(ranges, "b").sortWithinPartitions("b", "end", "k", "h", "t")


def versions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = 4) -> DataFrame:
    """Every document against an edited version of itself, whose last 1/share is the start of the next document, and against that document."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        digests, held = Digests(), []

        def flush():
            # held: id, text, edited text, next text; the next text is the text of the row after, if that is held too.
            follows = [k + 1 < len(held) and held[k + 1][1] is h[3] for k, h in enumerate(held)]
            own = fingerprints([h[1] for h in held], digests)
            edited = fingerprints([h[2] for h in held], digests)
            others = iter(fingerprints([h[3] for h, f in zip(held, follows) if not f], digests))
            after = [own[k + 1] if f else next(others) for k, f in enumerate(follows)]
            near = likeness([*zip(own, edited), *zip(own, after)])
            n = len(held)
            out = pd.DataFrame({
                "id": [h[0] for h in held],
                "n_chars": [len(h[1]) for h in held],
                "edited_sha256": [hashlib.sha256(h[2].encode("utf-8", "surrogatepass")).hexdigest() for h in held],
                "fingerprint": own,
                "edited_fingerprint": edited,
                "near_edited": near[:n],
                "near_next": near[n:],
            })
            held.clear()
            return out

        last, done, size = None, False, 0  # the row before: range, id, text
        for batch in batches:
            for b, end, i, t in zip(batch["b"], batch["end"], batch["id"], batch["t"]):
                if last is not None and last[0] == b and not done:
                    cut = len(last[2]) // share
                    held.append((last[1], last[2], last[2][: len(last[2]) - cut] + t[:cut], t))
                    size += 3 * len(last[2])
                    if len(held) >= PAIRS or size > PAIR_CHARS:
                        yield flush()
                        size = 0
                done = bool(end)
                last = None if end and (last is None or last[0] == b) else (b, i, t)
        if held:
            yield flush()

    names = "id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    rows = in_order(docs, doc_id, text).select("b", "end", F.col("id").cast("string").alias("id"), "t")  # as text: pandas would turn integers beside nulls into floats
    made = rows.mapInPandas(run, names)
    return made.select(F.col("id").cast(kind).alias(doc_id), *made.columns[1:])

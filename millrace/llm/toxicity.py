"""Toxicity by compression distance.

Pairs of zstandard dictionaries are trained, each with one for toxic and one for
ordinary text, by zstandard's own cover training on the windows of labelled documents.
Both of a pair end in the same trained piece of ordinary text, so that ordinary windows
compress alike; in front stands a piece trained on the toxic documents in the one, on
ordinary documents in the other. A window is WINDOW_WORDS words, each behind a short
mark, so that a match runs from the mark into the word, between a head that both
dictionaries hold and a tail that zstandard's match finders don't search. A window's
distance is how many bytes the toxic dictionaries save more than the ordinary ones,
added up over the pairs, or 0 where that isn't positive for the first of them.

Calibration on labelled documents that the dictionaries have not seen pools distances
until the share of toxic windows rises with them, keeps those that are clearly commoner
in toxic documents, weighs them by their likelihood ratios, and maps a document's sum to
a probability by logistic regression.

The labelled rows that teach are a sample, bounded by ``sample`` documents and
``sample_bytes`` bytes of text for each label (those of lowest id hash, whole texts), of
which near copies (word sets of a Jaccard similarity of ALIKE or more) count once. Every
whole text is scored. Defined results: a null text counts as empty; a text without words
has the probability of a text without evidence; of several labels for an id the largest
counts; labels without a document and null labels teach nothing; without rows of both
labels every score is the share of toxic ones (0 without labels); repeated rows are
scored alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import tidied

SAMPLE, SAMPLE_BYTES = 3_000, 8 << 20
WINDOW_WORDS = 1
#: Lengths of the segments that the training of each pair of dictionaries picks, and of the substrings it counts.
SEGMENTS, SUBSTRING = (64, 40, 56, 72, 88), 8
#: Bytes of the piece that is a dictionary's own and of the piece of ordinary text in both.
OWN_BYTES, SHARED_BYTES = 6_000, 15_000
MARK, HEAD, TAIL = bytes(range(1, 4)), bytes(range(128, 152)), bytes(range(200, 208))
#: Distances that are told apart.
DISTANCES = 60
#: Least log likelihood ratio of a distance that counts, and the least number of toxic windows there.
CLEAR, SEEN = 1.0, 3
#: Word sets at least so alike are near copies; they are found by so many bands of so many minima.
ALIKE, BANDS, ROWS = 0.8, 20, 5
_CACHE_WINDOWS = 50_000
_EDGE = b"\"'([{<*_-.,;:!?)]}>"


def window_words(text: str | None) -> list[bytes]:
    return [w for w in (x.strip(_EDGE) for x in (text or "").encode("utf-8", "surrogatepass").lower().split()) if w]


def _marked(ws: list[bytes]) -> bytes:
    return b"".join(MARK + w + b" " for w in ws)


def _compressor(content: bytes):
    import zstandard as zs

    params = zs.ZstdCompressionParameters(
        format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
        window_log=17, hash_log=16, chain_log=16, search_log=8, min_match=3, target_length=64, strategy=zs.STRATEGY_BTOPT,
    )
    d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zs.ZstdCompressor(dict_data=d, compression_params=params)


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """The content of a dictionary that zstandard trains, filled up in front; of too few samples the last bytes."""
    import zstandard as zs

    try:
        raw = zs.train_dictionary(size, samples, k=segment, d=SUBSTRING, f=20, accel=1).as_bytes()
        raw = raw[max(raw.find(MARK), 0) :]  # without the tables of symbols, which windows this short don't pay for
    except zs.ZstdError:
        raw = b"".join(samples)
    return raw[-size:].rjust(size, b"\0")


@dataclass
class Model:
    pairs: list[tuple[bytes, bytes]] = field(default_factory=list)  # ordinary, toxic
    weight: np.ndarray = field(default_factory=lambda: np.zeros(DISTANCES))
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None

    def start(self) -> None:
        """Compressors are made where they are used."""
        self._pairs = [(_compressor(o).compress, _compressor(t).compress) for o, t in self.pairs]
        self._known: dict[bytes, int] = {}
        self._older: dict[bytes, int] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}

    def distance(self, window: bytes) -> int:
        x, total = HEAD + window + TAIL, 0
        for k, (ordinary, toxic) in enumerate(self._pairs):
            total += len(ordinary(x)) - len(toxic(x))
            if not k and total < 1:
                return 0
        return min(max(total, 0), DISTANCES - 1)

    def distances(self, ws: list[bytes]) -> np.ndarray:
        """How many windows have each distance."""
        if len(self._known) > _CACHE_WINDOWS:  # windows not seen since the last time are forgotten
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        windows = ws if WINDOW_WORDS == 1 else [b" ".join(ws[k : k + WINDOW_WORDS]) for k in range(0, len(ws), WINDOW_WORDS)]
        out = list(map(known.get, windows))
        if None in out:
            for k, d in enumerate(out):
                if d is None:
                    window = windows[k]
                    d = known.get(window, older.get(window))
                    if d is None:
                        d = self.distance(_marked(ws[k * WINDOW_WORDS : (k + 1) * WINDOW_WORDS]))
                    out[k] = known[window] = d
        return np.bincount(out, minlength=DISTANCES).astype(float)

    def score(self, texts: Iterable[str | None]) -> list[float]:
        if self.constant is not None:
            return [self.constant for _ in texts]
        sums = [float(self.distances(window_words(t)) @ self.weight) for t in texts]
        return [1 / (1 + math.exp(-min(max(self.slope * s + self.offset, -30), 30))) for s in sums]


def without_copies(docs: list[bytes]) -> list[bytes]:
    """Documents (words joined by spaces) whose word sets have a Jaccard similarity below ALIKE to every earlier one that stays.

    Compared are those that agree in all ROWS minima of any of BANDS bands: at 0.8 all but 4e-4 of the pairs, at 0.1 2e-4.
    """
    salts = np.random.default_rng(1).integers(1, 2**63, (2, BANDS * ROWS), dtype="u8") | np.uint64(1)
    seen: dict[tuple[int, bytes], list[int]] = {}
    out, sets = [], []
    for doc in docs:
        own = np.unique(np.array([xxhash.xxh64_intdigest(w) for w in set(doc.split(b" "))], "u8"))
        low = np.array([((own ^ a) * b).min() for a, b in salts.T]).reshape(BANDS, ROWS)
        keys = [(i, xxhash.xxh64_digest(row.tobytes())) for i, row in enumerate(low)]
        tried = {k for key in keys for k in seen.get(key, ())}
        if any((n := len(np.intersect1d(own, sets[k], True))) >= ALIKE * (len(own) + len(sets[k]) - n) for k in tried):
            continue
        for key in keys:
            seen.setdefault(key, []).append(len(out))
        out.append(doc)
        sets.append(own)
    return out


def rising(toxic: np.ndarray, ordinary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of windows by distance, neighbours pooled until the share of toxic ones rises with the distance."""
    pools: list[list[float]] = []
    for a, b in zip(toxic, ordinary):
        pools.append([a, b, 1])
        while len(pools) > 1 and pools[-2][0] * (pools[-1][0] + pools[-1][1]) >= pools[-1][0] * (pools[-2][0] + pools[-2][1]):
            a2, b2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + a2, pools[-1][1] + b2, pools[-1][2] + n2]
    out = np.array([[a, b] for a, b, n in pools for _ in range(int(n))])
    return out[:, 0], out[:, 1]


def fit(toxic: list[bytes], ordinary: list[bytes], n_toxic: float, n_ordinary: float) -> Model:
    """A model from sampled documents (words joined by spaces); n_toxic and n_ordinary: how many the sample stands for."""
    if not toxic or not ordinary:
        return Model(constant=n_toxic / (n_toxic + n_ordinary) if n_toxic + n_ordinary else 0.0)
    toxic, ordinary = without_copies(toxic), without_copies(ordinary)
    learn = [toxic[::2], ordinary[::2]]
    check = [toxic[1::2] or toxic, ordinary[1::2] or ordinary]
    of_toxic, of_ordinary = ([_marked(d.split(b" ")) for d in docs if d] for docs in learn)
    parts = [x[k : k + 400] for x in of_ordinary for k in range(0, len(x), 400)]
    shared = trained(parts, SHARED_BYTES, 64) + HEAD
    del parts
    model = Model(pairs=[(trained(of_ordinary, OWN_BYTES, k) + shared, trained(of_toxic, OWN_BYTES, k) + shared) for k in SEGMENTS])
    del of_toxic, of_ordinary
    model.start()
    seen = [np.stack([model.distances([w for w in d.split(b" ") if w]) for d in docs]) for docs in check]
    c1, c0 = (s.sum(axis=0) for s in seen)
    q = max(c0.sum(), 1) / max(c1.sum(), 1)
    c1, c0 = rising(c1, c0)
    ratio = np.log((c1 + 0.5) * q / (c0 + 0.5 * q + 0.5))
    use = (ratio > CLEAR) & (c1 >= SEEN)
    use[0] = False
    c1, c0 = (s.sum(axis=0) for s in seen)
    rest = math.log((c1[~use].sum() + 1) / max(c1.sum(), 1) * max(c0.sum(), 1) / (c0[~use].sum() + 1))
    model.weight = np.where(use, ratio, rest)
    x = np.concatenate([seen[0] @ model.weight, seen[1] @ model.weight])
    y = np.repeat([1.0, 0.0], [len(s) for s in seen])
    each = np.repeat([n_toxic / len(seen[0]), n_ordinary / len(seen[1])], [len(s) for s in seen])
    model.slope, model.offset = logistic(np.clip(x, -30, 30), y, each * len(y) / each.sum())
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic regression with a small ridge, by Newton steps."""
    z, b = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        slope = z.T @ (weight * (y - p)) - 1e-3 * b
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), slope)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(b[0]), 0.0), float(b[1])


def train(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES
) -> Model:
    taught = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).cast("int").alias("y")).where(learn)
    totals = {r["y"]: r["count"] for r in taught.groupBy("y").count().collect()}
    chosen = [taught.where(F.col("y") == y).orderBy(F.xxhash64(doc_id), doc_id).limit(sample) for y in (1, 0)]
    ids = chosen[0].unionByName(chosen[1])  # at most 2 * sample ids
    rows = docs.select(doc_id, F.coalesce(text, F.lit("")).alias("t")).join(F.broadcast(ids), doc_id).orderBy(F.xxhash64(doc_id), F.xxhash64("t"))
    found: dict[int, list[bytes]] = {1: [], 0: []}
    size = {1: 0, 0: 0}
    for y, t in rows.select("y", "t").toLocalIterator():  # a partition at a time
        doc = b" ".join(window_words(t))
        if size[y] + len(doc) <= sample_bytes:
            found[y].append(doc)
            size[y] += len(doc)
        elif min(size.values()) >= 0.95 * sample_bytes:
            break
    return fit(found[1], found[0], totals.get(1, 0), totals.get(0, 0))


_STARTED: dict[bytes, Model] = {}


def _started(model: Model) -> Model:
    """One model, with its word cache, for all tasks of a worker."""
    key = repr((model.slope, model.offset, model.constant)).encode() + b"".join(x for pair in model.pairs for x in pair) + model.weight.tobytes()
    if key not in _STARTED:
        _STARTED.clear()
        if model.constant is None:
            model.start()
        _STARTED[key] = model
    return _STARTED[key]


def scorer(spark, model: Model):
    """A Column function from a text to its probability."""
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = _started(shared.value)
        for texts in tidied(batches):
            yield pd.Series(m.score(texts), dtype=float)

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, "double")

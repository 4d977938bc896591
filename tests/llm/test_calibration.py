"""The fitted numbers of the two classifiers against plain versions of their equations."""

import random
import struct

import numpy as np
import xxhash

from millrace.llm import quality, toxicity
from millrace.llm.common import bucket_of


def isotonic_means(good, total):
    """Each bin's value as the largest, over where a run starts, of the least mean, over where it ends."""
    n = len(total)
    mean = lambda j, k: good[j : k + 1].sum() / total[j : k + 1].sum()
    return np.array([max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)])


def test_quality_scores_solve_the_equations(spark, prose):
    r = random.Random(4)
    docs, marks = [], {}
    for i in range(260):
        y = int(r.random() < 0.5)
        t = prose(i, r.choice([30, 90, 250]))
        if y and r.random() < 0.8:
            t = t.upper().replace(" ", " !! ") if i % 2 else " ".join([t.split(" ")[0]] * 60)
        docs.append((2**60 + i, t))
        if i % 5:
            marks[2**60 + i] = y
    df = spark.createDataFrame([*docs, (None, "no id"), (1, None)], "doc_id long, text string")
    labels = spark.createDataFrame(list(marks.items()), "doc_id long, y int")
    dims, width, ridge = 24, 4.0, 1e-2
    got = {x["doc_id"]: x["score"] for x in quality.classify(df, labels, "y", bucket_of("doc_id", 5) != 0, dims=dims, width=width, ridge=ridge, seed=3).collect()}

    buckets = {x["doc_id"]: x["b"] for x in df.select("doc_id", bucket_of("doc_id", 5).alias("b")).collect()}
    texts = dict(docs)
    taught = [i for i in marks if buckets[i] != 0]
    x, y = np.array([quality.statistics(texts[i]) for i in taught]), np.array([marks[i] for i in taught], float)
    signed = lambda i: (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(struct.pack("<q", i), 42))
    fold = np.array([signed(i) % quality.FOLDS for i in taught])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    rng = np.random.default_rng(3)
    waves, phase = rng.normal(size=(x.shape[1], dims)) / width, rng.uniform(0, 2 * np.pi, dims)

    def phi(a):
        z = np.clip((a - mean) / scale, -8, 8)
        return np.hstack([np.ones((len(z), 1)), z, np.sqrt(2 / dims) * np.cos(z @ waves + phase)])

    def ridge_fit(use, n):
        z = phi(x[use])
        return np.linalg.lstsq(z.T @ z + ridge * n / z.shape[1] * np.eye(z.shape[1]), z.T @ y[use], rcond=None)[0]

    n = len(y)
    raw = np.zeros(n)
    for f in range(quality.FOLDS):
        raw[fold == f] = phi(x[fold == f]) @ ridge_fit(fold != f, n * (quality.FOLDS - 1) / quality.FOLDS)
    at = np.clip((raw - quality.LOW) / (quality.HIGH - quality.LOW) * quality.BINS, 0, quality.BINS - 1).astype(int)
    bins = np.unique(at)
    total, good = (np.array([w[at == b].sum() for b in bins]) for w in (np.ones(n), y))
    level = isotonic_means(good, total)
    places, values = [], []
    for v in np.unique(np.round(level, 12)):
        own = np.flatnonzero(np.abs(level - v) < 1e-9)
        centre = quality.LOW + (bins[own] + 0.5) * (quality.HIGH - quality.LOW) / quality.BINS
        share = (good[own].sum() + 0.5) / (total[own].sum() + 1)
        for c in dict.fromkeys((centre[0], centre[-1])):
            places.append(c)
            values.append(share)
    whole = ridge_fit(np.ones(n, bool), n)
    for i, t in [*docs, (None, "no id"), (1, None)]:
        want = np.interp(phi(np.array([quality.statistics(t)])) @ whole, places, np.maximum.accumulate(values))[0]
        assert abs(got[i] - want) < 1e-6


def test_toxicity_weights_and_scores_by_their_rules(prose):
    r = random.Random(6)
    bad = ["blorgnat", "drumpfish", "blorgling", "scrawt"]

    def words(i, toxic):
        ws = toxicity.window_words(prose(i, r.choice([40, 90])))
        for _ in range(4 if toxic else 0):
            ws.insert(r.randrange(len(ws)), r.choice(bad).encode())
        return b" ".join(ws)

    toxic, ordinary = [words(i, True) for i in range(90)], [words(1000 + i, False) for i in range(150)]
    model = toxicity.fit(toxic, ordinary, 900, 30_000)
    model.start()
    seen = []
    for docs in (toxicity.without_copies(toxic)[1::2], toxicity.without_copies(ordinary)[1::2]):
        counts = np.zeros((len(docs), toxicity.DISTANCES))
        for row, d in zip(counts, docs):
            for w in d.split(b" "):
                row[model.distance(toxicity._marked([w]))] += 1
        seen.append(counts)
    c1, c0 = (s.sum(axis=0) for s in seen)
    q = c0.sum() / c1.sum()
    # Pools of distances: those without a window join the pool before them.
    some = np.flatnonzero(c1 + c0 > 0)
    level = isotonic_means(c1[some], (c1 + c0)[some])
    weight = np.zeros(toxicity.DISTANCES)
    rare = np.ones(toxicity.DISTANCES, bool)
    for v in np.unique(np.round(level, 12)):
        own = some[np.abs(level - v) < 1e-9]
        a, b = c1[own].sum(), c0[own].sum()
        ratio = np.log((a + 0.5) * q / (b + 0.5 * q + 0.5))
        if ratio > toxicity.CLEAR and a >= toxicity.SEEN:
            for k in own[own > 0]:
                weight[k], rare[k] = ratio, False
    rest = np.log((c1[rare].sum() + 1) / c1.sum() * c0.sum() / (c0[rare].sum() + 1))
    for k in some:
        assert abs(model.weight[k] - (rest if rare[k] else weight[k])) < 1e-9
    # The logistic regression is at the top of its likelihood, with its small ridge.
    x = np.clip(np.concatenate([s @ model.weight for s in seen]), -30, 30)
    y = np.repeat([1.0, 0.0], [len(s) for s in seen])
    each = np.repeat([900 / len(seen[0]), 30_000 / len(seen[1])], [len(s) for s in seen])
    each *= len(y) / each.sum()
    p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -30, 30)))
    slope = np.array([(each * (y - p) * x).sum() - 1e-3 * model.slope, (each * (y - p)).sum() - 1e-3 * model.offset])
    assert model.slope > 0 and np.abs(slope).max() < 1e-6
    text = "Blorgnat! ordinary words, scrawt"
    s = sum(model.weight[model.distance(toxicity._marked([w]))] for w in toxicity.window_words(text))
    assert abs(model.score([text])[0] - 1 / (1 + np.exp(-np.clip(model.slope * s + model.offset, -30, 30)))) < 1e-9

import hashlib
import math
import random

from millrace.llm import lloyd


def brute(rows, k, rounds, dims):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(q) for _, q in order[:k]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        at = [near(q)[1] for _, q in kept]
        for j in set(at):
            own = [q for (_, q), a in zip(kept, at) if a == j]
            centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    final = [near(q) for _, q in kept]
    far = {}
    for d, j in final:
        far[j] = far.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    top = (1 << 63) - 1
    return sorted(((i, j, min(d, top), min(far[j], top), min(sum(far.values()), top), sha[j]) for (i, _), (d, j) in zip(kept, final)), key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in lloyd.clusters(df, **kw).collect()), key=repr)


def vectors(seed, n, dims, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss((i % 5) - 2, spread) for _ in range(dims)]) for i in range(n)]


def frame(spark, rows, kind="double"):
    made = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster int, id string")
    return made.repartition(3)


def test_equals_brute_force(spark):
    rows = vectors(1, 300, 8)
    assert got(frame(spark, rows), k=7, rounds=5, dims=8) == brute(rows, 7, 5, 8)


def test_odd_rows(spark):
    rows = vectors(2, 60, 4)
    rows += [
        (900, None), (901, []), (902, [1.0] * 3), (903, [1.0] * 5), (904, [1.0, None, 2.0, 3.0]), (905, [1.0, float("nan"), 2.0, 3.0]), (906, [float("inf"), 0.0, 0.0, 0.0]),
        (None, [0.5, -0.5, 0.25, -0.001]), (2**60 + 1, [9.0, 9.0, 9.0, 9.0]), (2**60 + 3, [-9.0, 9.0, -9.0, 9.0]), (5, rows[5][1]), (5, [3.0, 3.0, 3.0, 3.0]), (5, [3.0, 3.0, 3.0, 3.0]),
        (-4, [-1e-9, 0.0, -0.0, 1 / 256]),
    ]
    assert got(frame(spark, rows), k=9, rounds=4, dims=4) == brute(rows, 9, 4, 4)


def test_large_components_are_exact(spark):
    rows = [(i, [x * 1e6, -x * 3e6 + 7.3]) for i, x in enumerate([1.0, 2.0, 2.5, -4.0, 0.0, 8.0])] + [(10, [4e9, 1.0]), (11, [-4e9, 2.0]), (12, [4.1e9, 1.5])]
    assert got(frame(spark, rows), k=3, rounds=3, dims=2) == brute(rows, 3, 3, 2)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [0.0, 0.0]) for i in range(6)] + [(7, [1.0, 0.0])]
    assert got(frame(spark, rows), k=4, rounds=2, dims=2) == brute(rows, 4, 2, 2)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(3, 3, 2)
    assert got(frame(spark, rows, "float"), k=40, rounds=5, dims=2) == brute([(i, [float(spark_float(x)) for x in v]) for i, v in rows], 40, 5, 2)
    assert got(frame(spark, rows).where("false")) == []
    assert got(frame(spark, [(1, None), (2, [1.0])])) == []


def spark_float(x):
    import numpy as np

    return np.float32(x)

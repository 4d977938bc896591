"""Centroid clustering by plain Lloyd rounds over integer vectors.

A vector counts if it has exactly the wanted number of components, none of them null
or non-finite; each component x becomes the integer floor(SCALE * x). The first
centroids are the kept vectors with the smallest SHA-256 of a salted id. A round
sends the centroids to the tasks (k vectors, whatever the size of the table), which
assign every vector to the nearest (squared Euclidean distance in integers, the lower
number where two are as near) and give back one row of sums for each centroid that
they used; these are added up by centroid, and the driver gets k rows. A non-empty
centroid moves to the floor of the exact mean, an empty one stays.

All arithmetic is exact. Vectors with a component of 2^27 or more, whose distances may
not fit 64 bits, are compared in unbounded integers; components are held within
+-2^62, and a distance or a sum of distances beyond 2^63 - 1 is given as that.

Defined results: ids are taken as text, a null id as ''; repeated rows are each a
vector, and can each be a first centroid (ties of the hash go by the components); with
fewer vectors than k there are as many centroids as vectors; an empty table, or one
without a kept vector, gives no rows; columns other than the id and the vector are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K, ROUNDS, DIMS, SCALE, SALT = 40, 5, 64, 256, 2
_EXACT = 1 << 27
_HELD, _LONG = (1 << 62), (1 << 63) - 1


def whole(vectors: pd.Series, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and the integers of those, a row each."""
    good = np.array([v is not None and len(v) == dims for v in vectors], bool)
    if not good.any():
        return good, np.zeros((0, dims), np.int64)
    x = np.stack([np.asarray(v, np.float64) for v in vectors[good]])  # a null component is not a number here
    finite = np.isfinite(x).all(axis=1)
    good[np.flatnonzero(good)[~finite]] = False
    scaled = np.floor(np.clip(x[finite] * float(scale), -float(_HELD), float(_HELD)))
    return good, scaled.astype(np.int64)


def nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of the nearest centroid, and the squared distance."""
    out = np.zeros((len(centroids), len(q)), np.int64)
    large = np.abs(q).max(axis=1, initial=0) >= _EXACT
    if np.abs(centroids).max(initial=0) >= _EXACT:
        large[:] = True
    for j, c in enumerate(centroids):
        apart = q - c
        out[j] = np.einsum("ij,ij->i", apart, apart)
    at = out.argmin(axis=0)
    best = out[at, np.arange(len(q))]
    for i in np.flatnonzero(large):
        exact = [sum((x - y) ** 2 for x, y in zip(q[i].tolist(), c.tolist())) for c in centroids]
        at[i] = min(range(len(exact)), key=exact.__getitem__)
        best[i] = min(exact[at[i]], _LONG)
    return at, best


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: int, salt: int) -> np.ndarray:
    """Components of the k kept vectors with the smallest hashes, in their order; a task gives k rows at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[tuple[str, list[int]]] = []
        for batch in batches:
            good, q = whole(batch["v"], dims, scale)
            named = (hashlib.sha256(f"{salt}:{i}".encode()).hexdigest() for i in batch["id"][good])
            best = heapq.nsmallest(k, [*best, *zip(named, q.tolist())])
        yield pd.DataFrame({"h": [h for h, _ in best], "q": [q for _, q in best]}, dtype=object)

    found = vectors.mapInPandas(run, "h string, q array<long>").orderBy("h", "q").limit(k).collect()
    return np.array([r["q"] for r in found], np.int64).reshape(-1, dims)


def _sums(vectors: DataFrame, centroids: np.ndarray, dims: int, scale: int) -> list[tuple[int, list[int], int, int]]:
    """cluster, component sums, count and summed distances of every centroid that any vector is nearest to."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(shared.value)
        total, count, far = [[0] * dims for _ in range(k)], [0] * k, [0] * k
        for batch in batches:
            _, q = whole(batch["v"], dims, scale)
            at, distance = nearest(q, shared.value)
            kind = object if np.abs(q).max(initial=0) >= _EXACT or distance.max(initial=0) >= 1 << 48 else np.int64
            for j in np.unique(at).tolist():
                own = at == j
                total[j] = [a + b for a, b in zip(total[j], q[own].astype(kind).sum(axis=0).tolist())]
                count[j] += int(own.sum())
                far[j] += int(distance[own].astype(kind).sum())
        used = [j for j in range(k) if count[j]]
        # As text: sums may be wider than 64 bits.
        yield pd.DataFrame({"cluster": pd.Series(used, dtype="int32"), "numbers": [[str(x) for x in (*total[j], count[j], far[j])] for j in used]})

    parts = vectors.mapInPandas(run, "cluster int, numbers array<string>")
    each = parts.select("cluster", F.posexplode("numbers").alias("i", "x")).groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    found: dict[int, list[int]] = {}
    for j, i, x in each.collect():  # k times dims + 2 numbers at most
        found.setdefault(j, [0] * (dims + 2))[i] = int(x)
    shared.unpersist()
    return [(j, r[:dims], r[dims], r[dims + 1]) for j, r in sorted(found.items())]


def clusters(
    df: DataFrame, vector: str | Column = "embedding", vec_id: str | Column = "vec_id", k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, salt: int = SALT
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = df.sparkSession
    named = vec_id if isinstance(vec_id, Column) else F.col(vec_id)
    # Ids go as text: pandas would turn those of a batch with nulls into floats.
    given = df.select(named.alias("id"), (vector if isinstance(vector, Column) else F.col(vector)).alias("v"))
    kind = given.schema["id"].dataType.simpleString()
    vectors = given.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.col("id").isNull().alias("none"), "v")
    centroids = first_centroids(vectors, k, dims, scale, salt)
    for _ in range(rounds if len(centroids) else 0):
        for j, total, n, _ in _sums(vectors, centroids, dims, scale):
            centroids[j] = [x // n for x in total]
    last = {j: far for j, _, _, far in _sums(vectors, centroids, dims, scale)} if len(centroids) else {}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = [(j, min(far, _LONG), min(sum(last.values()), _LONG), digests[j]) for j, far in sorted(last.items())]
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good, q = whole(batch["v"], dims, scale)
            at, distance = nearest(q, shared.value) if len(q) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            yield pd.DataFrame({"id": batch["id"][good].to_numpy(), "none": batch["none"][good].to_numpy(bool), "cluster": at.astype(np.int32), "distance": distance})

    assigned = vectors.mapInPandas(assign, "id string, none boolean, cluster int, distance long")
    final = spark.createDataFrame(told, "number int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = assigned.join(F.broadcast(final), F.col("cluster") == F.col("number"))
    own = F.when(~F.col("none"), F.col("id").cast(kind)).alias("vec_id")
    return joined.select(own, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def lloyd_sql(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, salt: int = SALT) -> str:
    """The same clusters as SQL over the table embeddings, a common table for each round."""
    near = (
        "SELECT id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT v.id, m.c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN {m} m USING (i) GROUP BY v.id, m.c) GROUP BY id"
    )
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(m=f'm{r}')})")
        steps.append(f"s{r} AS MATERIALIZED (SELECT a.c, v.i, sum(v.x) AS s, count(*) AS n FROM a{r} a JOIN v ON v.id = a.id GROUP BY a.c, v.i)")
        floor = "(s.s - ((s.s % s.n) + s.n) % s.n) // s.n"
        steps.append(f"m{r + 1} AS MATERIALIZED (SELECT m.c, m.i, CASE WHEN s.n IS NULL THEN m.x ELSE {floor} END AS x FROM m{r} m LEFT JOIN s{r} s ON s.c = m.c AND s.i = m.i)")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), v AS MATERIALIZED (SELECT id, i, floor({scale} * x::DOUBLE)::HUGEINT AS x FROM (SELECT id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM kept)
), first AS MATERIALIZED (
  SELECT id, row_number() OVER (ORDER BY sha256('{salt}:' || coalesce(vec_id::VARCHAR, '')), e) - 1 AS c FROM kept QUALIFY c < {k}
), m0 AS MATERIALIZED (SELECT c, i, x FROM first JOIN v USING (id)
), {', '.join(steps)}, a AS MATERIALIZED ({near.format(m=f'm{rounds}')}
), t AS (SELECT c, sum(d) AS far FROM a GROUP BY c
), h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM m{rounds} GROUP BY c)
SELECT vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance, far::BIGINT AS cluster_inertia, (SELECT sum(far) FROM t)::BIGINT AS inertia, centroid_sha256
FROM a JOIN kept USING (id) JOIN t ON t.c = a.c JOIN h ON h.c = a.c"""

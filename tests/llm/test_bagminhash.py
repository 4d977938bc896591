import random
from collections import Counter

import numpy as np

from millrace.llm import bagminhash as b
from millrace.llm.common import words
from millrace.llm.graph import components


def brute(docs, threshold=0.8):
    """Class of each row number by comparing all pairs of multisets."""
    bags = []
    for _, t in docs:
        ws = words(t)
        bags.append(Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else Counter([("short", *ws)]))
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            shared = sum((bags[i] & bags[j]).values())
            if shared >= threshold * (sum(bags[i].values()) + sum(bags[j].values()) - shared) - 1e-9 and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if x == old else x for x in root]
    return root


def edited(text, n, r):
    ws = text.split(" ")
    for _ in range(n):
        ws[r.randrange(len(ws))] = "zz" + str(r.randrange(10**6))
    return " ".join(ws)


def case(prose):
    r = random.Random(7)
    docs = [(i, prose(i, r.choice([3, 6, 20, 100, 250]))) for i in range(60)]
    for k in range(12):
        docs += [(100 + 20 * k + j, edited(docs[k][1], r.choice([0, 1, 2, 4]), r)) for j in range(8)]
    base = prose(999, 300)
    docs += [(1000 + j, edited(base, 4, r)) for j in range(60)]  # many near copies, most pairs just around the threshold
    docs += [(2000, "a b c d e " * 40), (2001, "a b c d e " * 39), (2002, "a b c d e " * 10), (2003, None), (2004, ""), (2005, "one"), (2006, "ONE!"), (2007, "two")]
    return docs


def test_signature_estimates_weighted_jaccard():
    r = np.random.default_rng(1)
    keys = np.sort(r.integers(0, 2**63, 60).astype("u8"))
    w1, w2 = r.integers(1, 9, 60), r.integers(1, 9, 60)
    want = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    got = b.signatures([(keys, w1), (keys, w2)], 4096)
    assert abs((got[0] == got[1]).mean() - want) < 0.03
    alone = b.signatures([(keys, w1)], 4096)
    assert (alone[0] == got[0]).all()


def test_classes_equal_brute_force(spark, prose):
    docs = case(prose)
    root = brute(docs)
    least = {}
    for (i, _), c in zip(docs, root):
        least[c] = min(i, least.get(c, i))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, node int, digest string")
    want = {i: least[c] for (i, _), c in zip(docs, root)}
    for block in (400_000, 4_000):  # one block, and many
        got = {r["doc_id"]: r["class_id"] for r in b.classes(df, block=block).collect()}
        assert got == want
    kept = {r["doc_id"] for r in b.keep_one(df).collect()}
    assert kept == set(least.values())


def test_odd_rows(odd_docs, no_docs):
    got = b.classes(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r["class_id"] for r in got}
    assert by[5] == by[1] == 1 and by[2] == by[3] == by[7] == 2 and by[9] == by[4] == 4 and by[None] is None
    kept = b.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 4, 8, 10]
    assert b.classes(no_docs).count() == 0 and b.keep_one(no_docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 120)] + [(7, 7), (300, 299), (299, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 120)}, 299: 299, 300: 299}


def test_rows_without_ids_and_columns_of_its_own_names(spark, prose):
    base = prose(5, 200)
    rows = [(None, base), (None, base + " end"), (None, prose(6, 50)), (None, base), (7, prose(8, 30)), (7, prose(9, 30))]
    df = spark.createDataFrame([(i, t, k, "x", "y", "z") for k, (i, t) in enumerate(rows)], "doc_id long, text string, h long, __0 string, __id string, __digest string")
    kept = b.keep_one(df)
    assert kept.columns == df.columns and sorted(r["text"] for r in kept.collect()) in (sorted([base, prose(6, 50), prose(8, 30), prose(9, 30)]), sorted([base + " end", prose(6, 50), prose(8, 30), prose(9, 30)]))


def test_recall_of_near_copies(spark, prose):
    """Pairs at 0.8 or more, just above it too: at least nine in ten share a bucket, and with that a class."""
    r = random.Random(3)
    pairs = []
    for k in range(300):
        a = prose(3_000 + k, 150)
        pairs.append((a, edited(a, r.choice([1, 2, 3]), r)))
    docs = [(2 * k + j, t) for k, p in enumerate(pairs) for j, t in enumerate(p)]
    got = {x["doc_id"]: x["class_id"] for x in b.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = total = 0
    for k, (x, y) in enumerate(pairs):
        root = brute([(0, x), (1, y)])
        if root[1] == 0:
            total += 1
            found += got[2 * k] == got[2 * k + 1]
        else:
            assert got[2 * k] != got[2 * k + 1]
    assert total > 100 and found >= 0.99 * total

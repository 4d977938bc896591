import hashlib
from collections import Counter

import numpy as np
import xxhash

from millrace.llm import fingerprint as f


def paragraphs(text, mean):
    """Paragraphs as they read, by the rule of the docstring."""
    out, now = Counter(), []
    for w in text.replace("\n", " \n ").split(" "):
        now.append(w)
        if w == "\n" or xxhash.xxh64_intdigest(w.encode()) % mean == 0:
            out[tuple(now)] += 1
            now = []
    if now:
        out[tuple(now)] += 1
    return out


def brute_likeness(a, b):
    x, y = paragraphs(a, f.MEAN_WORDS), paragraphs(b, f.MEAN_WORDS)
    return sum((x & y).values()) / max(sum((x | y).values()), 1)


def expected(docs):
    rows = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode(), 42) ^ 1 << 63, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        edit = t[: len(t) - cut] + nxt[:cut]
        out.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest(), round(brute_likeness(t, edit), 9), round(brute_likeness(t, nxt), 9)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark, prose):
    docs = [(i * 3 % 101, prose(i, 5 + i * 7)) for i in range(100)] + [(None, "null id"), (500, None), (501, ""), (502, prose(1, 9_000)), (502, "tie"), (7000, "x\n" * 300), (7001, "x\n" * 299)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, b int, k int")
    got = f.versions(df).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got), key=repr) == expected(docs)
    by_text = {}
    for r in got:
        by_text.setdefault(r["edited_sha256"], set()).add(r["edited_fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(4, "only one here")], "doc_id long, text string")
    assert f.versions(df).first()["near_next"] == 1.0
    assert f.versions(df.where("false")).count() == 0


def test_likeness_comes_from_the_strings_alone(spark, prose):
    df = spark.createDataFrame([(i, prose(i % 37, 20 + 40 * (i % 50))) for i in range(120)], "doc_id long, text string")
    rows = sorted(f.versions(df).collect(), key=lambda r: r["doc_id"])
    after = rows[1:] + rows[:1]
    assert np.allclose(f.likeness([(r["fingerprint"], r["edited_fingerprint"]) for r in rows]), [r["near_edited"] for r in rows])
    assert np.allclose(f.likeness([(r["fingerprint"], n["fingerprint"]) for r, n in zip(rows, after)]), [r["near_next"] for r in rows])
    assert np.mean([r["near_edited"] for r in rows]) > 0.4 > np.mean([r["near_next"] for r in rows])


def test_a_fingerprint_lists_its_digests(prose):
    digests = f.Digests()
    for text in ("", "one", prose(1, 60), prose(2, 20_000), "x\n" * 5_000):
        want = digests(text)
        got = f._listed(f.read(f.fingerprints([text], digests)[0]))
        assert len(got) == len(want) and all(sorted(a.tolist()) == sorted(b.tolist()) for a, b in zip(got, want))


def test_size_against_the_text(prose):
    text = prose(3, 50_000)
    assert len(f.fingerprints([text], f.Digests())[0]) < len(text) / 2


def test_sets_of_all_sizes():
    r = np.random.default_rng(3)
    x = np.unique(r.integers(0, 2**44, 4_000).astype("u8"))
    r.shuffle(x)
    keys = (x << f._CHECK_BITS) | f._check(x)
    pairs = [(keys[:n], keys[m : n + m]) for n, m in ((10, 0), (500, 3), (3000, 900), (1, 1), (1, 0), (2, 1500))]
    pairs += [(keys[:3], keys[:3000]), (keys[:3000], keys[2990:2995])]
    want = [len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist())) for a, b in pairs]
    assert np.allclose(f.likeness([(f.written([s]), f.written([t])) for s, t in zip(f.sketched([a for a, _ in pairs]), f.sketched([b for _, b in pairs]))]), want)


def test_one_id_for_a_third_of_the_rows(spark, prose):
    docs = [(7 if i % 3 == 0 else i, prose(i, 12)) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = f.versions(df).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got), key=repr) == expected(docs)
    assert f.in_order(df).where("id = 7").select("b").distinct().count() > 1


def test_odd_rows(odd_docs):
    assert f.versions(odd_docs).count() == odd_docs.count()

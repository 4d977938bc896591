import hashlib
import random
import zlib

import pytest

from millrace.llm import prefix_trie


def brute(rows):
    told = {}
    for c, turn, role, text in rows:
        if c is not None:
            told.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in told.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = turns.get(c - int(c - c // 100 * 100 if c >= 0 else -(-c % 100)), [])[:h] + own[h:]
    members = {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for key, cs in members.items():
        sub = [k for k in members if k[: len(key)] == key]
        children = [k for k in sub if len(k) == len(key) + 1]
        leaves = [k for k in sub if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in sub)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1]) for k in sub if k)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(made[c]) == len(key)))
        parent = min(members[key[:-1]]) if key else None
        out.append((min(cs), len(key), parent, len(cs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    made = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, k1 string")
    return made.repartition(4)


def got(df):
    return sorted((tuple(r) for r in prefix_trie.nodes(df).collect()), key=repr)


def talks(seed, n, most):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(420), n):
        for k in range(r.choice([1, 2, most, r.randint(1, most)])):
            rows.append((c, k, r.choice(["user", "assistant"]), r.choice(["é日", "b", "", "long answer"]) if k % 2 else r.choice("ab")))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = talks(seed, 90, 7)
    assert got(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = talks(3, 25, 4)
    rows += [
        (None, 1, "user", "nobody"), (None, None, None, None), (2**60 + 1, 1, "user", "a"), (2**60 + 3, 1, "user", "a"), (2**60 + 3, 2, None, None), (-7, 0, "user", "a"), (-150, 0, "user", "a"),
        (500, None, "user", "late"), (500, 0, "user", "b"), (500, 0, "user", "a"), (500, 0, "user", "a"), (500, 0, "assistant", "a"), (501, 3, "user", "x" * 50_000), (700, None, None, None),
    ]
    assert got(frame(spark, rows)) == brute(rows)


def test_a_long_conversation_and_copies_of_one(spark):
    rows = [(0, k, "user", f"t{k}") for k in range(400)] + [(c, k, "user", f"t{k}") for c in range(1, 30) for k in range(6 + c % 3)]
    assert got(frame(spark, rows)) == brute(rows)


def test_turnless_and_empty(spark):
    alone = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0][:3]
    rows = [(c, 0, "user", "gone") for c in alone]
    assert got(frame(spark, rows)) == brute(rows) and len(brute(rows)) == 1
    assert got(frame(spark, rows).where("false")) == []


def test_digests_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 3)
    rows = [(c * 7919 % 10_000, k, "user", "same") for c in range(150) for k in range(1 + c % 2)]
    assert got(frame(spark, rows)) == brute(rows)

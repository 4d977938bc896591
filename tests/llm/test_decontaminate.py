import hashlib
import re

from millrace.llm import decontaminate

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode())
    return WORD.findall(low)


def brute(docs, items):
    wins = {}
    for name, t in items:
        ws = words(t)
        n = min(13, len(ws))
        for p in range(len(ws) - n + 1) if n else ():
            wins.setdefault(tuple(ws[p : p + n]), set()).add("" if name is None else str(name))
    out = []
    for i, t in docs:
        ws, hit, names = words(t), set(), set()
        for w, who in wins.items():
            for p in range(len(ws) - len(w) + 1):
                if tuple(ws[p : p + len(w)]) == w:
                    hit |= set(range(p, p + len(w)))
                    names |= who
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(ws), len(hit), len(names), sha, bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=repr)


def case(spark, prose):
    items = [(1, prose(100, 30)), (2, prose(101, 14)), (3, "Short one here"), (4, None), (5, ""), (None, "Nameless but Real words"), (1, prose(100, 30)), (7, prose(102, 13))]
    a = prose(100, 30).split(" ")
    docs = [
        (1, prose(1, 40) + " " + " ".join(a[:15]).upper() + " " + prose(2, 20)), (2, prose(3, 60)), (3, None), (4, ""), (5, "a SHORT, one-here; b"), (6, " ".join(a[:12])),
        (7, prose(101, 14) + "|" + prose(102, 13)), (8, prose(5, 3000) + " " + prose(102, 13)), (None, prose(101, 14)), (2, prose(3, 60)), (9, "nameless  but real words " * 3),
    ]
    return items, docs


def test_equals_brute_force_in_one_block_and_in_many(spark, prose):
    items, docs = case(spark, prose)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_hit int")
    for size in (10_000, 20):
        got = sorted((tuple(r) for r in decontaminate.scan(df, bench, block_windows=size).collect()), key=repr)
        assert got == brute(docs, items)


def test_spans_are_removed(spark, prose):
    items, docs = case(spark, prose)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    cleaned = decontaminate.scan(df, bench, action="spans").collect()
    again = brute([(r["doc_id"], r["clean"]) for r in cleaned], items)
    assert not any(r[5] for r in again)
    kept = {r["doc_id"]: r["clean"] for r in cleaned if not r["contaminated"]}
    assert kept[2] == prose(3, 60) and kept[3] is None


def test_empty_tables(spark, prose):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.scan(docs.where("false"), bench).count() == 0
    assert decontaminate.scan(docs, bench.where("false")).first()["n_items"] == 0


def test_a_long_item_over_many_blocks_and_columns_named_like_results(spark, prose):
    items = [(1, prose(100, 400)), (2, prose(101, 14))]
    a = prose(100, 400).split(" ")
    docs = [(i, prose(i, 30) + " " + " ".join(a[i * 17 : i * 17 + 12 + i % 4])) for i in range(20)] + [(50, " ".join(a)), (51, None), (50, " ".join(a))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(i, t, "x", "y", 5) for i, t in docs], "doc_id long, text string, d string, k1 string, t int")
    for size in (10_000, 25):
        got = sorted((tuple(r)[:1] + tuple(r)[4:] for r in decontaminate.scan(df, bench, keep=("doc_id", "k1", "d", "t"), block_windows=size).collect()), key=repr)
        assert got == brute(docs, items)

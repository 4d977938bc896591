import random
import re

from millrace.llm import line_dedup


def brute(docs):
    """Places of removed lines by id, by comparing each line with all before it."""
    lines = []
    for i, t in docs:
        for k, s in enumerate((t or "").split("\n")):
            if tokens := frozenset(x for x in re.split(r"[ \t\r\v\f]+", s.lower()) if x):
                lines.append(((i is not None, i or 0, k), i, k, tokens))
    gone = {}
    for at, i, k, a in lines:
        if any(p < at and 5 * len(a & b) >= 4 * len(a | b) for p, _, _, b in lines):
            gone.setdefault(i, set()).add(k)
    return {i: sorted(ks) for i, ks in gone.items()}


def case(prose):
    r = random.Random(3)
    pool = [prose(500 + i, r.choice([1, 2, 5, 9, 30, 70])).replace("\n", " ") for i in range(50)]

    def line():
        ws = r.choice(pool).split(" ")
        for _ in range(r.choice([0, 0, 1, 2])):
            ws[r.randrange(len(ws))] = f"w{r.randrange(30)}"
        return " ".join(ws)

    docs = [(i, "\n".join(line() for _ in range(r.randrange(1, 9)))) for i in range(70)]
    return docs + [(100, None), (101, ""), (102, "\n \n\t\n"), (103, "...\n..."), (None, pool[0] + "\n" + pool[1]), (104, "The the THE\nthe"), (105, pool[2].upper()), (-5, pool[3])]


def test_equals_brute_force(spark, prose):
    docs = case(prose)
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, line int, keys string")
    want = brute(docs)
    for cells in (1 << 18, 16):
        got = {r["id"]: r["removed"] for r in line_dedup.removals(df, cells=cells).collect()}
        assert got == want
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup(df).collect()}
    for i, t in docs:
        assert kept[i] == (t if i not in want else "\n".join(s for k, s in enumerate(t.split("\n")) if k not in want[i]))


def test_a_full_bit_map_loses_nothing(spark, prose, monkeypatch):
    docs = case(prose)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for bits in (1, 61, 500):
        monkeypatch.setattr(line_dedup, "BITS", bits)
        assert {r["id"]: r["removed"] for r in line_dedup.removals(df).collect()} == brute(docs)


def test_groups_of_near_copies_and_long_lines(spark, prose):
    r = random.Random(8)
    base = [prose(900 + k, n).replace("\n", " ").split(" ") for k, n in enumerate((20, 60, 130, 260))]
    docs = []
    for i in range(160):
        ws = list(r.choice(base))
        for _ in range(r.randrange(1 + len(ws) // 8)):
            ws[r.randrange(len(ws))] = f"w{r.randrange(400)}"
        docs.append((i, " ".join(ws)))
    docs += [(1_000 + i, " ".join(f"c{r.randrange(150)}" for _ in range(200))) for i in range(60)]  # long lines of few words: many candidates
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert 40 < len(want) < 200
    assert {r["id"]: r["removed"] for r in line_dedup.removals(df).collect()} == want


def test_a_large_group_makes_few_candidates(spark, prose, monkeypatch):
    """Most members of a group of near copies find an earlier one among a few, though two members in a row are often unlike."""
    r = random.Random(5)
    base = prose(77, 70).replace("\n", " ").split(" ")
    docs = []
    for i in range(400):
        ws = list(base)
        for k in r.sample(range(len(ws)), 4):
            ws[k] = f"w{r.randrange(9_000)}"
        docs.append((i, " ".join(ws)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    made, candidates = [], line_dedup._candidates

    def counted(*args):
        found = candidates(*args)
        made.append(found.count())
        return found

    monkeypatch.setattr(line_dedup, "_candidates", counted)
    want = brute(docs)
    assert 300 < len(want) < 400
    assert {r["id"]: r["removed"] for r in line_dedup.removals(df).collect()} == want
    assert sum(made) < 30 * len(docs)


def test_what_is_on_disk_while_candidates_are_joined(spark, prose, monkeypatch):
    """Of the stored tables only that of the classes holds prefixes, and a post is no wider than the join needs."""
    df = spark.createDataFrame([(i, prose(20 + i % 7, 9)) for i in range(12)], "doc_id long, text string")
    held, joined, store, candidates = [], [], line_dedup.stored, line_dedup._candidates

    def noted(made, *spent):
        table = store(made, *spent)
        held[:] = [t for t in held if not any(t is x for x in spent)] + [table]
        return table

    def met(later, every, threshold):
        joined.append((later.columns, [t.columns for t in held if "prefix" in t.columns and "code" not in t.columns]))
        return candidates(later, every, threshold)

    monkeypatch.setattr(line_dedup, "stored", noted)
    monkeypatch.setattr(line_dedup, "_candidates", met)
    line_dedup.removals(df)
    posts, wide = joined[0]
    assert len(wide) == 1 and "sid" in wide[0]
    assert set(posts) == {"sid", "m", "m2", "n", "code", "k"}


def test_odd_rows(odd_docs, no_docs):
    kept = line_dedup.dedup(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert line_dedup.dedup(no_docs).count() == 0


def test_plan_is_native(odd_docs):
    plan = line_dedup.dedup(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

import random

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import quality, toxicity
from millrace.llm.common import bucket_of


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def labelled(spark, prose, spoil, n=240):
    r = random.Random(11)
    rows, marks = [], []
    for i in range(n):
        y = int(r.random() < 0.4)
        t = prose(i, r.choice([30, 80, 200]))
        rows.append((i, spoil(t, r) if y else t, "x"))
        marks.append((i, y))
    docs = spark.createDataFrame(rows + [(None, "null id", "x"), (9999, None, "x"), (9998, "", "x")], "doc_id long, text string, score string")
    return docs, spark.createDataFrame(marks + [(None, 1), (777777, 1), (3, None)], "doc_id long, y int"), dict(marks)


def insult(t, r):
    ws = t.split(" ")
    for _ in range(max(2, len(ws) // 25)):
        ws.insert(r.randrange(len(ws)), r.choice(["blorgnat", "drumpfish", "blorgling", "scrawt"]) + r.choice(["", "s", "er"]))
    return " ".join(ws)


def test_toxicity_on_held_out_documents(spark, prose):
    docs, labels, truth = labelled(spark, prose, insult)
    held = bucket_of("doc_id", 3) == 1
    model = toxicity.train(docs, labels, "y", ~held)
    size = toxicity.OWN_BYTES + toxicity.SHARED_BYTES + len(toxicity.HEAD)
    assert len(model.pairs) == len(toxicity.SEGMENTS) and all(len(o) == len(t) == size and o != t for o, t in model.pairs)
    got = docs.select("doc_id", held.alias("held"), toxicity.scorer(spark, model)("text").alias("s")).collect()
    assert len(got) == docs.count() and all(0 <= r["s"] <= 1 for r in got)
    pairs = [(r["s"], truth[r["doc_id"]]) for r in got if r["held"] and r["doc_id"] in truth]
    assert auc(pairs) > 0.95
    assert len({r["s"] for r in got if r["doc_id"] in (9998, 9999)}) == 1


def test_only_near_copies_count_once():
    r = random.Random(5)
    common, words = [b"c%d" % i for i in range(30)], [b"w%d" % i for i in range(4_000)]
    docs = [b" ".join(common[: r.randrange(10, 31)] + r.sample(words, 90)) for _ in range(600)]
    copies = [b" ".join([*d.split(b" ")[:-4], b"x%d" % i]) for i, d in enumerate(docs[:50])]
    assert toxicity.without_copies(docs + copies + docs[50:60]) == docs
    assert toxicity.without_copies([b"", b"a", b""]) == [b"", b"a"]


def test_distance_is_that_of_the_dictionaries(prose):
    """Against zstandard used plainly: every window of a text compressed with each dictionary of each pair."""
    import zstandard as zs

    toxic = [b" ".join(toxicity.window_words(insult(prose(i, 120), random.Random(i)))) for i in range(80)]
    ordinary = [b" ".join(toxicity.window_words(prose(1000 + i, 120))) for i in range(160)]
    model = toxicity.fit(toxic, ordinary, 80, 160)
    model.start()
    text = insult(prose(77, 200), random.Random(4))
    ws = toxicity.window_words(text)

    def size(content, x):
        d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        p = zs.ZstdCompressionParameters(
            format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0, window_log=17, hash_log=16, chain_log=16, search_log=8, min_match=3, target_length=64, strategy=zs.STRATEGY_BTOPT
        )
        return len(zs.ZstdCompressor(dict_data=d, compression_params=p).compress(x))

    want = np.zeros(toxicity.DISTANCES)
    for k in range(0, len(ws), toxicity.WINDOW_WORDS):
        x = toxicity.HEAD + b"".join(toxicity.MARK + w + b" " for w in ws[k : k + toxicity.WINDOW_WORDS]) + toxicity.TAIL
        sums = np.cumsum([size(o, x) - size(t, x) for o, t in model.pairs])
        want[min(max(sums[-1], 0), toxicity.DISTANCES - 1) if sums[0] > 0 else 0] += 1
    assert (model.distances(ws) == want).all()
    p = 1 / (1 + np.exp(-np.clip(model.slope * (want @ model.weight) + model.offset, -30, 30)))
    assert np.isclose(model.score([text])[0], p)


def test_repeats_long_texts_and_clashing_names(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 1), (9, 0)], "doc_id long, y int")
    model = toxicity.train(odd_docs, labels, "y", F.lit(True), sample_bytes=10_000_000)
    got = odd_docs.withColumn("s", toxicity.scorer(spark, model)("text")).collect()
    assert len(got) == odd_docs.count() and len({r["s"] for r in got if r["doc_id"] == 5}) == 1 and all(0 <= r["s"] <= 1 for r in got)
    assert len({r["s"] for r in got if not (r["text"] or "").strip()}) == 1
    assert toxicity.train(odd_docs, labels, "y", F.lit(True), sample_bytes=0).constant == 0.5


def test_toxicity_without_labels(spark, prose):
    docs, labels, _ = labelled(spark, prose, insult, 6)
    for some, want in ((labels.where("false"), 0.0), (labels.where("y = 1"), 1.0)):
        model = toxicity.train(docs, some, "y", F.lit(True))
        assert {r[0] for r in docs.select(toxicity.scorer(spark, model)("text")).collect()} == {want}
    model = toxicity.train(docs.where("false"), labels, "y", F.lit(True))
    assert docs.where("false").select(toxicity.scorer(spark, model)("text")).count() == 0


def junk(t, r):
    ws = t.split(" ")
    return r.choice([lambda: " ".join(w.upper() + "!!" for w in ws), lambda: " ".join(w for w in ws[:12] for _ in range(10)), lambda: " | ".join(ws), lambda: " ".join(w + "$%" for w in ws)])()


def test_quality_on_held_out_documents(spark, prose):
    docs, labels, truth = labelled(spark, prose, junk)
    held = bucket_of("doc_id", 5) == 0
    got = quality.classify(docs, labels, "y", ~held).withColumn("held", held).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert auc([(r["score"], truth[r["doc_id"]]) for r in got if r["held"] and r["doc_id"] in truth]) > 0.95


def test_quality_without_labels(spark, prose):
    docs, labels, _ = labelled(spark, prose, junk, 6)
    assert {r["score"] for r in quality.classify(docs, labels.where("false"), "y", F.lit(True)).collect()} == {0.5}
    assert {r["score"] for r in quality.classify(docs, labels.where("y = 1"), "y", F.lit(True)).collect()} == {1.0}
    assert quality.classify(docs.where("false"), labels, "y", F.lit(True)).count() == 0


def test_isotonic():
    total, good = np.zeros(quality.BINS), np.zeros(quality.BINS)
    for k, (n, g) in enumerate([(10, 1), (10, 4), (10, 2), (10, 9), (10, 8), (10, 10)]):
        total[k * 100], good[k * 100] = n, g
    at, value = quality.isotonic(total, good)
    assert (np.diff(value) >= 0).all() and (np.diff(at) > 0).all() and len(set(value)) == 4


def test_statistics_depend_on_text_alone(odd_docs):
    assert len(quality.statistics("a b")) == len(quality.statistics(None)) == quality.N_STATS
    assert quality.statistics(None) == quality.statistics("")
    assert np.isfinite([quality.statistics(r["text"]) for r in odd_docs.collect()]).all()

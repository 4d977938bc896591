"""Ids and other integers above 2^53 beside nulls, and ids that rows share, come out of every operator as they went in."""

import pytest

import corpus_pipeline
from millrace.llm import bagminhash, bpe, decontaminate, fingerprint, line_dedup, quality, suffix_tree, toxicity
from millrace.llm.common import bucket_of

A, B, C = 2**60 + 1, 2**60 + 3, 2**60 + 5


@pytest.fixture(scope="module")
def wide(spark, prose):
    rows = [(A, prose(1, 60), A, None), (None, prose(2, 60), None, [A, None, B]), (B, prose(3, 60), C, [B]), (C, None, B, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, wide long, more array<long>").coalesce(1)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(A, 1, 0), (B, 0, 1), (C, 1, 0)], "doc_id long, quality int, toxic int")


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.collect()), key=repr)


WANT = sorted([A, B, C, None], key=repr)


def test_every_operator_keeps_ids(spark, wide, labels, prose):
    learn = bucket_of("doc_id", 5) != 99
    assert sorted((r["doc_id"], r["class_id"]) for r in bagminhash.classes(wide).collect() if r["doc_id"]) == [(A, A), (B, B), (C, C)]
    assert ids(bagminhash.keep_one(wide)) == WANT
    assert ids(suffix_tree.score(wide, learn)) == WANT
    assert ids(quality.classify(wide, labels, "quality", learn)) == WANT
    assert ids(fingerprint.versions(wide)) == WANT
    bench = spark.createDataFrame([(1, prose(2, 60)), (2, prose(9, 20))], "item_id long, text string")
    for size in (10_000, 30):
        got = decontaminate.scan(wide, bench, keep=("doc_id", "wide", "more"), block_windows=size)
        assert sorted((tuple(r)[:3] for r in got.collect()), key=repr) == sorted((tuple(r) for r in wide.select("doc_id", "wide", "more").collect()), key=repr)
        assert [r["doc_id"] for r in got.where("contaminated").collect()] == [None]


def test_stages_keep_every_column(spark, wide, labels, prose, tmp_path):
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(9, 20))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = wide.selectExpr("*", "'en' AS lang", "'s' AS source", "length(text)::long AS n_chars")
    want = sorted((tuple(r) for r in docs.collect()), key=repr)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, folder)
        kept = sorted((tuple(r) for r in out.select("doc_id", "text", "wide", "more").collect()), key=repr)
        assert kept == [w[:4] for w in want], name
    assert ids(corpus_pipeline.STAGES[-1][1](spark, docs, folder)) == WANT


def test_lines_of_rows_that_share_an_id(spark):
    rows = [
        (5, "alpha beta gamma delta"), (7, "first\nalpha beta gamma delta"), (7, "second\nquite unique words stand here"), (7, "second\nquite unique words stand here"),
        (None, "third\nalpha beta gamma delta"), (None, "fourth\nanother line that is nowhere else"), (A, "fifth\nalpha beta gamma delta"), (B, "sixth\nthese words are only here too"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((r["doc_id"], r["text"]) for r in line_dedup.dedup(df).collect()), key=repr)
    # The line without an id comes first; of rows equal in id and text both keep their lines.
    assert got == sorted([(5, ""), (7, "first"), rows[2], rows[3], rows[4], rows[5], (A, "fifth"), rows[7]], key=repr)


def test_texts_of_an_id_that_rows_share(spark, prose):
    """Repeated ids with different texts: each row is classified and fingerprinted for itself."""
    rows = [(7, prose(1, 50)), (7, prose(2, 50)), (7, prose(1, 50)), (None, prose(3, 50)), (None, prose(4, 50))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(bagminhash.keep_one(df).collect()) == 4
    made = fingerprint.versions(df).collect()
    assert len(made) == 5 and len({r["fingerprint"] for r in made}) == 4

"""Each stage of the pipeline against a brute-force version on small tables, and the whole run."""

import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

pytest.importorskip("corpus_pipeline")

import corpus_pipeline  # noqa: E402
from tests.llm.test_bagminhash import brute as classes  # noqa: E402
from tests.llm.test_bagminhash import case as near  # noqa: E402
from tests.llm.test_decontaminate import brute as contaminated  # noqa: E402
from tests.llm.test_line_dedup import brute as removed  # noqa: E402

from millrace.llm import toxicity  # noqa: E402
from millrace.llm.common import bucket_of  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark, prose, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    items = [(1, prose(900, 40)), (2, prose(901, 6))]
    texts = [(i, t) for i, t in near(prose) if i < 260 or i > 1990]
    texts += [(3000, prose(1, 30) + " " + items[0][1]), (3001, items[1][1]), (3002, prose(3, 600) + " " + items[1][1]), (3003, "vile blorgnat " * 9 + prose(4, 30)), (3003, "vile blorgnat " * 9 + prose(4, 30)), (None, prose(5, 20))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long, digest string")
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i, _ in texts if i is not None and i < 250], "doc_id long, quality int, toxic int")
    docs.write.parquet(str(folder / "documents.parquet"))
    labels.write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), items


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = {q.split("_")[0] for q in entry.queries()}
    assert {f"op{n}" for n in range(1, 14)} <= names and "pipeline" in names


def rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_stages_equal_brute_force(spark, tables):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tox, lines, copies, bench, last = [f for _, f in corpus_pipeline.STAGES]

    clean = tox(spark, docs, folder)
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), "toxic", bucket_of("doc_id", 3) != 1)
    if model.constant is None:
        model.start()
    assert clean.columns == docs.columns
    assert rows(clean) == sorted(((r["doc_id"], r["text"]) for r, s in zip(docs.collect(), model.score([r["text"] for r in docs.collect()])) if s < corpus_pipeline.TOXIC), key=repr)

    short = lines(spark, docs, folder)
    gone = removed(rows(docs))
    want = [(i, t if i not in gone else "\n".join(s for k, s in enumerate(t.split("\n")) if k not in gone[i])) for i, t in rows(docs)]
    assert rows(short) == sorted(want, key=repr) and short.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"] or "") for r in short.collect())

    single = copies(spark, docs, folder)
    given = sorted(rows(docs), key=lambda r: (r[0] is None, r[0] or 0))
    root = classes(given)
    assert rows(single) == sorted((given[k] for k in range(len(given)) if root[k] == k), key=repr) and single.columns == docs.columns

    kept = bench(spark, docs, folder)
    bad = {r[0] for r in contaminated(rows(docs), items) if r[5]}
    assert {3000, 3001} <= bad and 3002 not in bad
    assert rows(kept) == [r for r in rows(docs) if r[0] not in bad] and kept.columns == docs.columns

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in last(spark, docs, folder).collect()), key=repr)
    assert got == sorted(((i, codec.encode_ordinary(t or "")) for i, t in rows(docs)), key=repr)


def test_run(spark, tables):
    out = corpus_pipeline.run(spark, tables[0]).collect()
    ids = [r["doc_id"] for r in out]
    assert len(ids) == len(set(ids)) and 3000 not in ids and 3001 not in ids


def test_stages_on_odd_tables(spark, tables, odd_docs, no_docs):
    """Nulls, repeats, clashing columns, an empty table, null texts throughout: defined rows, all columns kept."""
    folder, _ = tables
    clash = odd_docs.withColumnRenamed("id", "__id").withColumnRenamed("row", "__0").withColumnRenamed("k0", "c1").withColumnRenamed("words", "__text").withColumn("__score", F.lit(1)).withColumn("contaminated", F.lit("x")).withColumn("n_hit", F.lit(2))
    nulls = clash.withColumn("text", F.lit(None).cast("string"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clash, folder)
        assert out.columns == clash.columns and 6 <= out.count() <= clash.count()
        bare = stage(spark, nulls, folder)
        assert bare.columns == clash.columns and {r["text"] for r in bare.collect()} == {None}
        empty = stage(spark, clash.where("false"), folder)
        assert empty.columns == clash.columns and empty.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, nulls, folder).where("n_tokens > 0").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, folder).count() == 0

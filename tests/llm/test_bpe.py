import base64
import random

import numpy as np
import public_tokenizers as P
import tiktoken

from millrace.llm import bpe

VOCAB = P.path("byte_bpe_50k.tiktoken")


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCAB, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(df, **kw):
    want = reference()
    rows = bpe.decode(bpe.encode(df, VOCAB, P.PATTERN, keep=("doc_id", "text"), **kw), VOCAB, P.PATTERN).collect()
    for r in rows:
        text = r["text"] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == want.encode_ordinary(text)
        assert bytes(r["bytes"]) == text.encode()
    return rows


def test_odd_rows(odd_docs, no_docs):
    assert len(check(odd_docs)) == odd_docs.count()
    assert check(no_docs) == []


def test_chunks_are_stitched(spark):
    r = random.Random(5)
    alphabet = ["a", "b", " ", "  ", "\n", "\n \n", "'s", "'re", "'l", "l", "1", "22", "!", "é", "日", "\u00a0", "\t", "don't", " ?"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(1, 900))) for _ in range(120)]
    texts += ["x" * 500, " " * 500, "x" * 70 + " " * 300 + "y", "1" * 90 + "ab " * 60, "\n" * 200 + "z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(check(df, chunk=64, overlap=24)) == len(texts)


def test_long_texts_beside_null_and_large_ids(spark, prose):
    df = spark.createDataFrame([(2**60 + 1, prose(1, 400)), (None, prose(2, 400)), (2**60 + 3, prose(3, 400))], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in check(df, chunk=256, overlap=64)} == {2**60 + 1, None, 2**60 + 3}

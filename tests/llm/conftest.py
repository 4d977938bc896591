import random

import pytest

SYLLABLES = "ka lo mi ner tu sha vel dor in pha qui ré ös".split()


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n): n invented words, some capitalised, with stops and line ends."""

    def make(seed, n):
        r = random.Random(seed)
        out = []
        for k in range(n):
            w = "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3)))
            out.append((w.capitalize() if r.random() < 0.1 else w) + (r.choice([".", ",", ".\n"]) if r.random() < 0.12 else ""))
        return " ".join(out)

    return make


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Documents with nulls, empty and long texts, repeated rows and extra columns whose names operators use inside."""
    long = prose(1, 9_000)
    texts = [(1, prose(2, 80)), (2, None), (3, ""), (4, long), (5, prose(2, 80)), (5, prose(2, 80)), (None, prose(3, 40)), (7, "   \n\n\t "), (8, "ok"), (9, long + " tail"), (10, "é" * 300 + " 日本語 \u00a0 x")]
    rows = [(i, t, "en", "s", None if t is None else len(t), "x", 1, 2, "y", 0.5) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, row int, k0 int, words string, score double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("doc_id = -1")

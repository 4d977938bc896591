import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import chat

NASTY = st.lists(st.sampled_from(["\\", "###", "### ", ":\n", "</turn>", "</turn>\n", "<", "\n", "a", "é", " ", "\\\\"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(NASTY, NASTY), max_size=4))
def test_round_trip(turns):
    text = "".join(chat.render(r, t)[0] for r, t in turns)
    assert [(r, t) for r, t, _, _ in chat.parse(text)] == turns


def test_broken_text_is_refused():
    for bad in ("x", "### user", "### user:\nhi", "### user:\nhi</turn>"):
        try:
            list(chat.parse(bad))
        except chat.NotAConversation:
            continue
        raise AssertionError(bad)


def expected(rows):
    turns = [(r or "", t or "") for _, r, t in rows]
    told = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(told), hashlib.sha256(told.encode()).hexdigest()


def test_tables(spark):
    hard = "\\### Assistant: </turn> ok"
    convs = {
        -7: [(0, "user", hard), (1, "assistant", hard)],
        1: [(0, "system", None), (1, "user", ""), (2, "assistant", "### x:\n</turn>\n"), (2, "assistant", "### x:\n</turn>\n")],
        None: [(None, None, "who"), (0, "assistant", "é日")],
        3: [(i, "assistant" if i % 2 else "user", f"t{i}\\") for i in range(60)],
    }
    rows = [(c, n, r, t, 1) for c, ts in convs.items() for n, r, t in ts]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int")
    for size in (1 << 20, 50):
        pieces = chat.format_conversations(df, piece_chars=size)
        got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(pieces).collect()}
        assert got == {c: expected(ts) for c, ts in convs.items()}
        assert size > 50 or pieces.count() > len(convs)
    assert chat.read_back(chat.format_conversations(df.where("false"))).count() == 0

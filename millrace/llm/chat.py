r"""Chat formatting with a grammar round trip.

A conversation is turns, each ``### <role>:\n<text></turn>\n``. A backslash makes
the character after it literal. Every turn is rendered, read back by the
deterministic parser and compared with its source; while they differ, more of the
content is escaped: nothing, then backslashes and control strings, then every
character that is neither letter nor digit. A rendered turn always ends where its
parse ends, so turns that round-trip alone also do so one after another.

Rows are dealt by conversation, sorted and streamed, and a conversation longer
than ``piece_chars`` comes out in several pieces, so no conversation has to fit in
memory. Loss spans mark the assistant bodies in code points of a piece.

Defined results: null role or text counts as ''; turns are ordered by turn (nulls
first), ties by role and text, so repeated rows stay repeated turns; rows of a
null conversation id form one conversation; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ":\n", "</turn>\n"
PIECE_CHARS = 1 << 20
#: What to escape, weaker first; a pattern that matches nothing leaves the content as it is.
LEVELS = tuple(map(re.compile, (r"(?!)", r"\\|###|:\n|</turn>", r"[^0-9A-Za-z]")))
_ESCAPED = re.compile(r"\\(.)", re.S)


class NotAConversation(ValueError):
    pass


def _until(text: str, mark: str, at: int) -> int:
    """Where the first mark at or after ``at`` begins that no backslash makes literal."""
    start = at
    while (p := text.find(mark, at)) >= 0:
        slashes = p
        while slashes > start and text[slashes - 1] == "\\":
            slashes -= 1
        if (p - slashes) % 2 == 0:
            return p
        at = p + 1
    raise NotAConversation(f"no {mark!r} after {start}")


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the escaped text) of each turn."""
    at = 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise NotAConversation(f"no turn at {at}")
        role_end = _until(text, MIDDLE, at + len(OPEN))
        body = role_end + len(MIDDLE)
        end = _until(text, CLOSE, body)
        yield _ESCAPED.sub(r"\1", text[at + len(OPEN) : role_end]), _ESCAPED.sub(r"\1", text[body:end]), body, end
        at = end + len(CLOSE)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn as text, and where its body starts and ends, at the weakest escaping that reads back identically."""
    for level in LEVELS:
        quoted = [level.sub(lambda m: "\\" + m[0], x) for x in (role, text)]
        out = f"{OPEN}{quoted[0]}{MIDDLE}{quoted[1]}{CLOSE}"
        try:
            if [(r, t) for r, t, _, _ in parse(out)] == [(role, text)]:
                start = len(OPEN) + len(quoted[0]) + len(MIDDLE)
                return out, start, start + len(quoted[1])
        except NotAConversation:
            pass
    raise NotAConversation("the strongest escaping must read back")


def _same(a, b) -> bool:
    return a == b or (a is None or a != a) and (b is None or b != b)


def format_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_role: str = "assistant", piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """conv, piece (from 0), formatted, loss (array of start, end), n_turns: the rows of a conversation follow each other in order."""
    kind = dict(df.dtypes)[conv]
    empty = F.lit("")
    rows = (
        df.select(F.col(conv).alias("c"), F.col(turn).alias("n"), F.coalesce(role, empty).alias("r"), F.coalesce(text, empty).alias("t"))
        .repartition("c")
        .sortWithinPartitions("c", "n", "r", "t")
        .select(F.col("c").cast("string").alias("c"), "r", "t")
    )

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, parts, loss, size, turns, piece, now = [], [], [], 0, 0, 0, None

        def close():
            out.append((now, piece, "".join(parts), [x for span in loss for x in span], turns))
            parts.clear()
            loss.clear()

        for batch in batches:
            for c, r, t in zip(batch["c"], batch["r"], batch["t"]):
                if parts and (new := not _same(c, now)) or size >= piece_chars:
                    close()
                    piece, size, turns = 0 if new else piece + 1, 0, 0
                now = c
                rendered, a, b = render(r, t)
                if r == loss_role:
                    loss.append((size + a, size + b))
                parts.append(rendered)
                size += len(rendered)
                turns += 1
            if out:
                yield pd.DataFrame(out, columns=["c", "piece", "formatted", "flat", "n_turns"])
                out.clear()
        if parts:
            close()
            yield pd.DataFrame(out, columns=["c", "piece", "formatted", "flat", "n_turns"])

    made = rows.mapInPandas(stream, "c string, piece long, formatted string, flat array<long>, n_turns long")
    spans = F.transform(F.sequence(F.lit(0), F.shiftright(F.size("flat"), 1) - 1), lambda i: F.struct(F.get("flat", 2 * i).alias("start"), F.get("flat", 2 * i + 1).alias("end")))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return made.select(F.col("c").cast(kind).alias(conv), "piece", "formatted", F.when(F.size("flat") > 0, spans).otherwise(none).alias("loss"), "n_turns")


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row for each conversation of format_conversations' rows, taken in their order: counts and digests of what the parser recovers."""
    kind = dict(formatted.dtypes)[conv]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["c", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, state = None, None

        def row():
            n, turns, chars, loss, size = state
            return (now, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            out = []
            for c, text, spans in zip(batch["c"], batch["formatted"], batch["spans"]):
                if state is None or not _same(c, now):
                    if state is not None:
                        out.append(row())
                    now, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for r, t, _, _ in parse(text):
                    state[0] += 1
                    state[1].update(f"{r}\n{t}\n".encode("utf-8", "surrogatepass"))
                for a, b in zip(spans[::2], spans[1::2]):
                    learnt = _ESCAPED.sub(r"\1", text[a:b])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            yield pd.DataFrame(out, columns=names)
        if state is not None:
            yield pd.DataFrame([row()], columns=names)

    flat = F.flatten(F.transform("loss", lambda x: F.array(x["start"], x["end"])))
    found = formatted.select(F.col(conv).cast("string").alias("c"), "formatted", flat.alias("spans")).mapInPandas(
        stream, "c string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return found.select(F.col("c").cast(kind).alias(conv), *found.columns[1:])

"""Conversation prefix trie: what a cache of prefixes could share, by leaf-peeling message passing.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it. It is named by its depth and 128 bits, the exclusive
or of a hash of each of its turns and that turn's place, so that the names of all
prefixes of a conversation are running totals, and a conversation of any length may be
dealt over many tasks. Two sequences fall together with a probability below 1e-16 even
among 1e11 nodes.

A node is told by its smallest member and its depth. The nodes with the same smallest
member are a path downwards, so the trie is a tree of paths: each path but the root's
hangs from a node of another one. Peeling passes messages between paths: a path holds a
counter of the paths that hang from it and have not been heard of, a path whose counter
is 0 is complete and sends the totals of its subtree (childless nodes, saved tokens) up
to the path it hangs from, until only the root's is left, and finishes. So a round
peels whole paths, and a chain of a thousand turns costs one round and not a thousand.
Inside the paths, totals are then added up from the bottom, each message at the node
where its path hangs.

Rows of one conversation, children of one node, members and messages of one node are
never gathered: totals are added up in the tasks first, the few nodes with a large
share of all children (at most 1/HOT) are looked up by a broadcast, and the ids that a
digest is made of are written into blocks before one stream per node reads the blocks.

Rebuilding: conversation c becomes the first h turns of conversation c - c % 100 (% as
in SQL, with the sign of c) and its own turns after its first h; h = crc32(c) % 6.

Defined results: turns go by turn (null first), then role, then text; a null role or text is
empty; repeated rows are turns of their own; rows without a conversation id belong to
no conversation and are left out; a conversation without turns after rebuilding is a
member of the root alone; an empty table has no root and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import dropped, stored
from millrace.operators.scan import running

GROUP, SHARED = 100, 6
#: Conversations with this share of all rows, and nodes with this share of all children, are sent to all tasks: at most 1 / HOT.
HOT = 1e-4
#: Ids in a block of a digest.
BLOCK_IDS = 4096


def shared_turns(c: str = "c") -> Column:
    """How many first turns a conversation takes over."""
    return F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(SHARED)).cast("long")


def _looked_up(rows: DataFrame, on: dict[str, str], table: DataFrame, hot: Column) -> DataFrame:
    """Rows joined to a table that has each key once; ``hot`` tells its few rows that very many rows may ask for."""
    few, rest = table.where(hot), table.where(~F.coalesce(hot, F.lit(False)))
    same = [F.col(a) == F.col(b) for a, b in on.items()]
    early = rows.join(F.broadcast(few), same, "left")
    found = F.col(next(iter(on.values()))).isNotNull()
    late = early.where(~found).select(*rows.columns).join(rest, same, "left")
    return early.where(found).unionByName(late)


def rebuilt(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Conversations (c, length) and their rebuilt turns (c, depth, t1, t2, chars)."""
    plain = lambda x: F.coalesce(F.col(x), F.lit(""))
    rows = df.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), plain(role).alias("role"), plain(text).alias("text"))
    rows = rows.select("*", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(7), "text", "role").alias("t2"), F.length("text").cast("long").alias("chars"))
    turns = running(rows, ["c"], ["turn", "role", "text"], {"place": F.lit(1)}, keep=["c", "t1", "t2", "chars"])
    sizes = turns.groupBy("c").agg(F.max("place").alias("n")).withColumn("h", shared_turns()).withColumn("base", F.col("c") - F.col("c") % GROUP)
    bases = sizes.where(F.col("c") == F.col("base")).select(F.col("c").alias("b"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = sizes.join(bases, F.col("base") == F.col("b"), "left").select("c", "n", "h", "base", taken.alias("taken"))
    convs = stored(convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    # Own turns move up where the other conversation had fewer than h.
    short = convs.where("taken < h").select(F.col("c").alias("s"), F.col("taken").alias("fewer"), "n")
    total = turns.count()
    after = turns.where(F.col("place") > shared_turns())
    moved = _looked_up(after, {"c": "s"}, short, F.col("n") >= HOT * total).withColumn("taken", F.coalesce("fewer", shared_turns()))
    own = moved.select("c", (F.col("place") - shared_turns() + F.col("taken")).alias("depth"), "t1", "t2", "chars")
    heads = turns.where((F.col("c") % GROUP == 0) & (F.col("place") < SHARED)).select(F.col("c").alias("b"), "place", "t1", "t2", "chars")
    first = convs.where("taken > 0").select("c", "base", "taken").join(heads, (F.col("base") == F.col("b")) & (F.col("place") <= F.col("taken")))
    every = stored(own.unionByName(first.select("c", F.col("place").alias("depth"), "t1", "t2", "chars")), turns)
    return convs.select("c", "length"), every


def _blocks(ends: DataFrame) -> DataFrame:
    """k1, k2, depth, seq, ids: the members that end at each node in blocks of bounded size, numbered in the order of their ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, ids, seq = None, [], 0
        for batch in batches:
            out = []
            for p, k1, k2, depth, c in batch.itertuples(index=False):
                if (k1, k2, depth) != held or len(ids) == BLOCK_IDS:
                    if ids:
                        out.append((*held, seq, ",".join(ids)))
                    held, ids, seq = (k1, k2, depth), [], seq + 1 if seq else (p << 33) + 1
                ids.append(str(c))
            if out:
                yield pd.DataFrame(out, columns=["k1", "k2", "depth", "seq", "ids"])
        if ids:
            yield pd.DataFrame([(*held, seq, ",".join(ids))], columns=["k1", "k2", "depth", "seq", "ids"])

    by = ["k1", "k2", "depth", "c"]
    ranged = ends.repartitionByRange(*by).sortWithinPartitions(*by).select(F.spark_partition_id().alias("p"), *by)
    return ranged.mapInPandas(run, "k1 long, k2 long, depth long, seq long, ids string")


def digests(ends: DataFrame) -> DataFrame:
    """k1, k2, depth, ends_sha256 of every node at which a conversation (c, depth, k1, k2) ends. A task streams through blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha = None, None
        for batch in batches:
            out = []
            for k1, k2, depth, ids in batch.itertuples(index=False):
                if (k1, k2, depth) == now:
                    sha.update(b"," + ids.encode())
                else:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = (k1, k2, depth), hashlib.sha256(ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["k1", "k2", "depth", "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, sha.hexdigest())], columns=["k1", "k2", "depth", "ends_sha256"])

    by = ["k1", "k2", "depth"]
    dealt = _blocks(ends).repartition(*by).sortWithinPartitions(*by, "seq").select(*by, "ids")
    return dealt.mapInPandas(run, "k1 long, k2 long, depth long, ends_sha256 string")


def peeled(paths: DataFrame) -> list[DataFrame]:
    """Tables of paths (seg, parent, at, remaining, leaves, saved), one for each round: those whose counter is 0 are complete.

    A round takes the complete paths and sends their totals to the paths they hang from, which count them off and stay.
    """
    rounds = [paths]
    while True:
        ready, waiting = rounds[-1].where("remaining = 0"), rounds[-1].where("remaining > 0")
        if waiting.isEmpty():
            return rounds
        sent = ready.groupBy("parent").agg(F.count("*").alias("told"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        none = F.lit(0).cast("long")
        heard = waiting.join(sent.withColumnRenamed("parent", "to"), F.col("seg") == F.col("to"), "left")
        rounds.append(stored(heard.select(
            "seg", "parent", "at", (F.col("remaining") - F.coalesce("told", none)).alias("remaining"),
            (F.col("leaves") + F.coalesce("more_leaves", none)).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", none)).alias("saved"),
        )))


def nodes(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the trie."""
    convs, turns = rebuilt(df, conv, turn, role, text)
    x1, x2 = F.xxhash64("t1", "t2", "depth"), F.xxhash64(F.lit(11), "t2", "t1", "depth")
    placed = turns.select("c", "depth", "chars", x1.alias("x1"), x2.alias("x2"))
    prefixes = running(placed, ["c"], ["depth"], xor={"k1": "x1", "k2": "x2"})
    dropped(turns)
    one = lambda c: F.first(c).alias(c)
    zero = F.lit(0).cast("long")
    up = prefixes.select("c", "depth", "k1", "k2", "chars", F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"))
    below = stored(up.groupBy("depth", "k1", "k2").agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), one("chars"), one("p1"), one("p2")))
    # The root has no turn: its name is 0, 0, and it exists if any conversation does.
    root = convs.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("chars"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    children = below.groupBy((F.col("depth") - 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2")).agg(F.count("*").alias("n_children"))
    counted = below.unionByName(root).join(children, (F.col("depth") == F.col("d")) & (F.col("k1") == F.col("q1")) & (F.col("k2") == F.col("q2")), "left")
    counted = stored(counted.select(*below.columns, F.coalesce("n_children", zero).alias("n_children")), below)
    ends = prefixes.groupBy("c").agg(F.max_by(F.struct("depth", "k1", "k2"), "depth").alias("e")).select("c", "e.depth", "e.k1", "e.k2")
    ends = ends.unionByName(convs.where("length = 0").select("c", zero.alias("depth"), zero.alias("k1"), zero.alias("k2")))
    told = stored(digests(ends), prefixes)

    parents = counted.where("n_children > 0").select((F.col("depth") + 1).alias("d"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("asked"))
    total = counted.count()
    found = _looked_up(counted, {"depth": "d", "p1": "q1", "p2": "q2"}, parents, F.col("asked") >= HOT * total)
    every = stored(found.select("conv_id", "depth", "k1", "k2", "parent_conv_id", "n_convs", "n_children", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), counted)

    tops = every.where(F.col("parent_conv_id").isNull() | (F.col("parent_conv_id") != F.col("conv_id")))
    hanging = tops.groupBy("parent_conv_id").agg(F.count("*").alias("remaining")).withColumnRenamed("parent_conv_id", "of")
    own = every.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    paths = tops.select(F.col("conv_id").alias("seg"), F.col("parent_conv_id").alias("parent"), (F.col("depth") - 1).alias("at"))
    paths = paths.join(own, F.col("seg") == F.col("conv_id")).join(hanging, F.col("seg") == F.col("of"), "left")
    rounds = peeled(stored(paths.select("seg", "parent", "at", F.coalesce("remaining", zero).alias("remaining"), "leaves", "saved")))

    messages = reduce(DataFrame.unionByName, rounds).where("remaining = 0 and parent is not null")
    messages = messages.groupBy(F.col("parent").alias("to"), "at").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    held = every.join(messages, (F.col("conv_id") == F.col("to")) & (F.col("depth") == F.col("at")), "left")
    held = held.select(
        *every.columns, ((F.col("n_children") == 0).cast("long") + F.coalesce("more_leaves", zero)).alias("own_leaves"), (F.col("saved") + F.coalesce("more_saved", zero)).alias("own_saved")
    )
    keep = ["conv_id", "depth", "k1", "k2", "parent_conv_id", "n_convs", "n_children"]
    summed = running(held, ["conv_id"], [-F.col("depth")], {"n_leaves": "own_leaves", "saved_tokens": "own_saved"}, keep=keep)
    for spent in (every, *rounds):  # the result reads only the running totals and the digests
        dropped(spent)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    joined = summed.join(told.select(*[F.col(x).alias(f"e_{x}") for x in ("depth", "k1", "k2")], "ends_sha256"), (F.col("depth") == F.col("e_depth")) & (F.col("k1") == F.col("e_k1")) & (F.col("k2") == F.col("e_k2")), "left")
    return joined.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


TRIE_SQL = """
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY p) AS ts FROM o GROUP BY conv_id
), h AS (
  SELECT conv_id, ts, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b:
    list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda u, k: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384::BIGINT) ELSE u >> 1 END)), 4294967295::BIGINT) % 6 AS h FROM l
), r AS (
  SELECT a.conv_id, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) AS ts FROM h a LEFT JOIN l b ON b.conv_id = a.conv_id - a.conv_id % 100
), k AS (SELECT conv_id, d, ts[1:d] AS key, d = len(ts) AS ends FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM r)
), n AS (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM k GROUP BY key, d
), c AS (SELECT key[1:d - 1] AS key, count(*) AS n FROM n WHERE d > 0 GROUP BY 1
), f AS (SELECT n.*, coalesce(c.n, 0) AS n_children, (n_convs - 1) * coalesce(length(n.key[d].t), 0) AS saved FROM n LEFT JOIN c ON c.key = n.key
), s AS (
  SELECT key[1:a] AS key, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM f) GROUP BY 1
)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN s ON s.key = f.key LEFT JOIN n p ON f.d > 0 AND p.key = f.key[1:f.d - 1]
"""

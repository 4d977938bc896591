"""Line dedup by an exact set-similarity join; built-in functions only.

A line is the set of its tokens (lower-cased, split at white space). Lines of equal
lower-cased text form a class. Tokens are ordered by rarity: counts of token hashes
in CELLS cells, which bound every token's own count from above, give each token a
level, and the hash breaks ties. Two sets of similarity t or more share a token
among the rarest n - ceil(t n) + 1 of each (prefix filter), have sizes within a
factor t (length filter), can still reach the overlap they need from the first token
they share on (positional filter), and differ in few bits of a parity bitmap of their
tokens, which carries over the size of their difference.

Lines follow each other by document id (null first), hash of the text and place. A line is removed if
a line before it is similar, be that one removed itself or not; so of each class only
one earlier similar class need be found. Classes are numbered in that order. Two rounds
look for it among a few classes just before, in the lists of classes that share a prefix
token: all classes ask two, and where these are somewhat alike, as in a large group of
near copies, those without a similar one ask more of them, farther back and in the lists of
all prefix tokens, and verify the best three. What is left takes part in the join of prefix
tokens as the later side, which is added up, in its tasks, to the candidate of each class
that differs in the fewest bits, verified on the tokens themselves; only classes for which
it fails are joined with all their candidates. No list of all pairs is made.

Texts of the classes that take part are read again: a bit map of fixed size tells most
other lines beforehand (as it fills up, more is shuffled, and results stay the
same), so nothing as large as the text is shuffled.

Classes are named by 128 bits of their text, so two texts fall together with a
probability below 1e-16 even among 1e11 lines. Prefix tokens are 40-bit hashes: equal
hashes of different tokens only add candidates, and candidates are verified.

Defined results: a null text counts as empty; lines without tokens stay; rows that
share an id follow each other by a hash of the text; rows equal in id and text count as
one document, whose equal lines in the same place are not later than each other; an
empty table gives no rows.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import free_names, stored

THRESHOLD = 0.8
CELLS = 1 << 18
#: Bits of the map of the classes whose text is read again.
BITS = 1 << 20
#: Words of 64 bits of the wider parity bitmap, a power of two.
WIDE = 8
#: Classes with at least this share of all lines are looked up by a broadcast of at most 1 / HOT rows.
HOT = 1e-4
#: How far back classes of a group look in the lists of their prefix tokens, and how many of those found are verified.
FAR, TRIED = (1, 2, 3, 4, 6, 9, 13, 19, 28, 41, 60), 3
_HASH_BITS, _KEY_BITS, _ID_BITS = 57, 40, 55
_LEVELS = 60
#: Bits of 128 in which classes of a group may differ.
_ALIKE = 36
_OTHER_SPACE = "\t\r\x0b\f"


def _plain(text: Column) -> Column:
    """Lower-cased, its white space spaces and line feeds only, so that splitting needs no pattern."""
    low = F.lower(F.coalesce(text, F.lit("")))
    other = reduce(operator.or_, (F.contains(text, F.lit(c)) for c in _OTHER_SPACE))
    return F.when(other, F.translate(low, _OTHER_SPACE, " " * len(_OTHER_SPACE))).otherwise(low)


def _shiftleft(x: Column, by: Column) -> Column:
    return F.call_function("shiftleft", x, by)


def levels(docs: DataFrame, text: str, cells: int) -> bytes:
    """For each cell of token hashes the level of its count, a byte each: 0 for one token or none, two more for each doubling."""
    token = F.explode(F.split(F.replace(_plain(F.col(text)), F.lit("\n"), F.lit(" ")), " ")).alias("token")
    counted = docs.select(token).where("token <> ''").groupBy(F.pmod(F.xxhash64("token"), F.lit(cells)).cast("int").alias("cell")).count()
    level = F.least(F.floor(2 * F.log2("count")), F.lit(_LEVELS)).cast("long")
    # Eight cells to a row: the driver gets at most cells / 8 numbers, a partition at a time.
    packed = counted.groupBy((F.col("cell") / 8).cast("int").alias("at")).agg(F.sum(_shiftleft(level, F.col("cell").bitwiseAND(F.lit(7)) * 8)).alias("bytes"))
    found = bytearray(-(-cells // 8) * 8)
    for at, eight in packed.toLocalIterator():
        found[at * 8 : at * 8 + 8] = eight.to_bytes(8, "little")
    return bytes(found[:cells])


def _keys(line: Column, known: bytes) -> Column:
    """The line's distinct tokens as numbers, rarest first: level, then hash."""
    table = F.split(F.lit(",".join(map(str, known))), ",").cast("array<int>")  # folded once, to a literal
    level = lambda h: F.coalesce(F.get(table, F.pmod(h, F.lit(len(known)))), F.lit(0))  # noqa: E731  never null, so that plain numbers are sorted
    one = lambda h: F.shiftleft(level(h).cast("long"), _HASH_BITS).bitwiseOR(h.bitwiseAND(F.lit((1 << _HASH_BITS) - 1)))
    hashed = F.transform(F.split(line, " "), lambda t: F.xxhash64(t))
    return F.sort_array(F.transform(F.array_distinct(F.array_remove(hashed, F.xxhash64(F.lit("")))), one))


def _needed(a: Column, b: Column, threshold: float) -> Column:
    """The least overlap of sets of two sizes at the threshold."""
    return F.ceil(F.lit(threshold / (1 + threshold)) * (a + b) - 1e-9)


def _parity(half: int) -> Column:
    """64 of 128 bits, each the parity of how many tokens fall there."""
    signed = lambda i: (1 << i) - (1 << 64) * (i == 63)
    ones = F.array(*[F.lit(signed(i & 63) if i >> 6 == half else 0).cast("long") for i in range(128)])
    return F.aggregate("keys", F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(F.get(ones, k.bitwiseAND(F.lit(127)))))


def _named(s: Column) -> list[Column]:
    return [F.xxhash64(s).alias("u"), F.xxhash64(F.lit(7), s).alias("u2")]


def text_hash(text: str) -> Column:
    """Tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def lines(docs: DataFrame, text: str, doc_id: str, threshold: float, known: bytes) -> DataFrame:
    """id, h (of the text), line, u, u2 (the class), m and m2 (parity bitmap), n (tokens), prefix of all lines with tokens."""
    each = F.transform(F.split(_plain(F.col(text)), "\n"), lambda s, i: F.struct(i.alias("line"), *_named(s), _keys(s, known).alias("keys")))
    rows = docs.select(F.col(doc_id).alias("id"), text_hash(text).alias("h"), F.inline(each)).where(F.size("keys") > 0)
    n = F.size("keys")
    prefix = F.slice("keys", F.lit(1), (n - F.ceil(F.lit(threshold) * n - 1e-9) + 1).cast("int"))
    short = F.transform(prefix, lambda k: k.bitwiseAND(F.lit((1 << _KEY_BITS) - 1)))
    return rows.select("id", "h", "line", "u", "u2", _parity(0).alias("m"), _parity(1).alias("m2"), n.alias("n"), short.alias("prefix"))


def _posts(sets: DataFrame) -> DataFrame:
    """A row for each prefix token k of each class. code: twice the token's place, one more where the class need not be joined as the later one."""
    done = F.col("done").cast("int") if "done" in sets.columns else F.lit(0)
    rows = sets.select("sid", "m", "m2", "n", done.alias("done"), F.posexplode("prefix").alias("pos", "k"))
    return rows.select("sid", "m", "m2", "n", (2 * F.col("pos") + F.col("done")).alias("code"), "k")


def _bits(m: str, other: str) -> Column:
    """In how many of 128 bits two parity bitmaps differ."""
    return reduce(operator.add, (F.bit_count(F.col(f"{m}{half}").bitwiseXOR(F.col(f"{other}{half}"))) for half in ("", "2")))


def _candidates(later: DataFrame, every: DataFrame, threshold: float) -> DataFrame:
    """a, b, bits: classes and earlier ones that pass all filters, once for each prefix token that they share.

    Where both sides are the same table, both sides of every condition are used, so that it is shuffled once.
    """
    one, other = (posts.select(*[F.col(c).alias(f"{side}_{c}") for c in posts.columns]) for side, posts in (("a", later), ("b", every)))
    na, nb = F.col("a_n"), F.col("b_n")
    need, bits = _needed(na, nb, threshold), _bits("a_m", "b_m")
    place = lambda side: F.shiftright(f"{side}_code", 1)
    near = (
        (F.col("a_k") == F.col("b_k"))
        & (na >= F.lit(threshold) * nb - 1e-9)
        & (nb >= F.lit(threshold) * na - 1e-9)
        & (F.least(na - place("a"), nb - place("b")) - F.col("a_code").bitwiseAND(F.lit(1)) * F.lit(1 << 30) >= need)
        & (bits <= na + nb - 2 * need)
        & (F.col("b_sid") < F.col("a_sid"))
    )
    return one.join(other, near).select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b"), bits.cast("long").alias("bits"))


def _texts(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """sid, tokens of the classes in ``wanted`` (sid, u, u2)."""
    # Seven bits to a byte, so that every byte is a character whose code can be asked for.
    found = bytearray(-(-BITS // 56) * 8)
    at = F.pmod("u", F.lit(BITS)).cast("int")
    byte, bit = (at / 7).cast("int"), at % 7
    packed = wanted.groupBy((byte / 8).cast("int").alias("place")).agg(F.bit_or(_shiftleft(F.lit(1).cast("long"), byte % 8 * 8 + bit)).alias("bits"))
    for place, bits in packed.toLocalIterator():
        found[place * 8 : place * 8 + 8] = bits.to_bytes(8, "little")
    told = F.ascii(F.substring(F.lit(bytes(found)), byte + 1, F.lit(1)).cast("string"))
    marked = told.bitwiseAND(_shiftleft(F.lit(1), bit)) != 0
    split = docs.select(F.explode(F.split(_plain(F.col(text)), "\n")).alias("s"))
    some = split.withColumn("u", F.xxhash64("s")).where(marked).select("s").distinct().select("s", *_named(F.col("s")))
    rows = some.join(wanted.select("sid", "u", "u2"), ["u", "u2"]).select("sid", F.array_distinct(F.array_remove(F.split("s", " "), "")).alias("tokens"))
    one = lambda a, h: a.bitwiseXOR(_shiftleft(F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int")))
    word = lambda hs: lambda w: F.aggregate(F.filter(hs, lambda h: F.shiftright(h, 6).bitwiseAND(F.lit(WIDE - 1)) == w), F.lit(0).cast("long"), one)
    wide = F.transform(F.array(F.transform("tokens", lambda t: F.xxhash64(t))), lambda hs: F.transform(F.array(*map(F.lit, range(WIDE))), word(hs)))
    return rows.withColumn("wide", F.element_at(wide, 1))


def _close(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that also differ in few bits of a wider parity bitmap: for long lines the narrow one says little."""
    known = texts.select("sid", F.size("tokens").alias("n"), "wide")
    both = pairs
    for side in "ab":
        both = both.join(known.select(*[F.col(c).alias(side if c == "sid" else f"{side}_{c}") for c in known.columns]), side)
    bits = reduce(operator.add, (F.bit_count(F.get("a_wide", F.lit(i)).bitwiseXOR(F.get("b_wide", F.lit(i)))) for i in range(WIDE)))
    return both.where(bits <= F.col("a_n") + F.col("b_n") - 2 * _needed(F.col("a_n"), F.col("b_n"), threshold)).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """a: classes that are similar to their b in any of their pairs."""
    one = texts.select(F.col("sid").alias("a"), F.col("tokens").alias("a_tokens"))
    other = texts.select(F.col("sid").alias("b"), F.col("tokens").alias("b_tokens"))
    overlap = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return pairs.join(other, "b").join(one, "a").where(overlap >= _needed(F.size("a_tokens"), F.size("b_tokens"), threshold)).select("a").distinct()


def _among(posts: DataFrame, threshold: float, far: tuple[int, ...]) -> DataFrame:
    """sid, code, alike: for each post the best class so far before it (far < 0: after it) in the list of its token, or null where
    none before it is near enough; and whether any is somewhat like it."""
    order = Window.partitionBy("k").orderBy("sid")
    beside = posts.select("sid", "m", "m2", "n", "code", *[F.lag(F.struct("sid", "m", "m2", "n"), by).over(order).alias(f"b{i}") for i, by in enumerate(far)])
    codes, alike = [], F.lit(False)
    for i, by in enumerate(far):
        bits, allowed = _bits("m", f"b{i}.m"), F.col("n") + F.col(f"b{i}.n") - 2 * _needed(F.col("n"), F.col(f"b{i}.n"), threshold)
        alike = alike | F.coalesce(bits <= F.greatest(allowed, F.least(2 * allowed, F.lit(_ALIKE))), F.lit(False))
        if by > 0:
            codes.append(F.when(bits <= allowed, _code(bits.cast("long"), F.col(f"b{i}.sid"))))
    return beside.select("sid", F.least(*codes, F.lit(None).cast("long")).alias("best"), alike.alias("alike"), F.col("code").alias("place"))


def _neighbours(sets: DataFrame, threshold: float) -> DataFrame:
    """sid, code: classes that are somewhat like one of the two just before or after them among those that share one of a few of
    their prefix tokens; the best of those before that are near enough, if any."""
    few = F.array_distinct(F.transform(F.array(*map(F.lit, range(1, 7))), lambda i: F.get("prefix", F.floor(F.size("prefix") * i / 7).cast("int"))))
    beside = _among(_posts(sets.withColumn("prefix", few)), threshold, (1, 2, -1, -2)).where("alike")
    return beside.groupBy("sid").agg(F.min("best").alias("code"))


def _farther(group: DataFrame, threshold: float) -> DataFrame:
    """a, b: for classes that are not done the best of those before them, near enough, in the lists of all their prefix tokens."""
    beside = _among(_posts(group), threshold, FAR).where((F.col("place").bitwiseAND(F.lit(1)) == 0) & F.col("best").isNotNull())
    best = beside.groupBy("sid").agg(F.slice(F.array_sort(F.collect_set("best")), 1, TRIED).alias("codes"))
    return _best(best.select("sid", F.explode("codes").alias("code")))


def _code(bits: Column, sid: Column) -> Column:
    """A candidate and in how many bits it differs as one number, so that the least number is the best candidate."""
    return F.shiftleft(bits, _ID_BITS).bitwiseOR(sid)


def _best(found: DataFrame) -> DataFrame:
    return found.where("code is not null").select(F.col("sid").alias("a"), F.col("code").bitwiseAND(F.lit((1 << _ID_BITS) - 1)).alias("b"))


def similar(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, cells: int = CELLS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All lines with tokens (id, h, line, u, u2); classes (sid, u, u2, first, times); sid of the classes that an earlier one is similar to."""
    every = stored(lambda: lines(docs, text, doc_id, threshold, levels(docs, text, cells)))
    one = lambda c: F.first(c).alias(c)
    first = F.min(F.struct("id", "h", "line")).alias("first")

    def classes() -> DataFrame:
        """In order, so that their numbers tell which is earlier."""
        each = every.groupBy("u", "u2").agg(first, F.count("*").alias("times"), one("m"), one("m2"), one("n"), one("prefix"))
        return each.orderBy("first").withColumn("sid", F.monotonically_increasing_id())

    sets = stored(classes)
    every = stored(lambda: every.select("id", "h", "line", "u", "u2"), every)
    # Members of large groups mostly find a neighbour; only the others are joined with all candidates.
    group = stored(lambda: _neighbours(sets, threshold))
    texts = stored(lambda: _texts(docs, text, sets.join(group.select("sid"), "sid")))
    found = stored(lambda: _verified(_best(group), texts, threshold))
    alike = group.select("sid").join(found, F.col("sid") == F.col("a"), "left").select("sid", F.col("a").isNotNull().alias("done"))
    more = stored(lambda: _farther(sets.join(alike, "sid"), threshold))
    found = stored(lambda: found.unionByName(_verified(more, texts, threshold)), found, more, texts, group)

    def met() -> DataFrame:
        """The best candidate of each class, and every class that is a candidate of another, in one number each."""
        posts = _posts(sets.join(found, F.col("sid") == F.col("a"), "left").withColumn("done", F.col("a").isNotNull()))
        some = _candidates(posts, posts, threshold)
        own, other = F.struct(F.col("a").alias("sid"), _code(F.col("bits"), F.col("b")).alias("code")), F.struct(F.col("b").alias("sid"), F.lit(None).cast("long").alias("code"))
        return some.select(F.inline(F.array(own, other))).groupBy("sid").agg(F.min("code").alias("code"))

    involved = stored(met)
    part = stored(lambda: sets.drop("times").join(involved, "sid"), involved)
    texts = stored(lambda: _texts(docs, text, part))
    more = stored(lambda: found.unionByName(_verified(_best(part), texts, threshold)), found)
    open_ = stored(lambda: part.where("code is not null").join(more, F.col("sid") == F.col("a"), "left_anti"))
    rest = stored(lambda: _close(_candidates(_posts(open_), _posts(part), threshold).select("a", "b").distinct(), texts, threshold), open_)
    later = stored(lambda: more.unionByName(_verified(rest, texts, threshold)).withColumnRenamed("a", "sid"), more, rest, texts, part)
    return every.select("id", "h", "line", "u", "u2"), sets.select("sid", "u", "u2", "first", "times"), later


def removals(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, cells: int = CELLS) -> DataFrame:
    """id, h (text_hash), removed (places of removed lines, from 0, in order) of the documents that lose lines."""
    every, sets, later = similar(docs, text, doc_id, threshold, cells)
    told = sets.join(later.withColumn("later", F.lit(True)), "sid", "left").where("times > 1 or later").select("u", "u2", "first", "later", "times")
    total = every.count()
    hot = told.where(F.col("times") >= F.lit(HOT) * total)  # at most 1 / HOT rows
    seen = every.join(F.broadcast(hot), ["u", "u2"], "left")
    rare = every.join(F.broadcast(hot.select("u", "u2")), ["u", "u2"], "left_anti").join(told.where(F.col("times") < F.lit(HOT) * total), ["u", "u2"])
    of = seen.where("times is not null").unionByName(rare)
    gone = of.where(F.col("later") | ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h")) & (F.col("line") == F.col("first.line"))))
    return gone.groupBy("id", "h").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, cells: int = CELLS) -> DataFrame:
    """The documents without removed lines, with all their columns; a text of which no line is removed stays as it is, null included."""
    gone = removals(docs, text, doc_id, threshold, cells)
    own, own_hash, lost = free_names(docs, 3)
    gone = gone.select(F.col("id").alias(own), F.col("h").alias(own_hash), F.col("removed").alias(lost))
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(lost, i)), "\n")
    joined = docs.join(gone, (F.col(own_hash) == text_hash(text)) & F.col(doc_id).eqNullSafe(F.col(own)), "left")
    return joined.select(*[F.when(F.col(lost).isNull(), F.col(c)).otherwise(left).alias(c) if c == text else F.col(c) for c in docs.columns])

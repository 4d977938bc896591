"""Secret scans by a battery of randomness tests; built-in functions only.

Base spans are matches of fixed patterns: assignments to a secret's name, access keys,
long hexadecimal runs. The method adds spans of its own, of kind ``random``: runs of
at least TOKEN characters of the alphabets that secrets are written in, that no base
span contains, and that

* pass the battery: for the encoding inferred from its characters (hexadecimal, base 32,
  36, 62, 64, ..., letters alone) none of three tests finds it unlike a string drawn
  uniformly, at PASS: chi-squared of the alphabet's counts (are they uneven?), runs of
  character classes (halves of the alphabet, where there is only one class), serial
  correlation of neighbours;
* are told from ordinary strings under control of false discoveries. An ordinary string
  repeats letters as prose does (KAPPA, KAPPA3) and changes its class of characters at
  a share CHANGES of its places at most: both are parameters that state the null
  hypothesis. The chance that one has as few coincidences and as many changes (a normal
  tail and a Chernoff bound, added up by Fisher's rule) falls with the length, so short
  strings have to be all the stranger. Benjamini and Hochberg's rule at level RATE is
  applied within each octave of lengths, over the candidates of all documents: long and
  obvious secrets don't lower the bar for short ones.

Runs of digits alone, words and identifiers have no or few changes, encoded text and
pictures fail the battery as they grow.

A document's matches become rows as soon as they are found, and are put together again
by row; a task never holds more than the matches of one document at a time. Chances are
counted in steps of a hundredth of a power of ten, so the rule needs a bounded number of
counts, however many candidates there are.

Defined results: a null text counts as empty; places are code points, the end exclusive;
a text without matches has counts of 0 and empty lists; repeated rows are scanned each
for itself; an empty table gives no rows; other columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import math
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

#: Fixed patterns of the base spans, in the order in which they are listed, with the least length of what counts (group 2 or all).
BASE = (
    ("assign", r"(?<a>[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
KINDS = (*[k for k, *_ in BASE], "random")
TOKEN = 16
PASS, RATE = 1e-3, 0.01
#: What ordinary strings are like: chances that two, and three, letters are the same; share of places where the class of character changes.
KAPPA, KAPPA3, CHANGES = 0.065, 0.0054, 0.12
STEPS, MOST = 100, 30_000
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings by the first that has all characters of a string (padding aside): name, alphabet.
ENCODINGS = (
    ("decimal", _DIGITS), ("lower", _LOWER), ("upper", _UPPER), ("hex", _DIGITS + "abcdef"), ("upper hex", _DIGITS + "ABCDEF"), ("base32", _UPPER + "234567"), ("base36", _DIGITS + _LOWER),
    ("upper base36", _DIGITS + _UPPER), ("letters", _UPPER + _LOWER), ("base62", _DIGITS + _UPPER + _LOWER), ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
    ("mixed", _UPPER + _LOWER + _DIGITS + "+/-_="),
)
_CLASSES = {**dict.fromkeys(_DIGITS, "d"), **dict.fromkeys(_LOWER, "l"), **dict.fromkeys(_UPPER, "u"), **dict.fromkeys("+/-_=", "s")}


def _matches(text: Column, kind: str, pattern: str, group: int, gate: Column) -> Column:
    """An array of (kind, i, gap, len, value): for each match the code points since the last one, its own, and what a group holds."""
    none = F.array().cast("array<string>")
    held = lambda x: F.when(gate, x).otherwise(none)
    parts = [held(F.split(text, pattern, -1)).alias("gap"), held(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("found")]
    if group:
        parts.append(held(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias("value"))
    each = F.filter(F.arrays_zip(*parts), lambda z: z["found"].isNotNull())
    return F.transform(each, lambda z, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(z["gap"]).alias("gap"), F.length(z["found"]).alias("len"), z["value" if group else "found"].alias("value")))


def matches(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """row, the columns in ``keep`` as k0, k1, ..., kind, start, end, value: a row for each match, and one without kind for a document that has none."""
    t = F.col("t")
    long = t.rlike(r"[A-Za-z0-9+/_=-]{%d}" % TOKEN)
    gates = {"assign": t.rlike(r"[Pp][Aa][Ss][Ss][Ww]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"), "access": F.contains(t, F.lit("AKIA")), "hex": long, "random": long}
    patterns = [*[(k, p, g) for k, p, g, _ in BASE], ("random", r"[A-Za-z0-9+/_=-]{%d,}" % TOKEN, 0)]
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    own = [f"k{i}" for i in range(len(keep))]
    found = F.concat(*[_matches(t, k, p, g, gates[k]) for k, p, g in patterns])
    each = rows.select(*own, "row", F.inline_outer(found)).repartition("row")
    w = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(w)
    least = reduce(lambda a, k: a.when(F.col("kind") == KINDS.index(k[0]), F.length("value") >= k[3]), BASE, F.when(F.col("kind").isNull(), True)).otherwise(True)
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
    # A match that is too short stays, as a row of no kind: its document may have no other row.
    return placed.withColumn("kind", F.when(least, F.col("kind"))).select(*own, "row", "kind", "start", "end", F.when(F.col("kind") == KINDS.index("random"), F.col("value")).alias("value"))


def _ln_tail(z: Column) -> Column:
    """The natural log of the chance that a standard normal is above z, to 1e-7 of the chance."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + x / 2)
    terms = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
    inner = reduce(lambda a, c: a * t + c, reversed(terms[:-1]), F.lit(terms[-1]))
    above = F.ln(t / 2) - x * x + inner
    return F.when(z >= 0, above).otherwise(F.ln(1 - F.exp(above)))


def _squares(s: Column) -> Column:
    """The sum of the squares of how often each character occurs."""
    times = lambda c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    return F.aggregate(F.array_distinct(F.split(s, "")), F.lit(0.0), lambda a, c: a + times(c).cast("double") * times(c))


def _runs(s: Column) -> Column:
    return F.length(F.regexp_replace(s, r"(.)\1+", "$1")).cast("double")


def tested(tokens: DataFrame) -> DataFrame:
    """Adds to strings (value) their encoding, ln_chi, ln_runs, ln_serial (chances under uniform draws) and ln_ordinary (under the null of ordinary strings)."""
    bare = F.when(F.rtrim("value", F.lit("=")) == "", F.col("value")).otherwise(F.rtrim("value", F.lit("=")))
    rows = tokens.withColumn("s", bare).withColumn("n", F.length("s").cast("double"))
    has = lambda alphabet: F.translate("s", alphabet, "") == ""
    number = reduce(lambda a, e: a.when(has(e[1][1]), F.lit(e[0])), enumerate(ENCODINGS[1:], 1), F.when(has(_DIGITS), F.lit(0)))
    rows = rows.withColumn("e", number)
    of = lambda values: F.get(F.array(*map(F.lit, values)), F.col("e"))
    k, n = of([float(len(a)) for _, a in ENCODINGS]), F.col("n")
    # Classes of characters as the runs test sees them: halves of the alphabet where there is one class alone.
    classes, chance, both = [], [], []
    for _, a in ENCODINGS:
        of_class = [_CLASSES[c] for c in a]
        if len(set(of_class)) == 1:
            of_class = ["a" if i < len(a) // 2 else "b" for i in range(len(a))]
        shares = [of_class.count(c) / len(a) for c in set(of_class)]
        classes.append("".join(of_class))
        chance.append(1 - sum(p * p for p in shares))
        both.append(sum(p * (1 - p) ** 2 for p in shares))
    q, q2 = of(chance), of(both)
    rows = rows.select("*", k.alias("k"), q.alias("q"), q2.alias("q2"), of([a for _, a in ENCODINGS]).alias("alphabet"), of(classes).alias("classes"))
    k, q, q2 = F.col("k"), F.col("q"), F.col("q2")
    plain = F.translate("s", _DIGITS + _LOWER + _UPPER + "+/-_=", "".join(_CLASSES[c] for c in _DIGITS + _LOWER + _UPPER + "+/-_="))
    seen = reduce(lambda a, i: a.when(F.col("e") == i, F.translate("s", ENCODINGS[i][1], classes[i])), range(1, len(ENCODINGS)), F.when(F.col("e") == 0, F.translate("s", _DIGITS, classes[0])))
    place = lambda c: F.call_function("instr", F.col("alphabet"), c).cast("double") - (F.col("k") + 1) / 2
    start = F.struct(F.lit(0.0).alias("last"), F.lit(0.0).alias("sum"))
    step = lambda a, c: F.struct(place(c).alias("last"), (a["sum"] + a["last"] * place(c)).alias("sum"))
    rows = rows.select(
        "*", _squares(F.col("s")).alias("squares"), _squares(F.lower("s")).alias("folded"), _runs(seen).alias("runs"), (_runs(plain) - 1).alias("changes"),
        F.aggregate(F.split("s", ""), start, step, lambda a: a["sum"]).alias("product"),
    )
    # Moments of the tests under uniform draws.
    chi = (k / n * F.col("squares") - n - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
    spread = F.sqrt((n - 1) * q * (1 - q) + 2 * (n - 2) * (q2 - q * q))
    run = (F.col("runs") - 1 - (n - 1) * q) / spread
    serial = F.col("product") / ((k * k - 1) / 12) / F.sqrt(n - 1)
    two_sided = lambda z: F.least(F.lit(0.0), math.log(2) + _ln_tail(F.abs(z)))
    # And of coincidences and changes in ordinary strings.
    pairs = (F.col("folded") - n) / 2
    all_pairs, triples = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
    few = (pairs - all_pairs * KAPPA) / F.sqrt(all_pairs * KAPPA * (1 - KAPPA) + 6 * triples * (KAPPA3 - KAPPA**2))
    share = F.col("changes") / (n - 1)
    excess = F.when(share <= CHANGES, F.lit(0.0)).otherwise(
        share * F.ln(share / CHANGES) + F.when(share < 1, (1 - share) * F.ln((1 - share) / (1 - CHANGES))).otherwise(F.lit(0.0))
    )
    strange = (n - 1) * excess - _ln_tail(-few)
    rows = rows.select(*tokens.columns, "e", "n", _ln_tail(chi).alias("ln_chi"), two_sided(run).alias("ln_runs"), two_sided(serial).alias("ln_serial"), (F.ln(1 + strange) - strange).alias("ln_ordinary"))
    return rows


def discovered(tokens: DataFrame, rate: float = RATE) -> DataFrame:
    """octave, least: for each octave of lengths the least step of -log10 of the chance at which candidates are discoveries.

    Benjamini and Hochberg: the largest chance p with p * (all candidates) <= rate * (candidates with p or less). At most MOST steps an octave.
    """
    counts = tokens.groupBy("octave", "step").agg(F.count("*").alias("c"))
    down = Window.partitionBy("octave").orderBy(F.desc("step"))
    ranked = counts.withColumn("rank", F.sum("c").over(down)).withColumn("m", F.sum("c").over(Window.partitionBy("octave")))
    good = F.pow(F.lit(10.0), -F.col("step") / STEPS) * F.col("m") <= rate * F.col("rank")
    return ranked.where(good).groupBy("octave").agg(F.min("step").alias("least"))


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rate: float = RATE) -> DataFrame:
    """The columns in ``keep`` and ``found``: an array of (start, kind, end) in order, kind as a number of KINDS."""
    own = [f"k{i}" for i in range(len(keep))]
    found = matches(docs, text, keep)
    random = KINDS.index("random")
    # What a base span contains is no candidate: it starts no later and ends no earlier.
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.max(F.when(F.col("kind") < random, F.col("end"))).over(before)
    each = found.withColumn("inside", F.coalesce(covered >= F.col("end"), F.lit(False)))
    candidate = (F.col("kind") == random) & ~F.col("inside")
    rows = tested(each.withColumn("value", F.when(candidate, F.col("value"))))
    passed = reduce(operator.and_, (F.col(c) >= math.log(PASS) for c in ("ln_chi", "ln_runs", "ln_serial")))
    step = F.least(F.floor(-F.col("ln_ordinary") / math.log(10) * STEPS), F.lit(MOST)).cast("int")
    rows = stored(rows.select(*own, "row", "kind", "start", "end", F.when(F.col("value").isNotNull(), F.floor(F.log2("n")).cast("int")).alias("octave"), F.when(F.col("value").isNotNull(), step).alias("step"), passed.alias("passed")))
    bar = discovered(rows.where("octave is not null"), rate).withColumnRenamed("octave", "o")
    told = rows.join(F.broadcast(bar), F.col("octave") == F.col("o"), "left")
    use = (F.col("kind") < random) | (F.col("passed") & (F.col("step") >= F.col("least")))
    span = F.when(use, F.struct("start", "kind", "end"))
    whole = told.groupBy("row").agg(*[F.first(c).alias(c) for c in own], F.array_sort(F.collect_list(span)).alias("found"))
    return whole.select(*[F.col(c).alias(k) for c, k in zip(own, keep)], "found")


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(scanned: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans, of each row of ``scan``."""
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"] < KINDS.index("random"))
    return scanned.select(*keep, *[number(k) for k, *_ in BASE], F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"), _written(F.col("found")).alias("spans"))

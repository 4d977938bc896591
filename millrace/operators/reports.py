"""Evaluation reports: a long table (benchmark, row, metric, value), a rule table, scores and their means.

Rounding is half to even on the binary value's shortest decimal; the last digit can
differ from Python's round on ties that binary cannot hold.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from decimal import ROUND_HALF_EVEN, Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import plain_path

LONG = "benchmark string, row int, split string, metric string, value double"
RULES = "benchmark string, pick string, metrics array<string>, how string"


def one_decimal(x: Column) -> Column:
    return F.bround(x, 1)


def as_percent(x: Column) -> Column:
    """Shares under 1 times 100, to one decimal; a perfect 1.0 stays 1.0."""
    return one_decimal(F.when(x < 1.0, x * 100).otherwise(x))


def filtered(report: DataFrame, column: str, value: str, metric: str, scale: float = 1.0) -> DataFrame:
    """The metric of the rows whose column has a value: one score."""
    return report.where(F.col(column) == value).select((F.col(metric) * scale).alias("score"))


@dataclass(frozen=True)
class Report:
    """Where a benchmark's numbers stand. kind: 'table' (CSV), 'indexed' (CSV, rows named by the first column) or 'json'.

    pick: 'first', 'last', a row's number, or the name of a row (of the split, or of the index). metrics: columns, or dotted
    places in JSON, where a number is a place in a list (-1: the last). how: 'mean' or 'sum'.
    """

    benchmark: str
    file: str
    kind: str = "table"
    pick: str = "first"
    metrics: tuple[str, ...] = ("Overall",)
    how: str = "mean"
    link: str | None = None


def _number(value: object) -> float | None:
    try:
        return float(str(value).rstrip("%"))
    except ValueError:
        return None


def _json_number(text: str, place: str) -> float | None:
    here: object = json.loads(text)
    for part in place.split("."):
        if isinstance(here, list) and part.lstrip("-").isdigit():
            here = here[int(part)] if -len(here) <= int(part) < len(here) else None
        elif isinstance(here, dict):
            here = here.get(part)
        else:
            return None
    return _number(here)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType())])))
def _json_numbers(texts: pd.Series, places: pd.Series) -> pd.Series:
    return pd.Series([[(p, v) for p in ps if (v := _json_number(t, p)) is not None] for t, ps in zip(texts, places)], dtype=object)


def _fields(tables: DataFrame) -> DataFrame:
    """file, row, i, name, field of CSV texts (file, text): row 0 follows the header; quoted fields may hold anything; blank lines are skipped."""
    pattern = r"(\"(?:[^\"]++|\"\")*+\"|[^,\r\n]*+)(,|\r?\n)"
    whole = F.concat(F.rtrim("text", F.lit("\r\n")), F.lit("\n"))
    pairs = F.arrays_zip(F.regexp_extract_all(whole, F.lit(pattern), F.lit(1)).alias("field"), F.regexp_extract_all(whole, F.lit(pattern), F.lit(2)).alias("end"))
    each = tables.select("file", F.posexplode(pairs).alias("at", "x")).select("file", "at", "x.field", "x.end")
    order = Window.partitionBy("file").orderBy("at")
    line = F.sum((F.col("end") != ",").cast("int")).over(order) - (F.col("end") != ",").cast("int")
    plain = F.when(F.startswith("field", F.lit('"')), F.replace(F.expr("substring(field, 2, length(field) - 2)"), F.lit('""'), F.lit('"'))).otherwise(F.col("field"))
    each = each.select("file", "at", line.alias("line"), plain.alias("field"))
    in_line = Window.partitionBy("file", "line")
    each = each.withColumn("i", F.row_number().over(in_line.orderBy("at")) - 1).withColumn("n", F.count("*").over(in_line)).where("n > 1 or field <> ''")
    rows = each.select("file", (F.dense_rank().over(Window.partitionBy("file").orderBy("line")) - 2).alias("row"), "i", "field")
    header = rows.where("row = -1").select(F.col("file").alias("f"), F.col("i").alias("j"), F.col("field").alias("name"))
    return rows.where("row >= 0").join(header, (F.col("file") == F.col("f")) & (F.col("i") == F.col("j"))).select("file", "row", "i", "name", "field")


def scanned(spark: SparkSession, root: str, registry: list[Report]) -> DataFrame:
    """(experiment, benchmark, row, split, metric, value) of all reports below a folder, of any number of experiments, in one scan.

    A file belongs to the rules whose ``file`` its name ends with (of several endings the longest); what stands before the ending
    is the experiment. The rules are the only thing that is broadcast; files without a rule aren't parsed, numbers that can't be read
    are left out, JSON that can't be parsed fails the job.
    """
    known = [(r.benchmark, r.file, r.kind, list(r.metrics)) for r in registry if not r.link]
    rules = spark.createDataFrame(known, "benchmark string, ending string, kind string, metrics array<string>")
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.col("value").alias("text"), plain_path(F.col("_metadata.file_path")).alias("file"))
    files = files.withColumn("base", F.element_at(F.split("file", "/"), -1))
    endings = sorted({r[1] for r in known}, key=lambda e: (-len(e), e))
    ending = F.coalesce(*[F.when(F.endswith("base", F.lit(e)), F.lit(e)) for e in endings]) if endings else F.lit(None).cast("string")
    mine = files.withColumn("own", ending).where("own is not null").withColumn("experiment", F.expr("substring(base, 1, length(base) - length(own))"))
    both = mine.join(F.broadcast(rules), F.col("own") == F.col("ending"))
    told = both.where("kind = 'json'").select("experiment", "benchmark", F.lit(0).alias("row"), F.lit("").alias("split"), F.inline(_json_numbers("text", "metrics")))
    tables = mine.join(F.broadcast(rules.where("kind <> 'json'").select("ending").distinct()), F.col("own") == F.col("ending"), "left_semi")
    fields = _fields(tables.select("file", "text")).join(both.where("kind <> 'json'").select(F.col("file").alias("f"), "experiment", "benchmark", "kind", "metrics"), F.col("file") == F.col("f"))
    label = F.when(F.col("kind") == "indexed", F.col("i") == 0).otherwise(F.lower("name") == "split")
    split = F.min(F.when(label, F.struct("i", "field"))).over(Window.partitionBy("file", "benchmark", "row"))["field"]
    value = F.regexp_replace("field", "%$", "").try_cast("double")
    rows = fields.select("experiment", "benchmark", "row", F.coalesce(split, F.lit("")).alias("split"), F.col("name").alias("metric"), value.alias("value"), "metrics")
    return rows.where(F.array_contains("metrics", F.col("metric")) & F.col("value").isNotNull()).drop("metrics").unionByName(told)


def read_reports(spark: SparkSession, root: str, name: Callable[[str], str], registry: list[Report]) -> DataFrame:
    """(benchmark, row, split, metric, value) of every report of a registry that is in a folder; ``name`` makes a file's name."""
    named = [replace(r, file=name(r.file)) for r in registry]
    return scanned(spark, root, named).where("experiment = ''").select("benchmark", "row", "split", "metric", "value")


def suite(spark: SparkSession, root: str, registry: list[Report]) -> DataFrame:
    """(experiment, report): 'name: score' lines of each experiment in registry order, the mean of all scores last."""
    order = spark.createDataFrame([(i, r.benchmark, r.link) for i, r in enumerate(registry)], "ord int, name string, link string")
    scored = scores(scanned(spark, root, registry), rule_table(spark, registry), ("experiment",))
    links = scored.select("experiment").distinct().join(F.broadcast(order.where("link is not null")), F.lit(True))
    lines = scored.join(F.broadcast(order), F.col("benchmark") == F.col("name")).select("experiment", "ord", F.concat("benchmark", F.lit(": "), F.col("score").cast("string")).alias("line"), "score")
    lines = lines.unionByName(links.select("experiment", "ord", F.concat("name", F.lit(": "), "link").alias("line"), F.lit(None).cast("double").alias("score")))
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), "\n")  # a line for each rule
    return lines.groupBy("experiment").agg(F.concat(told, F.lit("\nAverage: "), one_decimal(F.avg("score")).cast("string")).alias("report"))


def rule_table(spark: SparkSession, registry: list[Report]) -> DataFrame:
    return spark.createDataFrame([(r.benchmark, r.pick, list(r.metrics), r.how) for r in registry if not r.link], RULES)


def suite_report(spark: SparkSession, root: str, name: Callable[[str], str], registry: list[Report], title: str = "") -> str:
    """'name: score' lines in registry order under a title, the mean of all scores last; what has no file is left out."""
    got = {r["benchmark"]: r["score"] for r in scores(read_reports(spark, root, name, registry), rule_table(spark, registry)).collect()}
    lines = [f"{r.benchmark}: {r.link or got[r.benchmark]}" for r in registry if r.link or r.benchmark in got]
    # As ``one_decimal`` rounds.
    mean = [f"Average: {Decimal(repr(sum(got.values()) / len(got))).quantize(Decimal('0.1'), ROUND_HALF_EVEN)}"] if got else []
    return "\n".join([title, "", *lines, *mean]).strip() if title else "\n".join([*lines, *mean])


def scores(long: DataFrame, rules: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, benchmark, score) by rule: the first or last row, the row of a number, or that of a split; the mean or sum of the named metrics.

    long: (benchmark, row, split, metric, value). Benchmarks without a report are left out.
    """
    w = Window.partitionBy(*by, "benchmark")
    rows = long.join(F.broadcast(rules), "benchmark").withColumn("last", F.max("row").over(w))
    numbered = F.col("pick").rlike("^[0-9]+$")
    wanted = (
        F.when(F.col("pick") == "first", F.col("row") == 0).when(F.col("pick") == "last", F.col("row") == F.col("last"))
        .when(numbered, F.col("row") == F.col("pick").try_cast("int")).otherwise(F.col("split") == F.col("pick"))
    )
    used = rows.where(wanted & F.array_contains("metrics", F.col("metric")))
    value = F.when(F.first("how") == "sum", F.sum("value")).otherwise(F.avg("value"))
    return used.groupBy(*by, "benchmark").agg(as_percent(value).alias("score"))


def overall(scored: DataFrame, needed: list[str], joint: tuple[str, str] | None = None) -> DataFrame:
    """The mean of the needed scores to one decimal, null if one is missing; two joint ones count as their rounded mean."""
    rest = [n for n in needed if not joint or n not in joint]
    parts = scored.where(F.col("benchmark").isin(needed))
    name = F.when(F.col("benchmark").isin(list(joint or ())), "joint").otherwise(F.col("benchmark"))
    each = parts.groupBy(name.alias("benchmark")).agg(F.when(F.first(name) == "joint", one_decimal(F.avg("score"))).otherwise(F.avg("score")).alias("score"), F.count("*").alias("n"))
    full = F.sum("n") == len(needed)
    return each.agg(F.when(full & (F.count("*") == len(rest) + bool(joint)), one_decimal(F.avg("score"))).alias("average"))


def mean_of_present(scored: DataFrame, names: list[str], key: str = "dataset", value: str = "score") -> DataFrame:
    """Scores of the listed names that are there, in list order (the last row of a name counts), with the mean of all."""
    listed = scored.sparkSession.createDataFrame([(i, n) for i, n in enumerate(names)], f"ord int, {key} string")
    found = scored.join(F.broadcast(listed), key)
    return found.crossJoin(F.broadcast(found.agg(F.format_string("%.2f", F.avg(value)).alias("mean"))))


def aligned(name: Column, width: int = 20) -> Column:
    return F.lpad(name, width, " ")


def markdown_report(scored: DataFrame, order: str = "ord", key: str = "dataset", value: str = "score", bold: bool = True) -> DataFrame:
    """One text: a line for each score, in order."""
    from millrace.functions.text import report_line

    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(key).alias("k"), F.col(value).cast("string").alias("v")))), lambda s: report_line(s["k"], s["v"], bold))
    return scored.agg(F.array_join(lines, "").alias("report"))

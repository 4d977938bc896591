"""Nested JSON as VARIANT values: every place of documents as rows, search for keys at any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import dropped, stored


def places(df: DataFrame, json: str | Column, keep: list[str], most: int | None = None) -> DataFrame:
    """The columns in ``keep``, depth, path, key, value (VARIANT as JSON text) of every field and list element, at any depth.

    path joins keys and places in lists by dots. A level of all documents is taken apart at a time, until there is none (or
    ``most``). Null documents and ones that aren't JSON have no rows; a field that is null has the value 'null'.
    """
    made = df.select(*keep, F.lit(0).alias("depth"), F.lit("").alias("path"), F.lit(None).cast("string").alias("key"), F.try_parse_json(F.col(json) if isinstance(json, str) else json).alias("v"))
    # Text between the levels: a table of VARIANT values would be read again as they were written, level by level.
    level, found, n = made.where("v is not null"), [], 0
    while most is None or n < most:
        # The variant itself goes by the name of its column alone: it can't be a key of a shuffle.
        level.createOrReplaceTempView("__level")
        own = ", ".join(f"`{c}`" for c in keep)
        name = "CASE WHEN e.key IS NULL THEN CAST(e.pos AS STRING) ELSE e.key END"
        sql = f"SELECT {own}, depth + 1 AS depth, CASE WHEN path = '' THEN '' ELSE path || '.' END || {name} AS path, e.key AS key, to_json(e.value) AS value FROM __level, LATERAL variant_explode(v) AS e"
        now = stored(df.sparkSession.sql(sql))
        n += 1
        if now.isEmpty():
            dropped(now)
            break
        found.append(now)
        inner = now.where(F.substring("value", 1, 1).isin("{", "["))
        level = inner.withColumn("v", F.parse_json("value")).select(*keep, "depth", "path", "key", "v")
    df.sparkSession.catalog.dropTempView("__level")
    if not found:
        return made.select(*keep, "depth", "path", "key", F.lit(None).cast("string").alias("value")).where("false")
    out = found[0]
    for each in found[1:]:
        out = out.unionByName(each)
    return out


def search(df: DataFrame, json: str | Column, key: str, keep: list[str]) -> DataFrame:
    """(keep, path, value): what a key stands for, wherever in a document it occurs."""
    return places(df, json, keep).where(F.col("key") == key).select(*keep, "path", "value")


def strings(df: DataFrame, json: str | Column, keep: list[str]) -> DataFrame:
    """(keep, path, value) of all values that hold no others, as text: strings without quotes, everything else as JSON writes it."""
    rows = places(df, json, keep).where(~F.substring("value", 1, 1).isin("{", "["))
    plain = F.when(F.startswith("value", F.lit('"')), F.try_variant_get(F.try_parse_json("value"), "$", "string")).otherwise(F.col("value"))
    return rows.select(*keep, "path", plain.alias("value"))

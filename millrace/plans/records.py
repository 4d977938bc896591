"""Queries that pack records, over conversations and three small pictures; each with its SQL."""

from __future__ import annotations

import base64

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import images
from millrace.operators import packing
from millrace.plans.queries import query


def _picture(shade: int, w: int, h: int) -> str:
    return base64.b64encode(images.encode(np.full((h, w, 3), shade, np.uint8))).decode()


#: Of 60 x 40 and 28 x 28 pixels: two tokens and one.
A, B = _picture(10, 60, 40), _picture(200, 28, 28)


def _raw(t) -> DataFrame:
    """Conversations with no image, one, three (one of them twice), a clip of twelve frames, or one that does not decode; some rows twice."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    rows = t("conversations").groupBy("conv_id").agg(turns.alias("t")).withColumn("kind", F.col("conv_id") % 5)
    shown = lambda *pairs: F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("content")) for n, c in pairs])
    pictures = (
        F.when(F.col("kind") == 1, shown(("a", A)))
        .when(F.col("kind") == 2, shown(("a", A), ("b", B), ("c", A)))
        .when(F.col("kind") == 3, shown(*[(f"f{k}", (A, B)[k % 2]) for k in range(12)]))
        .when(F.col("kind") == 4, shown(("x", "@@")))
    )
    raw = rows.select(
        F.col("conv_id").cast("string").alias("id"), pictures.alias("images"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("conversations"),
        F.when(F.col("kind") == 3, F.lit(10.0)).alias("fps"), F.lit(None).cast("int").alias("total_frames"), "conv_id",
    )
    return raw.unionByName(raw.where("conv_id % 10 = 1")).drop("conv_id")


def _shown(records: DataFrame) -> DataFrame:
    lens = F.array_join(F.array_sort(F.transform(F.map_entries("seq_lens"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))), ",")
    return records.select(
        "type", "id", "content", F.get("conversations", F.lit(0))["text"].alias("first_text"), F.when(F.col("type") == "conversation", F.size("conversations").cast("long")).alias("n_turns"),
        lens.alias("lens"), "max_pixels", "is_video",
    )


_ROWS = f"""
WITH c AS (SELECT conv_id, count(*) AS n_turns, arg_min(text, turn) AS first, coalesce(max(CASE WHEN k = 2 THEN text END), '') AS answer
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM conversations) GROUP BY conv_id),
k AS (SELECT *, conv_id % 5 AS kind FROM c UNION ALL SELECT *, conv_id % 5 AS kind FROM c WHERE conv_id % 10 = 1),
img AS (SELECT kind, ord, name, name || '#' || sha256(content) AS id, content, n FROM (VALUES (1, 0, 'a', '{A}', 2), (2, 0, 'a', '{A}', 2), (2, 1, 'b', '{B}', 1), (2, 2, 'c', '{A}', 2), (3, 0, 'f4', '{A}', 2), (3, 1, 'f9', '{B}', 1)) v(kind, ord, name, content, n)),
tags AS (SELECT kind, string_agg('<img>' || id || '</img>', '' ORDER BY ord) AS tags, string_agg(id || '=' || n::VARCHAR, ',' ORDER BY id || '=' || n::VARCHAR) AS lens, sum(length(content)) AS chars FROM img GROUP BY kind)"""


@query(f"""{_ROWS}
SELECT 'conversation' AS type, conv_id::VARCHAR AS id, NULL::VARCHAR AS content, coalesce(tags, '') || first AS first_text, n_turns, lens, NULL::INTEGER AS max_pixels, kind = 3 AS is_video
FROM k LEFT JOIN tags USING (kind) WHERE kind <> 4
UNION ALL SELECT DISTINCT 'image', img.id, content, NULL, NULL::BIGINT, NULL, NULL::INTEGER, NULL::BOOLEAN FROM img JOIN k USING (kind)""")
def pack_records(t):
    return _shown(packing.pack(_raw(t), resize=False))


@query(f"""{_ROWS},
g AS (SELECT * FROM k WHERE kind = 0 OR (kind <> 4 AND NOT contains(answer, '{packing.PLACEHOLDER}')))
SELECT 'conversation' AS type, conv_id::VARCHAR AS id, NULL::VARCHAR AS content, coalesce(tags, '') || first AS first_text, n_turns, conv_id::VARCHAR || '=' || chars::BIGINT::VARCHAR AS lens,
  CASE WHEN kind > 0 THEN 999 END::INTEGER AS max_pixels, kind = 3 AS is_video
FROM g LEFT JOIN tags USING (kind)
UNION ALL SELECT DISTINCT 'image', img.id, content, NULL, NULL::BIGINT, NULL, NULL::INTEGER, NULL::BOOLEAN FROM img JOIN g USING (kind)""")
def pack_holistic(t):
    return _shown(packing.pack_holistic(_raw(t), lambda c: F.length(c), max_pixels=999))


@query(f"{_ROWS} SELECT 'image does not decode' AS reject, count(*)::BIGINT AS count FROM k WHERE kind = 4 HAVING count(*) > 0")
def pack_rejected(t):
    return packing.rejected(_raw(t))

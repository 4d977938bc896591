"""The query catalogue: every relational operator on the standard tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import geometry, prompts, sequences, text
from millrace.operators import batching, inference, packing, relational, reports
from millrace.session import configured, shared_folder
from millrace.sources import archives, files, routed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configured(spark)
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


@query(f"""
SELECT conv_id, 'conversation' AS type, {_STRIP.format("string_agg(role || ': ' || text, chr(10) ORDER BY turn)")} AS text
FROM conversations GROUP BY conv_id""")
def pack_text_conversations(t):
    return packing.conversation_text(t("conversations"))


@query("""
SELECT conv_id, 'conversation' AS type, count(*)::BIGINT AS n_turns, arg_min(role, turn) AS first_role, arg_min(text, turn) AS first_text
FROM conversations GROUP BY conv_id""")
def pack_turn_struct(t):
    return t("conversations").groupBy("conv_id").agg(
        F.first(F.lit("conversation")).alias("type"), F.count("*").alias("n_turns"), F.min_by("role", "turn").alias("first_role"), F.min_by("text", "turn").alias("first_text")
    )


@query("""
SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>', chr(10) ORDER BY turn) AS rendered
FROM conversations GROUP BY conv_id""")
def chatml_render(t):
    turns = F.array_sort(F.collect_list(F.struct("turn", text.chat_turn(F.col("role"), F.col("text")).alias("s"))))
    return t("conversations").groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda x: x["s"]), "\n").alias("rendered"))


@query("""
WITH o AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT conv_id, (k // 2)::BIGINT AS i, text AS prompt, sha256(text) AS answer FROM o WHERE k % 2 = 0 AND k + 1 < n""")
def infer_pairs_stub(t):
    told = inference.answer_turns(t("conversations").select("conv_id", "turn", "text"), inference.stub_client, retry=inference.Retry(sleep=lambda s: None))
    return told.withColumn("i", F.col("i").cast("long"))


@query("""
WITH o AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
SELECT conv_id, count(*)::BIGINT AS n_turns FROM o GROUP BY conv_id HAVING NOT coalesce(bool_or(k = 2 AND contains(text, ' the ')), false)""")
def placeholder_guard(t):
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    rows = t("conversations").groupBy("conv_id").agg(turns.alias("t"))
    bad = F.coalesce(F.contains(F.get("t", F.lit(1))["text"], F.lit(" the ")), F.lit(False))
    return rows.where(~bad).select("conv_id", F.size("t").cast("long").alias("n_turns"))


_MARKUP_SQL = "text"
for _x in text.MARKUP:
    _MARKUP_SQL = f"replace({_MARKUP_SQL}, {'chr(10)' if _x == chr(10) else repr(_x)}, '')"


@query(f"SELECT doc_id, regexp_replace({_MARKUP_SQL}, '\\[Image\\]\\(.*?\\)', '', 'g') AS text FROM documents")
def markup_filter(t):
    return t("documents").select("doc_id", text.without_markup(F.col("text")).alias("text"))


@query(r"SELECT page_id, array_to_string(list_transform(string_split(html, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), '') AS text FROM pages")
def html_flatten(t):
    return t("pages").select("page_id", text.flat_html(F.col("html")).alias("text"))


@query()
def repetition_detect(t):
    return t("documents").select("doc_id", text.is_repetitive("text").alias("repetitive"))


@query(r"""
WITH w AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'see ```markdown' || chr(10) || text || ' ``` end' ELSE text END AS text FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(text, '(?s)```(.*?)```') THEN regexp_replace(regexp_extract(text, '(?s)```(.*?)```', 1), '^\s+|\s+$', '', 'g') ELSE text END AS text FROM w""")
def fenced_block(t):
    fenced = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("see ```markdown\n"), F.col("text"), F.lit(" ``` end"))).otherwise(F.col("text"))
    return t("documents").select("doc_id", text.fenced_block(fenced).alias("text"))


@query(r"""
WITH s AS (SELECT l_orderkey, l_linenumber, '[Image](' || l_discount::VARCHAR || ',' || l_tax::VARCHAR || ', 0.5,' || l_linenumber::VARCHAR || ') and [Image](1,2,3,-4) [Image](.25,-.5,1.5,7)' AS s FROM lineitem),
m AS (SELECT l_orderkey, l_linenumber, regexp_extract_all(s, '\[Image\]\(([-+]?\d*\.\d+|\d+),\s*([-+]?\d*\.\d+|\d+),\s*([-+]?\d*\.\d+|\d+),\s*([-+]?\d*\.\d+|\d+)\)', 1) AS a,
  regexp_extract_all(s, '\[Image\]\(([-+]?\d*\.\d+|\d+),\s*([-+]?\d*\.\d+|\d+),\s*([-+]?\d*\.\d+|\d+),\s*([-+]?\d*\.\d+|\d+)\)', 4) AS d FROM s)
SELECT l_orderkey, l_linenumber, (unnest(generate_series(1, len(a))) - 1)::INTEGER AS i, unnest(a)::DOUBLE AS x0, unnest(d)::DOUBLE AS y1 FROM m""")
def bbox_extract(t):
    said = F.concat(F.lit("[Image]("), F.col("l_discount").cast("string"), F.lit(","), F.col("l_tax").cast("string"), F.lit(", 0.5,"), F.col("l_linenumber").cast("string"), F.lit(") and [Image](1,2,3,-4) [Image](.25,-.5,1.5,7)"))
    return t("lineitem").select("l_orderkey", "l_linenumber", F.posexplode(text.boxes(said)).alias("i", "b")).select("l_orderkey", "l_linenumber", "i", "b.x0", "b.y1")


@query("SELECT l_orderkey, l_linenumber, trunc(l_discount * 640)::INTEGER AS x, trunc(l_tax * -480)::INTEGER AS y FROM lineitem")
def bbox_pixels(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", geometry.pixels(F.col("l_discount"), 640).alias("x"), geometry.pixels(F.col("l_tax"), -480).alias("y"))


@query("""
WITH p AS (SELECT page_id, url, string_split(url, '/') AS s FROM pages)
SELECT page_id, CASE WHEN starts_with(url, 'https:/') THEN substr(url, 8) ELSE url END AS relative, s[-1] AS name,
  array_to_string(s[greatest(len(s) - 1, 1):len(s)], '/') AS last_two, array_to_string(s[1:len(s) - 1], '/') AS folder FROM p""")
def path_parts(t):
    u = F.col("url")
    return t("pages").select("page_id", text.without_prefix(u, "https://").alias("relative"), text.basename(u).alias("name"), text.last_parts(u, 2).alias("last_two"), text.dirname(u).alias("folder"))


@query("SELECT page_id, url FROM pages WHERE ends_with(url, '1') OR ends_with(url, 'html') OR ends_with(url, '5')")
def suffix_scan(t):
    return t("pages").select("page_id", "url").where(text.ends_with_any(F.col("url"), ("1", "html", "5")))


@query(r"""
WITH u AS (SELECT page_id, unnest([url, '/data/' || page_id::VARCHAR || '.jpg', 'file:' || url, 'http://']) AS s FROM pages)
SELECT page_id, s, regexp_matches(s, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+') AS is_url FROM u""")
def url_or_path(t):
    said = F.array(F.col("url"), F.concat(F.lit("/data/"), F.col("page_id").cast("string"), F.lit(".jpg")), F.concat(F.lit("file:"), F.col("url")), F.lit("http://"))
    return t("pages").select("page_id", F.explode(said).alias("s")).select("page_id", "s", text.is_url(F.col("s")).alias("is_url"))


@query("SELECT p_partkey, trim(p_name, 'aeiou ') AS stripped, CASE WHEN ends_with(p_name, 'e') THEN left(p_name, length(p_name) - 1) ELSE p_name END AS cut FROM part")
def stop_strip(t):
    return t("part").select("p_partkey", text.strip_chars(F.col("p_name"), "aeiou ").alias("stripped"), text.strip_stop_token(F.col("p_name"), "e").alias("cut"))


@query("SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 + second(ts) + (microsecond(ts) % 1000000) / 1e6 AS seconds FROM events")
def time_to_seconds(t):
    return t("events").select("event_id", text.seconds(F.date_format("ts", "HH:mm:ss.SSSSSS")).alias("seconds"))


@query("""
SELECT o_orderkey, (o_custkey * 7)::BIGINT AS size, 'https://host/repo/resolve/main/data/' || o_orderkey::VARCHAR AS url, '/save/data/' || o_orderkey::VARCHAR AS saved
FROM orders WHERE o_orderstatus <> 'F'""")
def lfs_parse(t):
    head = F.when(F.col("o_orderstatus") != "F", F.lit("version https://git-lfs.github.com/spec/v1\noid sha256:0\nsize ")).otherwise(F.lit("no pointer, size "))
    rows = t("orders").withColumn("t", F.concat(head, (F.col("o_custkey") * 7).cast("string"), F.lit("\n")))
    url = text.resolve_url(F.lit("https://host/repo/"), F.concat(F.lit("data/"), F.col("o_orderkey").cast("string")))
    return rows.where(text.is_lfs_pointer(F.col("t"))).select("o_orderkey", text.lfs_size(F.col("t")).alias("size"), url.alias("url"), text.saved_path(url, "/save/").alias("saved"))


@query("SELECT p_partkey, 'data:image/jpeg;base64,' || base64(encode(repeat(p_name, 8))) AS uri FROM part")
def data_uri_b64(t):
    return t("part").select("p_partkey", text.data_uri(text.base64_text(F.encode(F.repeat("p_name", F.lit(8)), "UTF-8"))).alias("uri"))


@query("""
WITH i AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, i::BIGINT AS pos, (CASE WHEN i < (n // 7 + 1) * (n % 7) THEN i // (n // 7 + 1) ELSE n % 7 + (i - (n // 7 + 1) * (n % 7)) // (n // 7) END)::BIGINT AS rank FROM i""")
def dist_split(t):
    rows = t("orders").select("o_orderkey")
    placed = relational.positioned(rows, "o_orderkey").join(F.broadcast(rows.agg(F.count("*").alias("n"))), F.lit(True))
    return placed.select("o_orderkey", "pos", relational.block_rank(F.col("pos"), F.col("n"), 7).alias("rank"))


@query("SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) % 5)::BIGINT AS rank FROM orders")
def strided_split(t):
    return relational.positioned(t("orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", relational.stride_rank(F.col("pos"), 5).alias("rank"))


@query("""
WITH RECURSIVE f AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source) AS p FROM documents GROUP BY source),
s AS (SELECT greatest(sum(n) // 4, 1) AS per FROM f),
r AS (SELECT 0::BIGINT AS p, ''::VARCHAR AS source, 0::BIGINT AS b, 0::BIGINT AS next, 0::BIGINT AS size
  UNION ALL SELECT f.p, f.source, r.next, CASE WHEN r.size + f.n >= per THEN r.next + 1 ELSE r.next END, CASE WHEN r.size + f.n >= per THEN 0 ELSE r.size + f.n END
  FROM r JOIN f ON f.p = r.p + 1, s)
SELECT source AS file, least(b, 3)::INTEGER AS rank FROM r WHERE p > 0""")
def greedy_balance(t):
    return batching.balanced(t("documents").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("size")), 4)


@query("""
WITH o AS (SELECT user_id, event_type = 'click' AS hit, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
g AS (SELECT user_id, i, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS g FROM o WHERE hit)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY min(i))::BIGINT AS run, count(*)::BIGINT AS length FROM g GROUP BY user_id, g""")
def run_lengths(t):
    return relational.runs(t("events"), "user_id", ["ts", "event_id"], F.col("event_type") == "click")


@query("""
SELECT event_id, user_id, event_type FROM events WHERE event_type = 'signup' UNION ALL
SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type <> 'signup') WHERE n = 1""")
def dedup_first(t):
    return relational.first_of_each(t("events").select("event_id", "user_id", "event_type", "ts"), "user_id", ["ts", "event_id"], F.col("event_type") == "signup").drop("ts")


@query("""
WITH RECURSIVE o AS (SELECT l_orderkey, l_quantity AS y, l_partkey::VARCHAR AS w, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber, l_partkey) AS p FROM lineitem),
r AS (SELECT l_orderkey, p, y AS anchor, w AS text FROM o WHERE p = 1
  UNION ALL SELECT o.l_orderkey, o.p, CASE WHEN abs(o.y - r.anchor) < 10 THEN r.anchor ELSE o.y END, r.text || CASE WHEN abs(o.y - r.anchor) < 10 THEN ' ' ELSE chr(10) END || o.w
  FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.p = r.p + 1)
SELECT l_orderkey, arg_max(text, p) AS text FROM r GROUP BY l_orderkey""")
def ocr_lines(t):
    point = F.struct(F.col("l_quantity").alias("y"), F.col("l_linenumber").alias("x"), F.col("l_partkey").alias("pos"), F.col("l_partkey").cast("string").alias("text"))
    return t("lineitem").groupBy("l_orderkey").agg(F.collect_list(point).alias("p")).select("l_orderkey", sequences.lines_of_points(F.col("p")).alias("text"))


@query("""
WITH RECURSIVE o AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, count(*) OVER (PARTITION BY user_id) AS n FROM events),
f AS (SELECT DISTINCT user_id, CASE WHEN n / 10.0::DOUBLE > 8 / 2.0::DOUBLE THEN 10.0::DOUBLE * (9.0::DOUBLE / (n + 1)) ELSE 2.0::DOUBLE END AS fps FROM o),
r AS (SELECT user_id, 0::BIGINT AS p, 0.0::DOUBLE AS cur, 0::BIGINT AS kept, NULL::BIGINT AS event_id, false AS take FROM f
  UNION ALL SELECT o.user_id, o.p,
    CASE WHEN kept > 8 THEN cur WHEN cur + 1 / 10.0::DOUBLE >= 1 / fps THEN cur + 1 / 10.0::DOUBLE - 1 / fps ELSE cur + 1 / 10.0::DOUBLE END,
    CASE WHEN kept <= 8 AND cur + 1 / 10.0::DOUBLE >= 1 / fps THEN kept + 1 ELSE kept END, o.event_id, kept <= 8 AND cur + 1 / 10.0::DOUBLE >= 1 / fps
  FROM r JOIN o ON o.user_id = r.user_id AND o.p = r.p + 1 JOIN f ON f.user_id = r.user_id)
SELECT user_id, event_id FROM r WHERE take""")
def frame_sampler(t):
    frames = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda x: x["event_id"])
    rows = t("events").groupBy("user_id").agg(frames.alias("frames"))
    rate = sequences.effective_fps(2, F.lit(10.0), F.size("frames").cast("double"), 8)
    return rows.select("user_id", F.explode(sequences.sampled_frames(F.col("frames"), F.lit(10.0), rate, 8)).alias("event_id"))


@query("""
WITH o AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, event_id FROM o WHERE n <= 8 OR (p % (n // 8) = 0 AND p // (n // 8) < 8)""")
def stride_sampler(t):
    frames = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda x: x["event_id"])
    rows = t("events").groupBy("user_id").agg(frames.alias("frames"))
    return rows.select("user_id", F.explode(sequences.strided(F.col("frames"), 8)).alias("event_id"))


@query("""
WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT user_id, i::INTEGER AS i, round_even(i * ((n - 1) / 9.0::DOUBLE), 0)::BIGINT AS place FROM n, range(10) r(i)""")
def linspace_index(t):
    rows = t("events").groupBy("user_id").agg(F.count("*").cast("double").alias("n"))
    return rows.select("user_id", F.posexplode(sequences.even_places(F.col("n"), F.lit(10))).alias("i", "place"))


@query("""
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def anti_existing(t):
    path = lambda c: F.concat(F.lit("/raw/part/"), F.col("doc_id").cast("string"))
    done = t("labels").select(F.concat(F.lit("/out/part/"), F.col("doc_id").cast("string")).alias("path"))
    return relational.remaining(t("documents").select("doc_id", path("doc_id").alias("path")), done).select("doc_id")


@query("""
WITH p AS (SELECT n_name AS dataset, n_nationkey::DOUBLE AS score, list_position(['JAPAN', 'NATION_3', 'NATION_1', 'CHINA', 'NATION_7', 'FRANCE'], n_name) AS o FROM nation)
SELECT (o - 1)::INTEGER AS ord, dataset, score, printf('%.2f', (SELECT avg(score) FROM p WHERE o > 0)) AS mean FROM p WHERE o > 0""")
def semi_datasets(t):
    rows = t("nation").select(F.col("n_name").alias("dataset"), F.col("n_nationkey").cast("double").alias("score"))
    return reports.mean_of_present(rows, ["JAPAN", "NATION_3", "NATION_1", "CHINA", "NATION_7", "FRANCE"]).select("ord", "dataset", "score", "mean")


@query("SELECT doc_id, source FROM documents WHERE lang = 'fr' UNION ALL SELECT doc_id, source FROM documents WHERE n_chars < 1000 UNION ALL SELECT doc_id, source FROM documents WHERE lang = 'fr'")
def merge_lists(t):
    d = t("documents").select("doc_id", "source", "lang", "n_chars")
    fr = d.where("lang = 'fr'").select("doc_id", "source")
    return relational.bag_union(fr, d.where("n_chars < 1000").select("doc_id", "source"), fr)


@query("SELECT source AS file, count(*)::BIGINT AS n, sum(count(*)) OVER ()::BIGINT AS total FROM documents GROUP BY source")
def file_row_counts(t):
    counts = t("documents").groupBy(F.col("source").alias("file")).agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total"))))


@query("SELECT event_type AS key, string_agg(user_id::VARCHAR || '=' || event_id::VARCHAR, ',' ORDER BY user_id, event_id) AS vals FROM events GROUP BY event_type")
def status_merge(t):
    said = F.create_map(F.col("event_type"), F.concat(F.col("user_id").cast("string"), F.lit("="), F.col("event_id").cast("string")))
    rows = t("events").select(F.struct("user_id", "event_id").alias("rank"), said.alias("status"))
    return relational.merged_status(rows, "rank", "status").select("key", F.array_join("values", ",").alias("vals"))


@query("""
WITH u AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT label, i::INTEGER AS i, round(avg(v), 6) AS v FROM u GROUP BY label, i""")
def model_soup(t):
    mean = relational.soup(t("embeddings").select(F.col("vec_id").alias("model"), F.col("label").alias("key"), F.col("embedding").alias("values")))
    return mean.select(F.col("key").alias("label"), F.posexplode("values").alias("i", "v")).select("label", "i", F.round("v", 6).alias("v"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def force_string(t):
    return t("events").select("event_id", F.element_at(text.values_as_strings(F.col("props")), "k").alias("k"))


_SIZE = "SELECT o_orderkey, (o_orderkey * 37) % 1900 + 50 AS w, (o_orderkey * 91) % 1300 + 40 AS h FROM orders"


def _sizes(t) -> DataFrame:
    k = F.col("o_orderkey")
    return t("orders").select("o_orderkey", ((k * 37) % 1900 + 50).alias("w"), ((k * 91) % 1300 + 40).alias("h"))


def _values(rows) -> str:
    return ", ".join(f"({o}, {w}, {h})" for o, _, w, h in rows)


@query(f"""
WITH s AS ({_SIZE}), c AS (SELECT ord, cw, ch, cw::DOUBLE / ch AS ratio FROM (VALUES {_values(geometry.candidate_sizes())}) v(ord, cw, ch)),
a AS (SELECT o_orderkey, w, h, c.*, first_value(ratio) OVER (PARTITION BY o_orderkey ORDER BY abs(ratio - w::DOUBLE / h), ord) AS best FROM s, c),
b AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(cw * ch - w * h), ord) AS n FROM a WHERE ratio = best)
SELECT o_orderkey, cw AS width, ch AS height FROM b WHERE n = 1""")
def best_image_size(t):
    return _sizes(t).withColumn("b", geometry.best_size(F.col("w"), F.col("h"))).select("o_orderkey", F.col("b.w").alias("width"), F.col("b.h").alias("height"))


@query(f"""
WITH s AS ({_SIZE}), c AS (SELECT ord, cw, ch, cw::DOUBLE / ch AS ratio FROM (VALUES {_values(geometry.candidate_sizes(12, 1))}) v(ord, cw, ch)),
a AS (SELECT o_orderkey, (w + 335) // 336 AS ws, (h + 335) // 336 AS hs, c.*, first_value(ratio) OVER (PARTITION BY o_orderkey ORDER BY abs(ratio - w::DOUBLE / h), ord) AS best
  FROM s JOIN c ON (w < h AND ratio <= w::DOUBLE / h) OR (w > h AND ratio >= w::DOUBLE / h) OR w = h),
b AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(cw * ch - ws * hs), ord) AS n FROM a WHERE ratio = best)
SELECT o_orderkey, cw AS x, ch AS y FROM b WHERE n = 1""")
def best_slices(t):
    slices = lambda d: F.floor((F.col(d) + 335) / 336).cast("int")
    rows = _sizes(t).withColumn("b", geometry.best_slices(slices("w"), slices("h"), F.col("w") / F.col("h")))
    return rows.where("b.w is not null").select("o_orderkey", F.col("b.w").alias("x"), F.col("b.h").alias("y"))


@query(f"""
WITH s AS ({_SIZE}), p AS (SELECT o_orderkey, w, h, CASE WHEN 3 > 1 THEN floor((w - 224) / 2.0)::INTEGER END AS sx, floor((h - 224) / 1.0)::INTEGER AS sy FROM s WHERE w > 448 AND h > 448),
x AS (SELECT o_orderkey, h, sy, unnest(range(0, (w - 224 + 1)::BIGINT, sx::BIGINT)) AS x FROM p)
SELECT o_orderkey, x::INTEGER AS x, unnest(range(0, (h - 224 + 1)::BIGINT, sy::BIGINT))::INTEGER AS y FROM x""")
def strides_windows(t):
    rows = _sizes(t).where("w > 448 and h > 448").select("o_orderkey", F.col("w").cast("int").alias("w"), F.col("h").cast("int").alias("h"))
    by = lambda d, n: geometry.stride(F.col(d), F.lit(224), F.lit(n))
    xs = rows.select("o_orderkey", "h", F.explode(geometry.origins(F.col("w"), F.lit(224), by("w", 3))).alias("x"))
    return xs.select("o_orderkey", "x", F.explode(geometry.origins(F.col("h"), F.lit(224), by("h", 2))).alias("y"))


@query(f"""
WITH s AS ({_SIZE})
SELECT o_orderkey, CASE WHEN w * h <= 200000 THEN w ELSE trunc(w / pow(w * h / 200000.0::DOUBLE, 0.5))::BIGINT END AS w,
  CASE WHEN w * h <= 200000 THEN h ELSE trunc(h / pow(w * h / 200000.0::DOUBLE, 0.5))::BIGINT END AS h FROM s""")
def resize_max(t):
    rows = _sizes(t).withColumn("b", geometry.limited(F.col("w"), F.col("h"), 200_000))
    return rows.select("o_orderkey", F.col("b.w").cast("long").alias("w"), F.col("b.h").cast("long").alias("h"))


@query(f"""
WITH s AS ({_SIZE}), m AS (SELECT *, least(w, h) AS m FROM s)
SELECT o_orderkey, ((w - m) // 2)::INTEGER AS l, ((h - m) // 2)::INTEGER AS t, ((w + m) // 2)::INTEGER AS r, ((h + m) // 2)::INTEGER AS b FROM m""")
def center_crop(t):
    rows = _sizes(t).withColumn("x", geometry.square_crop(F.col("w"), F.col("h")))
    return rows.select("o_orderkey", *[F.col(f"x.{a}").alias(b) for a, b in (("left", "l"), ("top", "t"), ("right", "r"), ("bottom", "b"))])


@query("SELECT l_orderkey, l_linenumber, (((l_linenumber - 1) % 3) * 320)::INTEGER AS x, (((l_linenumber - 1) // 3) * 240)::BIGINT AS y FROM lineitem")
def grid_offsets(t):
    at = geometry.grid_offset(F.col("l_linenumber") - 1, 3, F.lit(320), F.lit(240))
    return t("lineitem").withColumn("o", at).select("l_orderkey", "l_linenumber", "o.x", "o.y")


@query(f"""
WITH s AS ({_SIZE}) SELECT o_orderkey, trunc(w / 28.0::DOUBLE * h / 28)::INTEGER AS image_tokens, (((o_orderkey % 5 + 1) * (w // 14) * (h // 14)) // 4)::BIGINT AS video_tokens FROM s""")
def token_len(t):
    side = lambda d: F.floor(F.col(d) / 14)
    grid = F.array((F.col("o_orderkey") % 5 + 1), side("w"), side("h"))
    return _sizes(t).select("o_orderkey", geometry.image_tokens(F.col("w"), F.col("h")).alias("image_tokens"), geometry.video_tokens(grid).alias("video_tokens"))


@query("""
WITH i AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT (i // 400)::BIGINT AS shard, count(*)::BIGINT AS files, min(o_orderkey) AS first, (any_value(n) // 400 + 1)::BIGINT AS shards FROM i GROUP BY i // 400""")
def shard_files(t):
    rows = t("orders").select("o_orderkey")
    placed = relational.positioned(rows, "o_orderkey").groupBy(relational.file_shards(F.col("pos")).alias("shard"))
    shards = placed.agg(F.count("*").alias("files"), F.min("o_orderkey").alias("first"))
    return shards.join(F.broadcast(rows.agg(relational.shard_count(F.count("*")).alias("shards"))), F.lit(True))


@query("""
WITH RECURSIVE o AS (SELECT source, doc_id, n_chars AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS p FROM documents),
r AS (SELECT source, doc_id, p, 0::BIGINT AS batch, n AS held FROM o WHERE p = 1
  UNION ALL SELECT o.source, o.doc_id, o.p, CASE WHEN held > 0 AND held + n > 32768 THEN batch + 1 ELSE batch END, CASE WHEN held > 0 AND held + n > 32768 THEN n ELSE held + n END
  FROM r JOIN o ON o.source = r.source AND o.p = r.p + 1)
SELECT source, doc_id, batch FROM r""")
def token_pack(t):
    return packing.packed_batches(t("documents"), "source", "doc_id", "n_chars")


@query("""
WITH RECURSIVE o AS (SELECT doc_id, n_chars AS n, row_number() OVER (ORDER BY doc_id) AS p FROM documents),
r AS (SELECT doc_id, p, 0::BIGINT AS batch, n AS held FROM o WHERE p = 1
  UNION ALL SELECT o.doc_id, o.p, CASE WHEN held > 0 AND held + n > 32768 THEN batch + 1 ELSE batch END, CASE WHEN held > 0 AND held + n > 32768 THEN n ELSE held + n END FROM r JOIN o ON o.p = r.p + 1)
SELECT 'all' AS shard, doc_id, batch FROM r""")
def token_pack_one_key(t):
    return batching.packed(t("documents").withColumn("shard", F.lit("all")), ["shard"], ["doc_id"], "n_chars", block=256)


@query("""
WITH RECURSIVE o AS (SELECT c_custkey, c_acctbal AS y, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS p FROM customer),
r AS (SELECT c_custkey, p, y AS anchor, 0::BIGINT AS line FROM o WHERE p = 1
  UNION ALL SELECT o.c_custkey, o.p, CASE WHEN o.y - anchor < 10 THEN anchor ELSE o.y END, CASE WHEN o.y - anchor < 10 THEN line ELSE line + 1 END FROM r JOIN o ON o.p = r.p + 1)
SELECT c_custkey, line FROM r""")
def ocr_lines_one_page(t):
    return batching.lines(t("customer").select(F.lit(1).alias("page"), "c_custkey", "c_acctbal"), ["page"], "c_acctbal", ["c_custkey"], block=256).select("c_custkey", "line")


@query("""
WITH o AS (SELECT event_type = 'click' AS hit, row_number() OVER (ORDER BY ts, event_id) AS i FROM events),
g AS (SELECT i, i - row_number() OVER (ORDER BY i) AS g FROM o WHERE hit)
SELECT row_number() OVER (ORDER BY min(i))::BIGINT AS run, count(*)::BIGINT AS length FROM g GROUP BY g""")
def run_lengths_one_key(t):
    return batching.runs(t("events").withColumn("all", F.lit(1)), ["all"], ["ts", "event_id"], F.col("event_type") == "click").drop("all")


_PROMPTS = ", ".join("'" + p + "'" for p in prompts.PROMPTS["ocr"])


@query(f"SELECT doc_id, [{_PROMPTS}][(doc_id % {len(prompts.PROMPTS['ocr'])}) + 1] AS prompt FROM documents")
def prompt_pick(t):
    return t("documents").select("doc_id", prompts.pick(F.col("doc_id"), "ocr").alias("prompt"))


@query("""
SELECT p_partkey, d::INTEGER AS degrees, CASE WHEN d = 0 THEN p_name ELSE p_name || '#' || sha256(d::VARCHAR) END AS name FROM part, (VALUES (0), (90), (180), (270)) v(d)""")
def rotate_fanout(t):
    rows = t("part").select("p_partkey", F.col("p_name").alias("name"), F.lit(None).cast("string").alias("content"))
    return packing.rotated(rows, "name", "content").select("p_partkey", "degrees", "name")


_REPORT = """
WITH long AS (SELECT r_name AS benchmark, n_nationkey, n_name AS split, (row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) - 1) AS row, n_nationkey / 8.0 AS value FROM nation JOIN region ON n_regionkey = r_regionkey),
x AS (SELECT benchmark, value, (benchmark IN (SELECT r_name FROM region WHERE r_regionkey % 2 = 0) AND row = 0) OR (benchmark IN (SELECT r_name FROM region WHERE r_regionkey % 2 = 1) AND row = (SELECT max(row) FROM long m WHERE m.benchmark = long.benchmark)) AS used FROM long),
scored AS (SELECT benchmark, round_even(CASE WHEN value < 1 THEN value * 100 ELSE value END, 1) AS score FROM x WHERE used)"""


def _scored(t) -> DataFrame:
    from pyspark.sql import Window

    rows = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    place = (F.row_number().over(Window.partitionBy("r_name").orderBy("n_nationkey")) - 1).alias("row")
    long = rows.select(F.col("r_name").alias("benchmark"), place, F.col("n_name").alias("split"), F.lit("acc").alias("metric"), (F.col("n_nationkey") / 8.0).alias("value"))
    rules = t("region").select(F.col("r_name").alias("benchmark"), F.when(F.col("r_regionkey") % 2 == 0, "first").otherwise("last").alias("pick"), F.array(F.lit("acc")).alias("metrics"), F.lit("mean").alias("how"))
    return reports.scores(long, rules)


@query(f"{_REPORT} SELECT benchmark, score FROM scored")
def eval_pick(t):
    return _scored(t)


@query(f"{_REPORT} SELECT round_even(avg(score), 1) AS average FROM scored")
def overall_score(t):
    return reports.overall(_scored(t), ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])


@query("""
WITH n AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment)
SELECT c_mktsegment, trunc(n * 0.03::DOUBLE)::INTEGER AS warmup, (n - trunc(n * 0.03::DOUBLE))::BIGINT AS decay FROM n""")
def lr_schedule(t):
    rows = t("customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return rows.withColumn("s", geometry.warmup_and_decay(F.col("n"))).select("c_mktsegment", "s.warmup", "s.decay")


@query("""
WITH n AS (SELECT doc_id, doc_id % 4 + 1 AS n FROM documents)
SELECT doc_id, i::INTEGER AS i, doc_id::VARCHAR || '_' || i::VARCHAR AS image, (SELECT string_agg('<img>' || doc_id::VARCHAR || '_' || j::VARCHAR || '</img>', '' ORDER BY j) FROM range(n) r(j)) AS tags
FROM n, range(4) q(i) WHERE i < n""")
def image_record_explode(t):
    ids = F.transform(F.sequence(F.lit(0), (F.col("doc_id") % 4).cast("int")), lambda i: F.concat_ws("_", F.col("doc_id").cast("string"), i.cast("string")))
    rows = t("documents").select("doc_id", ids.alias("ids"))
    return rows.select("doc_id", F.posexplode("ids").alias("i", "image"), text.image_tags(F.col("ids")).alias("tags"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def jsonl_roundtrip(t):
    rows = t("conversations")
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/jsonl-roundtrip-{uuid.uuid4().hex}"
    files.write_json_lines(rows, path)
    return files.json_lines(spark, path, "conv_id long, turn long, role string, text string", strict=True).drop("file")



def _fresh(t, name: str) -> str:
    """A folder of its own among those that all executors share."""
    return f"{shared_folder(t('region').sparkSession)}/{name}-{uuid.uuid4().hex}"


@query("SELECT conv_id, turn, role, text, 'part' || conv_id % 7 || '/turns.jsonl' AS file FROM conversations")
def routed_roundtrip(t):
    rows, root = t("conversations"), _fresh(t, "routed")
    spark = rows.sparkSession
    path = F.concat(F.lit("part"), (F.col("conv_id") % 7).cast("string"), F.lit("/turns.jsonl"))
    # Half of the files are there when the second run begins, which leaves them as they are.
    for some in (rows.where("conv_id % 7 < 3"), rows):
        routed.write_files(some.withColumn("path", path), root, order=("conv_id", "turn"))
    back = files.json_lines(spark, root, "conv_id long, turn long, role string, text string", strict=True)
    return back.withColumn("file", F.array_join(F.slice(F.split("file", "/"), -2, 2), "/"))


@query("""
SELECT 'part' || conv_id % 7 || '/turns.jsonl' AS path, count(*)::BIGINT AS rows FROM conversations GROUP BY 1""")
def routed_manifest(t):
    rows, root = t("conversations"), _fresh(t, "manifest")
    path = F.concat(F.lit("part"), (F.col("conv_id") % 7).cast("string"), F.lit("/turns.jsonl"))
    routed.write_files(rows.withColumn("path", path), root, order=("conv_id", "turn"))
    return routed.manifests(rows.sparkSession, root).select("path", "rows")


@query("""
SELECT 'pages' || page_id % 3 || '.zip' AS archive, page_id::VARCHAR || '.html' AS member, octet_length(encode(html))::BIGINT AS size, sha256(html) AS sha256 FROM pages
WHERE ends_with(page_id::VARCHAR || '.html', '7.html')""")
def archive_members(t):
    pages, root = t("pages"), _fresh(t, "archives")
    spark = pages.sparkSession
    rows = pages.select(F.concat(F.lit("pages"), (F.col("page_id") % 3).cast("string"), F.lit(".zip")).alias("archive"), F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("member"), F.encode("html", "UTF-8").alias("content"))
    archives.write_zips(rows, root)
    spark.dataSource.register(archives.Archives)
    read = spark.read.format("archive").options(kind="zip", suffixes="7.html", splitBytes=1 << 16).load(root)
    return read.select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "member", "size", F.sha2("content", 256).alias("sha256"))


_SUITE = [
    reports.Report("last", "_acc.csv", pick="last"), reports.Report("named", "_acc.csv", pick="NATION_7"), reports.Report("both", "_acc.csv", pick="first", metrics=("Overall", "acc, all"), how="sum"),
    reports.Report("video", "_video.json", "json", metrics=("overall.all", "list.-1")), reports.Report("missing", "_none.csv"),
]


@query("""
WITH long AS (SELECT r_name AS experiment, n_name AS split, n_nationkey / 8.0::DOUBLE AS v, row_number() OVER w - 1 AS row, count(*) OVER (PARTITION BY r_name) AS n FROM nation JOIN region ON n_regionkey = r_regionkey
  WINDOW w AS (PARTITION BY r_name ORDER BY n_nationkey)),
x AS (SELECT experiment, 'last' AS benchmark, v AS s FROM long WHERE row = n - 1 UNION ALL SELECT experiment, 'named', v FROM long WHERE split = 'NATION_7' UNION ALL SELECT experiment, 'both', v + 2 * v FROM long WHERE row = 0
  UNION ALL SELECT r_name, 'video', (r_regionkey + 0.25::DOUBLE + r_regionkey * 10) / 2 FROM region)
SELECT experiment, benchmark, round_even(CASE WHEN s < 1 THEN s * 100 ELSE s END, 1) AS score FROM x""")
def suite_scores(t):
    root = _fresh(t, "reports")
    spark = t("region").sparkSession
    rows = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    v = F.col("n_nationkey") / 8.0
    line = F.concat_ws(",", F.col("n_name"), v.cast("string"), F.concat(F.lit('"'), (v * 2).cast("string"), F.lit('"')))
    table = rows.select(F.concat("r_name", F.lit("_acc.csv")).alias("path"), F.col("n_nationkey").alias("o"), line.alias("value"))
    head = t("region").select(F.concat("r_name", F.lit("_acc.csv")).alias("path"), F.lit(-1).alias("o"), F.lit('split,Overall,"acc, all"').alias("value"))
    whole = F.concat(F.lit('{"overall": {"all": "'), (F.col("r_regionkey") + 0.25).cast("string"), F.lit('%"}, "list": [1, '), (F.col("r_regionkey") * 10).cast("string"), F.lit("]}"))
    told = t("region").select(F.concat("r_name", F.lit("_video.json")).alias("path"), F.lit(0).alias("o"), whole.alias("value"))
    spark.dataSource.register(routed.RoutedLines)
    lines = table.unionByName(head).unionByName(told).repartition("path").sortWithinPartitions("path", "o").select("path", "value")
    lines.write.format("routed_lines").mode("append").option("path", root).save()
    return reports.scores(reports.scanned(spark, root, _SUITE), reports.rule_table(spark, _SUITE), ("experiment",))

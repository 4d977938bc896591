"""Queries for single functions and small operators, each through the function itself, with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import geometry, prompts, sequences, text
from millrace.operators import packing, relational, reports, views
from millrace.plans.queries import _SIZE, _sizes, query


def _string(c: str):
    return F.col(c).cast("string")


@query("""
WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/data/set/' ELSE '/data/settle/' END || page_id::VARCHAR AS p FROM pages)
SELECT page_id, CASE WHEN starts_with(p, '/data/set/') THEN substr(p, 11) ELSE p END AS relative FROM p""")
def path_prefix(t):
    path = F.concat(F.when(F.col("page_id") % 2 == 0, F.lit("/data/set/")).otherwise(F.lit("/data/settle/")), _string("page_id"))
    return t("pages").select("page_id", text.without_prefix(path, "/data/set").alias("relative"))


@query("SELECT p_partkey, i::INTEGER AS i, CASE i WHEN 0 THEN 0.5 ELSE 9.5 END::DOUBLE AS x0, CASE i WHEN 0 THEN p_size + 0.25 ELSE 6.5 END::DOUBLE AS y1 FROM part, range(2) r(i)")
def list_boxes(t):
    said = F.concat(F.lit("at [0.5, -1.25,3.0 , "), _string("p_size"), F.lit(".25] not [1, 2.0, 3.0, 4.0] but [ 9.5,8.5,7.5,6.5]"))
    return t("part").select("p_partkey", F.posexplode(text.boxes(said, text.LIST_BOX)).alias("i", "b")).select("p_partkey", "i", "b.x0", "b.y1")


@query("SELECT doc_id, coalesce((SELECT string_agg('<img_' || i || '></img_' || i || '>' || chr(10), '' ORDER BY i) FROM range(doc_id % 4) r(i)), '') AS marks FROM documents")
def image_placeholders(t):
    return t("documents").select("doc_id", text.image_placeholders(F.col("doc_id") % 4).alias("marks"))


@query("""
SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'text' ELSE 'image_url' END AS type, text, CASE WHEN role <> 'user' THEN 'u/' || turn::VARCHAR END AS image_url FROM conversations""")
def chat_messages(t):
    part = F.struct(F.when(F.col("role") == "user", "text").otherwise("image").alias("type"), F.col("text").alias("text"), F.concat(F.lit("u/"), _string("turn")).alias("image"))
    return t("conversations").select("conv_id", "turn", F.inline(sequences.chat_messages(F.array(part))))


@query("SELECT event_id, least(greatest(trunc((value - 20) * 2.5)::INTEGER, 0), 100) AS frame FROM events")
def frame_at(t):
    return t("events").select("event_id", text.frame_at(F.col("value") - 20, F.lit(2.5), F.lit(100)).alias("frame"))


@query(f"""
WITH s AS ({_SIZE}), k AS (SELECT *, o_orderkey % 4 + 1 AS ws, o_orderkey % 3 + 1 AS hs FROM s)
SELECT o_orderkey, CASE WHEN ws < hs THEN ws * 336 ELSE trunc(w::DOUBLE / h * (hs * 336)) END::INTEGER AS w, CASE WHEN ws < hs THEN trunc(h::DOUBLE / w * (ws * 336)) ELSE hs * 336 END::INTEGER AS h FROM k""")
def fitted_size(t):
    k = F.col("o_orderkey")
    return _sizes(t).withColumn("f", geometry.fitted(F.col("w"), F.col("h"), k % 4 + 1, k % 3 + 1, 336)).select("o_orderkey", "f.w", "f.h")


@query(f"WITH s AS ({_SIZE}) SELECT o_orderkey % 50 AS g, max(w) AS w, max(h) AS h FROM s GROUP BY o_orderkey % 50")
def extents(t):
    rows = _sizes(t).groupBy((F.col("o_orderkey") % 50).alias("g")).agg(F.collect_list(F.struct("w", "h")).alias("s"))
    return rows.withColumn("e", sequences.extents(F.col("s"))).select("g", "e.w", "e.h")


@query("SELECT doc_id::VARCHAR AS path, n_chars AS size FROM documents WHERE doc_id % 3 = 0 OR doc_id % 2 = 1")
def not_fetched(t):
    wanted = t("documents").select("doc_id", _string("doc_id").alias("path"), F.col("n_chars").alias("size"))
    present = wanted.where("doc_id % 3 <> 0").withColumn("size", F.col("size") + F.col("doc_id") % 2)
    return relational.not_fetched(wanted.drop("doc_id"), present)


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' ELSE source END AS folder, CASE lang WHEN 'de' THEN 'german' END AS alias FROM documents")
def looked_up(t):
    folder = relational.looked_up(F.col("lang"), {"en": "english", "fr": "french"}, F.col("source"))
    return t("documents").select("doc_id", folder.alias("folder"), relational.looked_up(F.col("lang"), {"de": "german"}).alias("alias"))


@query("""
WITH RECURSIVE o AS (SELECT l_orderkey, l_quantity AS y, l_partkey::VARCHAR AS w, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber, l_partkey) AS p FROM lineitem),
r AS (SELECT l_orderkey, p, y AS anchor, w AS text FROM o WHERE p = 1
  UNION ALL SELECT o.l_orderkey, o.p, CASE WHEN abs(o.y - r.anchor) < 10 THEN r.anchor ELSE o.y END, r.text || CASE WHEN abs(o.y - r.anchor) < 10 THEN ' ' ELSE chr(10) END || o.w
  FROM r JOIN o ON o.l_orderkey = r.l_orderkey AND o.p = r.p + 1)
SELECT l_orderkey, arg_max(text, p) AS text FROM r GROUP BY l_orderkey""")
def ocr_reading(t):
    found = F.reverse(F.array_sort(F.collect_list(F.struct(F.col("l_quantity").alias("y"), F.col("l_linenumber").alias("x"), (-F.col("l_partkey")).alias("p")))))
    corner = lambda f: F.array(f["x"].cast("double"), f["y"].cast("double"))
    items = F.transform(found, lambda f: F.struct(F.array(corner(f), corner(f), corner(f), corner(f)).alias("box"), (-f["p"]).cast("string").alias("text")))
    return t("lineitem").groupBy("l_orderkey").agg(items.alias("items")).select("l_orderkey", sequences.ocr_text(F.col("items")).alias("text"))


@query(f"""
WITH s AS ({_SIZE}), n AS (SELECT *, greatest(28, round_even(w / 28.0::DOUBLE, 0)::INTEGER * 28) AS nw, greatest(28, round_even(h / 28.0::DOUBLE, 0)::INTEGER * 28) AS nh, sqrt(w * h / 125440.0::DOUBLE) AS b FROM s)
SELECT o_orderkey, CASE WHEN nw * nh <= 125440 THEN nw ELSE greatest(28, floor(w / b / 28)::INTEGER * 28) END::INTEGER AS w, CASE WHEN nw * nh <= 125440 THEN nh ELSE greatest(28, floor(h / b / 28)::INTEGER * 28) END::INTEGER AS h FROM n""")
def smart_size(t):
    return _sizes(t).withColumn("f", geometry.smart_size(F.col("w"), F.col("h"))).select("o_orderkey", "f.w", "f.h")


@query("SELECT n_nationkey * 0.5::DOUBLE AS score FROM nation WHERE n_name = 'FRANCE'")
def filtered_score(t):
    return reports.filtered(t("nation"), "n_name", "FRANCE", "n_nationkey", 0.5)


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders) WHERE pos >= 100 AND pos < 250")
def between_places(t):
    return relational.between(t("orders").select("o_orderkey"), 100, 250, "o_orderkey")


@query("""
WITH n AS (SELECT user_id, count(*)::DOUBLE AS n FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN n / 10 > 8 / 2.0::DOUBLE THEN 10 * (8 / n) ELSE 2.0::DOUBLE END AS fps FROM n""")
def fps_holistic(t):
    rows = t("events").groupBy("user_id").agg(F.count("*").cast("double").alias("n"))
    return rows.select("user_id", sequences.effective_fps(2, F.lit(10.0), F.col("n"), 8, holistic=True).alias("fps"))


@query("""
WITH o AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations)
SELECT conv_id, i::INTEGER AS i, CASE WHEN i < 2 THEN 'T' || i::VARCHAR ELSE '' END || text AS woven, CASE WHEN i = 0 THEN 'P' ELSE '' END || text AS prefixed FROM o""")
def tagged_turns(t):
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    rows = t("conversations").groupBy("conv_id").agg(turns.alias("t"))
    woven, prefixed = sequences.interleave(F.col("t"), F.array(F.lit("T0"), F.lit("T1"))), sequences.prepend_to_first(F.col("t"), F.lit("P"))
    return rows.select("conv_id", F.posexplode(F.arrays_zip(woven.alias("a"), prefixed.alias("b"))).alias("i", "z")).select("conv_id", "i", F.col("z.a.text").alias("woven"), F.col("z.b.text").alias("prefixed"))


@query("""
SELECT n_nationkey, '**' || n_name || '**: ' || n_regionkey || chr(10) AS line, n_nationkey::BIGINT * 10 AS tail, n_nationkey + 0.5::DOUBLE AS share, sha256(n_name) AS key FROM nation""")
def report_pieces(t):
    n = _string("n_nationkey")
    log = F.concat(F.lit("start\n  "), n, F.lit("0it [00:01, 3it/s]\n"))
    return t("nation").select(
        "n_nationkey", text.report_line(F.col("n_name"), _string("n_regionkey"), True).alias("line"), text.tail_number(log).alias("tail"),
        text.percent(F.concat(n, F.lit(".5%"))).alias("share"), text.content_key(F.encode("n_name", "UTF-8")).alias("key"),
    )


@query("""
SELECT source AS file, doc_id::VARCHAR AS id, 'conversation' AS type, NULL::VARCHAR AS content FROM documents UNION ALL SELECT DISTINCT source, source, 'image', 'dummy' FROM documents""")
def dummy_rows(t):
    rows = t("documents").select(F.col("source").alias("file"), _string("doc_id").alias("id"), F.lit("conversation").alias("type"), F.lit(None).cast("string").alias("content"))
    return relational.with_constant_rows(rows, "file", "dummy")


@query("SELECT 'd/' || doc_id::VARCHAR AS stem, lang, source FROM documents WHERE doc_id % 6 = 0")
def stem_pairs(t):
    named = lambda end, by: t("documents").where(F.col("doc_id") % by == 0).withColumn("name", F.concat(F.lit("d/"), _string("doc_id"), F.lit(end)))
    return relational.by_stem(named(".jpg", 2).select("name", "lang"), named(".json", 3).select("name", "source")).select("stem", "lang", F.col("source_2").alias("source"))


@query("SELECT n_name AS root FROM nation WHERE n_regionkey < 3 UNION ALL SELECT r_name FROM region WHERE r_regionkey >= 3")
def root_folders(t):
    roots, some = t("region").select(F.col("r_name").alias("root"), "r_regionkey"), t("nation").where("n_regionkey < 3")
    folders = some.join(roots, F.col("n_regionkey") == F.col("r_regionkey")).select("root", F.col("n_name").alias("folder"))
    return relational.flattened_roots(roots.drop("r_regionkey"), folders)


@query("SELECT bool_and(o_totalprice > 0) AS all_finished FROM orders")
def all_finished(t):
    return relational.all_true(t("orders").select((F.col("o_totalprice") > 0).alias("f")), "f")


_LISTS = " ".join("WHEN '" + n + "' THEN [" + ", ".join("'" + p.replace("'", "''") + "'" for p in ps) + f"][(page_id % {len(ps)}) + 1]" for n, ps in prompts.PROMPTS.items())


@query(f"SELECT page_id, name, replace(CASE name {_LISTS} END, '{{}}', 'it') AS prompt FROM pages, (VALUES {', '.join(repr((n,))[:-2] + ')' for n in prompts.PROMPTS)}) v(name)")
def prompt_lists(t):
    every = F.array(*[F.struct(F.lit(n).alias("name"), prompts.pick(F.col("page_id"), n, F.lit("it")).alias("prompt")) for n in prompts.PROMPTS])
    return t("pages").select("page_id", F.inline(every))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, '/in/set' || (l_suppkey % 3)::VARCHAR || '/f' || l_partkey::VARCHAR || '.jsonl' AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN starts_with(p, '/in/set1/') THEN '/out/set1' || substr(p, 9) ELSE '/out/set1' || substr(p, 4) END AS path FROM r""")
def output_paths(t):
    path = F.concat(F.lit("/in/set"), (F.col("l_suppkey") % 3).cast("string"), F.lit("/f"), _string("l_partkey"), F.lit(".jsonl"))
    return t("lineitem").select("l_orderkey", "l_linenumber", packing.output_path(path, "/out/set1").alias("path"))


@query("""
SELECT conv_id, 'image size:N/A' || chr(10) || chr(10) || string_agg(role || ': ' || CASE WHEN role = 'assistant' THEN 'm' || turn::VARCHAR ELSE text END || chr(10), '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""")
def training_view(t):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    answer = lambda x: F.create_map(F.lit("m"), F.concat(F.lit("m"), x["turn"].cast("string")))
    told = F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"), answer(x).alias("responses")))
    rows = t("conversations").groupBy("conv_id").agg(told.alias("conversations"))
    return rows.select("conv_id", views.headed(F.lit(None).cast("struct<w: int, h: int>"), views.spoken(F.col("conversations"), "m")).alias("text"))


@query("""
WITH b AS (SELECT conv_id, string_agg(role || ': ' || text || chr(10), '' ORDER BY turn) AS s FROM conversations GROUP BY conv_id)
SELECT conv_id, s || CASE WHEN conv_id % 2 = 0 THEN chr(10) || 'Difficult Conversations:' || chr(10) || s ELSE '' END || CASE WHEN conv_id % 3 = 0 THEN chr(10) || 'Easy Conversations:' || chr(10) || s ELSE '' END AS text FROM b""")
def difficulty_view(t):
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    rows = t("conversations").groupBy("conv_id").agg(turns.alias("c"))
    some = lambda n: F.when(F.col("conv_id") % n == 0, F.col("c"))
    return rows.select("conv_id", views.with_difficulty(F.col("c"), some(2), some(3)).alias("text"))


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS pos, 'out/' || (row_number() OVER (ORDER BY o_orderkey) - 1) AS path FROM orders")
def positional_zip(t):
    files = t("orders").select("o_orderkey")
    named = F.concat(F.lit("out/"), F.lpad(F.col("pos").cast("string"), 9, "0"))
    outputs = relational.positioned(files, "o_orderkey").select(named.alias("path"))
    zipped = relational.zipped(files, outputs, ["o_orderkey"], ["path"])
    return zipped.select("o_orderkey", "pos", F.regexp_replace("path", "out/0*(?=[0-9])", "out/").alias("path"))


@query(f"""
WITH s AS ({_SIZE}) SELECT o_orderkey, w::DOUBLE / h <= 4 AND w::DOUBLE / h >= 1 / 4.0::DOUBLE AS fits,
  CASE WHEN w::DOUBLE / h <= 4 AND w::DOUBLE / h >= 1 / 4.0::DOUBLE THEN w WHEN w > h THEN 4 * h ELSE w END::BIGINT AS w,
  CASE WHEN w::DOUBLE / h <= 4 AND w::DOUBLE / h >= 1 / 4.0::DOUBLE THEN h WHEN w > h THEN h ELSE 4 * w END::BIGINT AS h FROM s""")
def aspect_guard(t):
    w, h = F.col("w"), F.col("h")
    return _sizes(t).select("o_orderkey", geometry.fits_aspect(w, h, 4).alias("fits"), geometry.within_aspect(w, h, 4).alias("b")).select("o_orderkey", "fits", F.col("b.w").cast("long").alias("w"), F.col("b.h").cast("long").alias("h"))


@query("SELECT page_id, string_split(url, '/')[-2] || string_split(string_split(url, '/')[-1], '_')[1] AS experiment FROM pages")
def experiment_id(t):
    return t("pages").select("page_id", text.experiment(F.col("url")).alias("experiment"))


@query("SELECT event_id, 'x' AS image_token_id, json_extract_string(props, '$.k') AS k, false AS has_size FROM events")
def config_patch(t):
    props = F.map_concat(text.values_as_strings(F.col("props")), F.create_map(F.lit("size"), F.lit("9")))
    rows = t("events").select("event_id", text.patched(props, {"image_token_id": "x"}, ("size",)).alias("m"))
    return rows.select("event_id", F.element_at("m", "image_token_id").alias("image_token_id"), F.element_at("m", "k").alias("k"), F.map_contains_key("m", "size").alias("has_size"))

"""Queries that write files below a folder of their own and read them again; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import images, text
from millrace.plans.queries import _fresh, query
from millrace.plans.records import A, B
from millrace.sources import archives, files, media, routed


def _lines(rows: DataFrame, root: str) -> None:
    """(path, value) as lines of named files."""
    rows.sparkSession.dataSource.register(routed.RoutedLines)
    rows.repartition("path").sortWithinPartitions("path", "value").select("path", "value").write.format("routed_lines").mode("append").option("path", root).save()


@query("""
SELECT lang || '/' || source || '.jsonl' AS name, sum(octet_length(encode(doc_id::VARCHAR)) + 1)::BIGINT AS size, contains(source, '1') AS removable
FROM documents WHERE lang IN ('en', 'fr') GROUP BY lang, source""")
def folder_listing(t):
    """Two folders listed as one, by suffix; which files a removal by name part would take."""
    root = _fresh(t, "listing")
    docs = t("documents").where("lang in ('en', 'fr')")
    rows = docs.select("lang", F.concat("source", F.lit(".jsonl")).alias("path"), F.col("doc_id").cast("string").alias("value"))
    for lang in ("en", "fr"):
        _lines(rows.where(F.col("lang") == lang).drop("lang"), f"{root}/{lang}")
        _lines(rows.where(F.col("lang") == lang).select(F.lit("other.txt").alias("path"), F.lit("x").alias("value")).distinct(), f"{root}/{lang}")
    spark = docs.sparkSession
    found = files.listing(spark, [f"{root}/en", f"{root}/fr"], "jsonl")
    gone = files.removable(found, "1").select("path", F.lit(True).alias("gone"))
    return found.join(gone, "path", "left").select(text.last_parts(F.col("path"), 2).alias("name"), "size", F.coalesce("gone", F.lit(False)).alias("removable"))


@query("SELECT '/data/' || p_partkey || '/' || p_name AS path FROM part")
def text_roundtrip(t):
    root = _fresh(t, "lines")
    rows = t("part").select(F.concat(F.lit("/data/"), F.col("p_partkey").cast("string"), F.lit("/"), "p_name").alias("value"))
    files.write_text(rows, root)
    return files.line_list(rows.sparkSession, root)


@query("""
SELECT r_name AS name, count(*)::BIGINT AS n, max(n_name) AS last FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def json_documents(t):
    """A JSON object in a file for each region, and all of them as rows of one file; both are read again."""
    root = _fresh(t, "objects")
    spark = t("region").sparkSession
    rows = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("name")).agg(F.count("*").alias("n"), F.max("n_name").alias("last"))
    _lines(rows.select(F.concat("name", F.lit(".json")).alias("path"), F.to_json(F.struct("*")).alias("value")), f"{root}/each")
    schema = "name string, n long, last string"
    files.write_single_json(rows, f"{root}/one")
    one = spark.read.schema(schema).json(f"{root}/one")
    return files.document(spark, f"{root}/each", schema).intersect(one)


@query("SELECT 'd' || doc_id % 2 || '.zip' AS archive, doc_id || '.txt' AS member, text FROM documents")
def zip_texts(t):
    """Texts of the members of zip archives."""
    root = _fresh(t, "zips")
    name = F.col("doc_id").cast("string")
    rows = t("documents").select(F.concat(F.lit("d"), (F.col("doc_id") % 2).cast("string"), F.lit(".zip")).alias("archive"), F.concat(name, F.lit(".txt")).alias("member"), F.encode("text", "UTF-8").alias("content"))
    archives.write_zips(rows, root)
    read = archives.as_text(archives.members(rows.sparkSession, root, "zip", ".txt"))
    return read.select(text.basename(F.col("archive")).alias("archive"), "member", "text")


@query("SELECT page_id, '/res/' || page_id || '.jpg' AS side, page_id || ': ' || url AS prompt FROM pages")
def side_files(t):
    path = F.concat(F.lit("/res/"), F.col("page_id").cast("string"), F.lit(".md"))
    return t("pages").select("page_id", files.side_file(path).alias("side"), text.prompt("%s: %s", F.col("page_id").cast("string"), F.col("url")).alias("prompt"))


@query(f"SELECT label || '/' || vec_id || '.png' AS name, CASE WHEN vec_id % 2 = 0 THEN '{A}' ELSE '{B}' END AS content FROM embeddings")
def image_roundtrip(t):
    root = _fresh(t, "images")
    pictures = t("embeddings").select(F.concat_ws("/", F.col("label").cast("string"), F.concat(F.col("vec_id").cast("string"), F.lit(".png"))).alias("name"), F.when(F.col("vec_id") % 2 == 0, A).otherwise(B).alias("content"))
    media.write_images(pictures, root)
    read = files.image_files(pictures.sparkSession, f"{root}/*")
    return read.where(images.intact("content")).select(text.last_parts(F.col("path"), 2).alias("name"), "content")


@query("SELECT 'rows: ' || count(*) AS path FROM orders UNION ALL SELECT 'fps: 2' UNION ALL SELECT 'first: ' || min(o_orderkey) FROM orders")
def run_manifest(t):
    root = _fresh(t, "manifest-lines")
    n, first = t("orders").agg(F.count("*"), F.min("o_orderkey")).first()
    spark = t("orders").sparkSession
    files.write_text(files.manifest(spark, {"rows": n, "fps": 2, "first": first}), root)
    return files.line_list(spark, root)

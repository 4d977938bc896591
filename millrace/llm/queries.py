"""The thin queries of this subpackage: standard tables in, contracted columns out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bagminhash, bpe, chat, decontaminate, fingerprint, license_scan, line_dedup, lloyd, prefix_trie, quality, secret_scan, suffix_tree, toxicity
from millrace.llm.common import bucket_of, small_batches, table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text by the 50k byte-level ranks, and the digest of what they decode to."""
    small_batches(spark)
    vocab, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents"), vocab, pattern)
    return bpe.decode(encoded, vocab, pattern).select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity scores of all whole documents."""
    small_batches(spark)
    docs, held_out = table(spark, sf_dir, "documents"), bucket_of("doc_id", 3) == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.scorer(spark, model)("text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all whole documents by word counts and by a suffix tree."""
    small_batches(spark)
    held_out = bucket_of("doc_id", 5) == 1
    scored = suffix_tree.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: The conversation that every run adds: its texts hold the template's own control strings.
HARD_CONVERSATION, HARD_TEXT = -7, "\\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered, and counts and digests of what is read back from the rendering."""
    small_batches(spark)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(HARD_CONVERSATION, i, r, HARD_TEXT) for i, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(hard)))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every whole document."""
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


def op6_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every whole document: five-word shingles, weighted Jaccard of 0.8 or more."""
    small_batches(spark)
    return bagminhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality scores of all whole documents."""
    small_batches(spark)
    held_out = bucket_of("doc_id", 5) == 0
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole document and its edited version, and their likenesses."""
    small_batches(spark)
    return fingerprint.versions(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of 13-word benchmark windows in every whole document."""
    small_batches(spark)
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines every whole document has, and which go because a similar line (0.8 or more of the token set) comes before."""
    docs = table(spark, sf_dir, "documents")
    gone = line_dedup.removals(docs).select(F.col("id").alias("gone_id"), F.col("h").alias("gone_h"), "removed")
    lines = docs.select("doc_id", line_dedup.text_hash("text").alias("h"), F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return lines.join(gone, (F.col("h") == F.col("gone_h")) & F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").select(
        "doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), F.array_join(removed.cast("array<string>"), ",").alias("removed_lines")
    )


def op11_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept vector's cluster after five rounds from 40 centroids, and the distances."""
    return lloyd.clusters(table(spark, sf_dir, "embeddings"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole document: base spans and those of the randomness tests."""
    return secret_scan.summary(secret_scan.scan(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with the totals of its subtree."""
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_suffix_tree": op3_suffix_tree,
    "op4_chat_format": op4_chat_format,
    "op5_license_scan": op5_license_scan,
    "op6_bagminhash": op6_bagminhash,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_fingerprint": op9_fingerprint,
    "op10_line_dedup": op10_line_dedup,
    "op11_lloyd": op11_lloyd,
    "op12_secret_scan": op12_secret_scan,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op11_lloyd": lloyd.lloyd_sql(),
    "op13_prefix_trie": prefix_trie.TRIE_SQL,
    "op4_chat_format": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
  SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, contains(role || text, '\') OR contains(text, '</turn>' || chr(10)) OR contains(role, ':' || chr(10)) AS hard,
    len(regexp_extract_all(role, '\\|###|:\n|</turn>')) + len(regexp_extract_all(text, '\\|###|:\n|</turn>')) AS marks FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(14 + length(role) + length(text) + CASE WHEN hard THEN marks ELSE 0 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op8_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS gram
  FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, p, n, item FROM places JOIN windows USING (n, gram)
), counted AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op10_line_dedup": r"""
WITH lined AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line, unnest(string_split(coalesce(text, ''), chr(10))) AS s
  FROM documents
), sets AS (
  SELECT doc_id, line, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(s), '[ \t\r\v\f]+'), lambda x: x <> ''))) AS t FROM lined
), classes AS (
  SELECT t, len(t) AS n, min((doc_id, line)) AS first, row_number() OVER (ORDER BY t) AS c FROM sets WHERE len(t) > 0 GROUP BY t
), tokens AS (SELECT c, n, unnest(t) AS k FROM classes
), counts AS (SELECT k, count(*) AS f FROM tokens GROUP BY k
), ranked AS (SELECT c, n, k, row_number() OVER (PARTITION BY c ORDER BY f, k) AS p FROM tokens JOIN counts USING (k)
), prefixes AS (SELECT c, n, k FROM ranked WHERE p <= n - (4 * n + 4) // 5 + 1
), pairs AS (
  SELECT DISTINCT a.c AS c1, b.c AS c2 FROM prefixes a JOIN prefixes b ON a.k = b.k AND a.c < b.c AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), links AS (
  SELECT x.first AS f1, y.first AS f2, x.c AS c1, y.c AS c2 FROM pairs JOIN classes x ON x.c = c1 JOIN classes y ON y.c = c2
  WHERE 9 * len(list_intersect(x.t, y.t)) >= 4 * (x.n + y.n)
), later AS (SELECT DISTINCT CASE WHEN f1 < f2 THEN c2 ELSE c1 END AS c FROM links
), gone AS (
  SELECT doc_id, count(DISTINCT line) AS n_removed, string_agg(DISTINCT line::VARCHAR, ',' ORDER BY line::VARCHAR) AS unordered, list_sort(list(DISTINCT line)) AS l
  FROM sets JOIN classes USING (t) WHERE c IN (SELECT c FROM later) OR first <> (doc_id, line) GROUP BY doc_id
)
SELECT doc_id, len(string_split(coalesce(text, ''), chr(10)))::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(array_to_string(l, ','), '') AS removed_lines
FROM documents LEFT JOIN gone USING (doc_id)
""",
}

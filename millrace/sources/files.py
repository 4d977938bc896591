"""Files as DataFrames: JSON lines, documents, reports, pointers, images; and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.operators.packing import image_map

RAW = "id string, base64_image string, base64_images string, conversations array<map<string,string>>, fps double, total_frames int"


def listing(spark: SparkSession, roots: str | list[str], suffixes: str | tuple[str, ...] = "tar") -> DataFrame:
    """(path, size) below the roots whose names end with a suffix, without their contents; sort by path for an order."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots).select("path", F.col("length").alias("size"))
    return found.where(text.ends_with_any(F.col("path"), suffixes))


def json_lines(spark: SparkSession, path: str | list[str], schema: str | T.StructType, strict: bool = False) -> DataFrame:
    """Rows of JSON lines with ``file``. Strict: a blank or broken line fails the job; otherwise blank lines are skipped."""
    lines = spark.read.text(path, recursiveFileLookup=True).select("value", text.plain_path(F.col("_metadata.file_path")).alias("file"))
    if not strict:
        lines = lines.where(F.trim("value") != "")
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    return lines.select(F.from_json(F.trim("value"), schema, options).alias("r"), "file").select("r.*", "file")


def raw_samples(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(id, images, conversations with responses by model, fps, total_frames, file) of raw sample files."""
    rows = json_lines(spark, path, RAW)
    known = ("role", "text")
    turn = lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text"), F.map_filter(m, lambda k, v: ~k.isin(*known)).alias("responses"))
    return rows.select("id", image_map(F.coalesce("base64_images", "base64_image")).alias("images"), F.transform("conversations", turn).alias("conversations"), "fps", "total_frames", "file")


def line_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path <> ''")


def document(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Whole-file JSON objects."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("r")).select("r.*")


def array_files(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Elements of JSON arrays, one file after another."""
    return spark.read.schema(schema).json(paths, multiLine=True)


def table_file(spark: SparkSession, path: str | list[str], schema: str | None = None, sep: str = ",") -> DataFrame:
    reader = spark.read.option("header", "true").option("sep", sep).option("multiLine", "true").option("escape", '"')
    return (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(path)


def indexed_value(table: DataFrame, index: str, column: str) -> DataFrame:
    """The value of a column in the row whose first column is the index."""
    return table.where(F.col(table.columns[0]) == index).select(F.col(column).alias("value"))


def pointers(spark: SparkSession, root: str, repo: str) -> DataFrame:
    """(size, url) of large-file pointers below a folder; what isn't UTF-8 text or a pointer is skipped."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where("length < 1024")
    body = F.try_validate_utf8(F.col("content").cast("string")) if hasattr(F, "try_validate_utf8") else F.decode("content", "UTF-8")
    inner = F.substring_index(F.col("path"), root.rstrip("/") + "/", -1)
    return files.withColumn("t", body).where(text.is_lfs_pointer(F.col("t"))).select(text.lfs_size(F.col("t")).alias("size"), text.resolve_url(F.lit(repo), inner).alias("url"))


def image_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, content in base64) of image files."""
    return spark.read.format("binaryFile").load(path).select("path", text.base64_text(F.col("content")).alias("content"))


def side_file(path, ending: str = "jpg", of: str = "md"):
    """The picture beside a result file: the name's every ``of`` gives way to the ending."""
    return F.replace(path, F.lit(of), F.lit(ending))


def write_json_lines(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, nulls written out; with ``by``, a folder for each value."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def write_text(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_single_json(df: DataFrame, path: str) -> None:
    """All rows, of which there are few, in one file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def manifest(spark: SparkSession, settings: dict[str, object]) -> DataFrame:
    """'key: value' lines of a run's settings."""
    return spark.createDataFrame([(f"{k}: {v}",) for k, v in settings.items()], "value string")


def bot_message(df: DataFrame, chat: str, kind: str = "markdown", column: str = "report") -> DataFrame:
    """The JSON payload that a chat hook takes; sending it is the caller's."""
    return df.select(F.to_json(F.struct(F.lit(chat).alias("chatid"), F.lit(kind).alias("msgtype"), F.struct(F.col(column).alias("content")).alias(kind))).alias("payload"))


def removable(files: DataFrame, part: str) -> DataFrame:
    """Files whose names contain a part anywhere ('all': every file); deleting them is the caller's."""
    return files if part == "all" else files.where(F.contains(text.basename(F.col("path")), F.lit(part)))

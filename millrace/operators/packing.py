"""Raw samples to training records: conversations, images, videos; then shards and token batches.

A row that cannot be packed is dropped and counted in ``rejected``; a file is never
lost for one of its rows. Image names are made unique by content, so a repeated
image is one record.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import geometry, images, sequences, text
from millrace.operators import relational

PLACEHOLDER = "<|image_pad|>"
#: What the record says that every file has, so that no file is without an image.
DUMMY = "This is the content of dummy image"
RECORD = (
    "type string, id string, content string, conversations array<struct<role: string, text: string>>, "
    "seq_lens map<string,int>, max_pixels int, is_video boolean"
)


def conversation_text(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", body: str = "text") -> DataFrame:
    """(id, type, text): a conversation's turns in order as 'role: text' lines, stripped."""
    turns = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(body, F.lit("")).alias("text"))))
    rows = df.groupBy(conv).agg(turns.alias("turns"))
    return rows.select(conv, F.lit("conversation").alias("type"), text.strip(sequences.joined_turns(F.col("turns"))).alias("text"))


def image_map(raw: Column) -> Column:
    """A JSON object of images as an array of (name, content), in its own order; repeated names keep the last content."""
    return F.transform(F.map_entries(F.from_json(raw, "map<string,string>")), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("content")))


def _turns(conversations: str = "conversations") -> Column:
    return F.transform(conversations, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def accepted(df: DataFrame, holistic: bool = False) -> DataFrame:
    """Adds ``bare`` (a row without images) and ``reject``: why a row is not packed as far as its pixels don't tell, or null."""
    none = F.size(F.coalesce("images", F.array())) <= 0
    first = F.get("images", F.lit(0))["content"].isNull()
    if holistic:
        bare = none | first
        reason = F.when(~bare & F.contains(F.get("conversations", F.lit(1))["text"], F.lit(PLACEHOLDER)), "placeholder in the answer")
    else:
        bare, reason = none, F.when(~none & first, "first image is null")
    return df.withColumn("bare", bare).withColumn("reject", reason)


def sampled_images(fps: float, max_frames: int, holistic: bool = False) -> Column:
    """A video's frames by time, any other row's images by stride."""
    n = F.coalesce(F.col("total_frames").cast("double"), F.size("images").cast("double"))
    rate = sequences.effective_fps(fps, F.col("fps"), n, max_frames, holistic)
    return F.when(F.col("fps").isNotNull(), sequences.sampled_frames(F.col("images"), F.col("fps"), rate, max_frames)).otherwise(sequences.strided(F.col("images"), max_frames))


def sampled_rows(df: DataFrame, fps: float, max_frames: int, max_pixels: int, resize: bool, holistic: bool = False) -> DataFrame:
    """(row, id, file, conversations, video, bare, reject, chosen) of every raw row; chosen: (i, name, n, content), in order.

    Each raw row stays a row, whatever its id and conversation; images are spread over tasks and put together again by row.
    """
    rows = accepted(df, holistic).withColumn("row", F.monotonically_increasing_id()).withColumn("conversations", _turns()).withColumn("video", F.col("fps").isNotNull())
    rows = rows.withColumn("file", F.col("file") if "file" in df.columns else F.lit(None).cast("string"))
    use = F.col("reject").isNull() & ~F.col("bare")
    each = rows.select("row", "id", "file", "conversations", "video", "bare", "reject", F.posexplode_outer(F.when(use, sampled_images(fps, max_frames, holistic))).alias("i", "image"))
    each = each.withColumn("content", F.col("image.content")).withColumn("ok", F.col("i").isNull() | images.intact("content")).withColumn("size", images.dimensions("content"))
    each = each.withColumn("to", geometry.smart_size(F.col("size.w"), F.col("size.h"), max_pixels))
    if resize:
        each = each.withColumn("content", F.when(F.col("ok") & F.col("i").isNotNull(), images.resized("content", F.coalesce("to.w", F.lit(1)), F.coalesce("to.h", F.lit(1)))))
    shown = F.when(F.col("i").isNotNull(), F.struct("i", text.unique_name(F.col("image.name"), F.col("image.content")).alias("name"), geometry.image_tokens(F.col("to.w"), F.col("to.h")).alias("n"), "content"))
    one = lambda c: F.first(c).alias(c)
    whole = each.withColumn("shown", shown).groupBy("row").agg(
        one("id"), one("file"), one("conversations"), one("video"), one("bare"), one("reject"), F.bool_and("ok").alias("ok"), F.array_sort(F.collect_list("shown")).alias("chosen")
    )
    return whole.withColumn("reject", F.coalesce("reject", F.when(~F.col("ok"), "image does not decode"))).drop("ok")


def _records(rows: DataFrame, told: Column, lens: Column, max_pixels: Column, video: Column, by_file: bool) -> DataFrame:
    """A conversation for each row, an image for each name (in each file, with ``by_file``); bare rows are their conversation alone."""
    kept = rows.where("reject is null")
    unless = lambda x: F.when(~F.col("bare"), x)
    talk = kept.select(
        F.lit("conversation").alias("type"), "id", F.lit(None).cast("string").alias("content"), F.when(F.col("bare"), F.col("conversations")).otherwise(told).alias("conversations"),
        unless(lens).cast("map<string,int>").alias("seq_lens"), unless(max_pixels).cast("int").alias("max_pixels"), F.coalesce(unless(video), F.lit(False)).alias("is_video"), "file", "row", F.lit(-1).alias("i"),
    )
    none = F.lit(None)
    shown = kept.select("file", "row", F.explode("chosen").alias("x")).select(
        F.lit("image").alias("type"), F.col("x.name").alias("id"), F.col("x.content").alias("content"), none.cast("array<struct<role: string, text: string>>").alias("conversations"),
        none.cast("map<string,int>").alias("seq_lens"), none.cast("int").alias("max_pixels"), none.cast("boolean").alias("is_video"), "file", "row", F.col("x.i").alias("i"),
    )
    shown = relational.first_of_each(shown, ["file", "id"] if by_file else "id", ["row", "i"], F.lit(False))
    both = talk.unionByName(shown)
    return both if by_file else both.drop("file", "row", "i")


def pack(
    df: DataFrame, fps: float = 2, max_frames: int = 64, max_pixels: int = geometry.MAX_PIXELS, interleave: bool = False, resize: bool = True, by_file: bool = False
) -> DataFrame:
    """(id, images, conversations, fps, total_frames) -> records: one conversation for each row, and one image for each sampled image.

    A row without images is its conversation alone; a clip of which no frame is sampled keeps its conversation, with empty seq_lens.
    """
    rows = sampled_rows(df, fps, max_frames, max_pixels, resize)
    tags = F.transform("chosen", lambda x: text.image_tags(F.array(x["name"])))
    told = sequences.interleave(F.col("conversations"), tags) if interleave else sequences.prepend_to_first(F.col("conversations"), F.array_join(tags, ""))
    lens = F.map_from_entries(F.array_distinct(F.transform("chosen", lambda x: F.struct(x["name"], x["n"]))))
    return _records(rows, told, lens, F.lit(None), F.col("video"), by_file)


def pack_holistic(df: DataFrame, tokens: Callable[[Column], Column], fps: float = 2, max_frames: int = 64, max_pixels: int = geometry.MAX_PIXELS, by_file: bool = False) -> DataFrame:
    """Records as of ``pack``, images at their own size; a row's length is one number, the sum of ``tokens`` over its images' contents.

    A row without images, or whose first image is null, is its conversation alone.
    """
    rows = sampled_rows(df, fps, max_frames, max_pixels, False, True)
    names = F.transform("chosen", lambda x: x["name"])
    total = F.aggregate("chosen", F.lit(0).cast("int"), lambda a, x: a + tokens(x["content"]).cast("int"))
    return _records(rows, sequences.prepend_to_first(F.col("conversations"), text.image_tags(names)), F.create_map(F.col("id"), total), F.lit(max_pixels), F.col("video"), by_file)


def rejected(df: DataFrame, holistic: bool = False, fps: float = 2, max_frames: int = 64) -> DataFrame:
    """How many rows are not packed, by reason."""
    return sampled_rows(df, fps, max_frames, geometry.MAX_PIXELS, False, holistic).where("reject is not null").groupBy("reject").count()


def processed(raw: DataFrame, out_root: str, holistic: Callable[[Column], Column] | None = None, **packing) -> DataFrame:
    """Records of whole files with the ``path`` they go to: packed, each image once in a file, and one dummy image for each file."""
    made = pack_holistic(raw, holistic, by_file=True, **packing) if holistic else pack(raw, by_file=True, **packing)
    every = raw.select("file").distinct().select(
        "file", F.lit("image").alias("type"), F.col("file").alias("id"), F.lit(DUMMY).alias("content"),
    )
    return made.drop("row", "i").unionByName(every, allowMissingColumns=True).withColumn("path", output_path(F.col("file"), out_root))


def write_processed(records: DataFrame, path: str) -> None:
    """JSON lines in a folder for each output path."""
    records.drop("file").write.mode("overwrite").partitionBy("path").option("ignoreNullFields", "false").json(path)


def process_folder(spark: SparkSession, raw_root: str, out_root: str, holistic: Callable[[Column], Column] | None = None, **packing) -> None:
    """Raw sample files below a folder to a file of records for each, named after it; a run that is repeated packs what is missing.

    A file is written whole or not at all (``routed.write_files``, with its manifest): conversations with their images in the
    order of the raw rows, then a dummy image.
    """
    from millrace.sources import files, routed

    raw = files.raw_samples(spark, raw_root)
    relative = F.substring(output_path(F.col("file"), out_root.rstrip("/")), len(out_root.rstrip("/")) + 2, 1 << 30)
    done = routed.written(spark, out_root).withColumnRenamed("path", "__done")
    todo = raw.join(done, relative == F.col("__done"), "left_anti")
    made = pack_holistic(todo, holistic, by_file=True, **packing) if holistic else pack(todo, by_file=True, **packing)
    last = (F.lit(1 << 62)).alias("row")
    every = todo.select("file").distinct().select("file", F.lit("image").alias("type"), F.col("file").alias("id"), F.lit(DUMMY).alias("content"), last)
    records = made.unionByName(every, allowMissingColumns=True).withColumn("path", relative)
    routed.write_files(records, out_root, order=("row", "i", "id"), leave=("file", "row", "i"))


def packed_batches(df: DataFrame, by: str, order: str, size: str, limit: int = 32_768) -> DataFrame:
    """(by, order, batch): items in order, none split, a batch closed before it would exceed the limit.

    Streams sorted rows, a key by one task: for keys of any size see ``batching.packed``. Null keys are one key.
    """
    kinds = dict(df.dtypes)

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        now, batch, held = None, 0, 0
        for part in parts:
            out = []
            for k, n in zip(part.column("__k").to_pylist(), part.column(size).to_pylist()):
                if k != now:
                    now, batch, held = k, 0, 0
                if held and held + n > limit:
                    batch, held = batch + 1, 0
                held += n
                out.append(batch)
            yield pa.RecordBatch.from_arrays([part.column(by), part.column(order), pa.array(out, pa.int64())], names=[by, order, "batch"])

    rows = df.select(by, order, F.coalesce(F.col(size), F.lit(0)).cast("long").alias(size), F.xxhash64(by).alias("__k")).repartition(by).sortWithinPartitions(by, order)
    return rows.mapInArrow(run, f"`{by}` {kinds[by]}, `{order}` {kinds[order]}, batch long")


def output_path(path: Column, root: str) -> Column:
    """Where a file's records go: under its parent's name, unless that is the root's own name."""
    parent = F.element_at(F.split(path, "/"), -2)
    return F.when(parent == root.rstrip("/").split("/")[-1], F.concat_ws("/", F.lit(root), text.basename(path))).otherwise(F.concat_ws("/", F.lit(root), parent, text.basename(path)))


def output_root(root: Column, stage: str, fps: int | None = None, max_frames: int | None = None) -> Column:
    """The next stage's root: /data/ gives way to /jsonl/, that to /recordio/; a folder names the sampling."""
    swapped = F.replace(root, F.lit("/data/"), F.lit("/jsonl/")) if stage == "jsonl" else F.replace(root, F.lit("/jsonl/"), F.lit("/recordio/"))
    return F.concat(swapped, F.lit(f"/fps{fps}_maxframe{max_frames}")) if fps is not None else swapped


def rotated(df: DataFrame, key: str, content: str, degrees: tuple[float, ...] = (0, 90, 180, 270)) -> DataFrame:
    """Every row once for each angle (any angle, counter-clockwise), its image turned and named anew."""
    each = df.withColumn("degrees", F.explode(F.array(*map(F.lit, degrees))))
    turned = each.withColumn(content, images.turned(content, "degrees"))
    return turned.withColumn(key, F.when(F.col("degrees") == 0, F.col(key)).otherwise(text.unique_name(F.col(key), F.col("degrees").cast("string"))))


def overlapping(df: DataFrame, key: str = "id", content: str = "content", size: int = 336, max_slices: int = 12, thumbnail: bool = False, shrink: bool = False) -> DataFrame:
    """(key, images, text): each image cut into overlapping windows that fill the best grid for its shape.

    images: (id, content), row by row, a thumbnail last if wanted; text: their tags. An image whose sides differ more than
    max_slices to one is brought to that ratio first with ``shrink``, else, like one that does not decode, has null images.
    """
    # Marked so that the planner leaves them where they are: it can't evaluate them inside array functions.
    measure, cut_out = (F.pandas_udf(f.func, f.returnType).asNondeterministic() for f in (images.dimensions, images.cut_windows))
    rows = df.select(F.col(key).alias("key"), F.col(content).alias("content"), measure(content).alias("d")).withColumn("fits", geometry.fits_aspect(F.col("d.w"), F.col("d.h"), max_slices))
    first = geometry.within_aspect(F.col("d.w"), F.col("d.h"), max_slices) if shrink else F.when(F.col("fits"), F.col("d"))
    rows = rows.withColumn("first", first).withColumn("slices", geometry.best_slices(F.col("first.w") / size, F.col("first.h") / size, F.col("first.w") / F.col("first.h"), max_slices))
    to = geometry.fitted(F.col("first.w").cast("double"), F.col("first.h").cast("double"), F.col("slices.w"), F.col("slices.h"), size)
    rows = rows.withColumn("to", to)
    at = lambda side, n: geometry.origins(F.col(f"to.{side}"), F.lit(size), geometry.stride(F.col(f"to.{side}"), F.lit(size), F.col(n)))
    sizes = F.struct(*[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(n) for c, n in (("first.w", "w0"), ("first.h", "h0"), ("to.w", "w"), ("to.h", "h"))])
    cut = cut_out(F.when(F.col("first.w").isNotNull(), F.col("content")), sizes, at("w", "slices.w"), at("h", "slices.h"), F.lit(size), F.lit(thumbnail))
    named = F.transform("cut", lambda c, i: F.struct(F.concat(F.col("key").cast("string"), F.lit("_"), i.cast("string")).alias("id"), c.alias("content")))
    made = rows.select("key", cut.alias("cut")).select("key", named.alias("images"))
    return made.select(F.col("key").alias(key), "images", text.image_tags(F.transform("images", lambda x: x["id"])).alias("text"))


def _quarter(text_: Column) -> Column:
    """Four characters to a token."""
    return F.ceil(F.length(text_) / 4)


def prepare(raw: DataFrame, limit: int = 32_768, tokens: Callable[[Column], Column] = _quarter, **packing) -> tuple[DataFrame, DataFrame]:
    """Records of raw samples, and the batches of their conversations by tokens; ``tokens``: the injected tokenizer, a text's length in tokens."""
    records = pack(raw, **packing)
    talk = records.where("type = 'conversation'")
    shown = F.aggregate(F.coalesce(F.map_values("seq_lens"), F.array().cast("array<int>")), F.lit(0), lambda a, x: a + x)
    # A turn at a time is a row, so that a tokenizer may be an Arrow function.
    rows = talk.select("id", shown.alias("shown"), "conversations", F.monotonically_increasing_id().alias("row"))
    turns = rows.select("id", "shown", "row", F.explode_outer("conversations").alias("t"))
    counted = turns.select("id", "shown", "row", F.coalesce(tokens(F.coalesce(F.col("t.text"), F.lit(""))).cast("long"), F.lit(0)).alias("n"))
    whole = counted.groupBy("row").agg(F.first("id").alias("id"), (F.first("shown") + F.sum("n")).alias("tokens"))
    sized = whole.select("id", F.pmod(F.xxhash64("id"), F.lit(1024)).alias("shard"), "tokens")
    return records, packed_batches(sized, "shard", "id", "tokens", limit)

"""What a viewer of samples shows: texts by role, difficulty blocks, pictures with boxes, in plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import images, text


def spoken(turns: Column, model: str | None = None) -> Column:
    """'role: text' lines; with a model, an assistant's text is that model's answer."""

    def said(t: Column) -> Column:
        told = F.when(t["role"] == "assistant", F.element_at(t["responses"], model)).otherwise(t["text"]) if model else t["text"]
        return F.concat(F.coalesce(t["role"], F.lit("")), F.lit(": "), F.coalesce(told, F.lit("")), F.lit("\n"))

    return F.array_join(F.transform(turns, said), "")


def headed(size: Column, body: Column) -> Column:
    """The image's size (a struct w, h; null: N/A) above a text."""
    shown = F.when(size.isNull(), F.lit("N/A")).otherwise(F.format_string("(%d, %d)", size["w"], size["h"]))
    return F.concat(F.lit("image size:"), shown, F.lit("\n\n"), body)


def with_difficulty(turns: Column, difficult: Column, easy: Column, model: str | None = None, hard_model: str | None = None, easy_model: str | None = None) -> Column:
    """A conversation and, where they are there, a difficult and an easy one in blocks of their own."""
    block = lambda name, c, m: F.when(c.isNotNull(), F.concat(F.lit(f"\n{name} Conversations:\n"), spoken(c, m))).otherwise("")
    return F.concat(spoken(turns, model), block("Difficult", difficult, hard_model), block("Easy", easy, easy_model))


def training(samples: DataFrame, model: str | None = None, per_row: int = 3) -> DataFrame:
    """(id, text, boxes, image) of raw samples: all images in one grid, boxes named in the text drawn in it."""
    body = spoken(F.col("conversations"), model)
    rows = samples.select("id", body.alias("body"), F.transform(F.coalesce("images", F.array()), lambda x: x["content"]).alias("contents"))
    rows = rows.withColumn("boxes", text.boxes(F.col("body"))).withColumn("image", F.when(F.size("contents") > 0, images.in_grid("contents", F.lit(per_row))))
    rows = rows.withColumn("image", F.when(F.size("boxes") > 0, images.boxed("image", "boxes")).otherwise(F.col("image")))
    size = F.when(F.col("image").isNotNull(), images.dimensions("image"))
    return rows.select("id", headed(size, F.col("body")).alias("text"), "boxes", "image")


def captions(samples: DataFrame, caption: str = "caption", content: str = "base64_image") -> DataFrame:
    """(text, image) of pretraining rows: the caption under the picture's size."""
    return samples.select(headed(images.dimensions(content), F.col(caption)).alias("text"), F.col(content).alias("image"))


def results(rows: DataFrame, label: str = "label", answer: str = "answer") -> DataFrame:
    """Result rows with markup taken out of label and answer, and whether they agree then."""
    clean = lambda c: text.without_markup(F.col(c))
    return rows.withColumn(label, clean(label)).withColumn(answer, clean(answer)).withColumn("same", F.col(label) == F.col(answer))

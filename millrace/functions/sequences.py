"""Ordered folds over arrays: samplers, line breaking, pairing. Groups are a conversation, a video or a page, not a table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def effective_fps(fps: float, original: Column, total: Column, max_frames: int, holistic: bool = False) -> Column:
    """At most the original rate; lowered where the clip is longer than max_frames at that rate."""
    capped = F.least(F.lit(float(fps)), original)
    share = F.lit(float(max_frames)) / total if holistic else F.lit(float(max_frames + 1)) / (total + 1)
    return F.when(total / original > F.lit(float(max_frames)) / capped, original * share).otherwise(capped)


def sampled_frames(frames: Column, original: Column, fps: Column, max_frames: int) -> Column:
    """Frames picked by accumulating time: one is kept whenever a period of fps has passed, up to max_frames + 1."""
    kind = "array<int>"
    start = F.struct(F.lit(0.0).alias("cur"), F.array().cast(kind).alias("out"))

    def step(s: Column, i: Column) -> Column:
        cur = s["cur"] + 1 / original
        over = F.size(s["out"]) > max_frames
        take = ~over & (cur >= 1 / fps)
        return F.struct(F.when(over, s["cur"]).when(take, cur - 1 / fps).otherwise(cur).alias("cur"), F.when(take, F.concat(s["out"], F.array(i))).otherwise(s["out"]).alias("out"))

    places = F.when(F.size(frames) > 0, F.sequence(F.lit(0), F.size(frames) - 1)).otherwise(F.array().cast(kind))
    kept = F.aggregate(places, start, step, lambda s: s["out"])
    return F.transform(kept, lambda i: F.get(frames, i))


def strided(items: Column, most: int) -> Column:
    """Every (n div most)-th item, at most ``most`` of them; all where there are no more."""
    by = F.greatest(F.floor(F.size(items) / most).cast("int"), F.lit(1))
    return F.when(F.size(items) > most, F.slice(F.filter(items, lambda x, i: i % by == 0), 1, most)).otherwise(items)


def even_places(total: Column, n: Column) -> Column:
    """n places spread evenly from 0 to total - 1, rounded half to even."""
    one = F.when(n == 1, F.array(F.lit(0).cast("long")))
    step = (total - 1) / (n - 1)
    many = F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.bround(i * step).cast("long"))
    return F.when(n > 1, many).otherwise(F.coalesce(one, F.array().cast("array<bigint>")))


def frame_budget(seconds: Column, rate: float, most: int) -> Column:
    return F.when(seconds * rate > most, most).otherwise((seconds * rate).cast("int"))


def lines_of_points(points: Column, height: float = 10.0) -> Column:
    """Texts of (y, x, pos, text) in reading order: a line holds what is less than ``height`` below its first item."""
    start = F.struct(F.lit(None).cast("double").alias("y"), F.lit("").alias("text"))

    def step(s: Column, p: Column) -> Column:
        new = s["y"].isNull()
        same = ~new & (F.abs(p["y"] - s["y"]) < height)
        text = F.when(new, p["text"]).when(same, F.concat(s["text"], F.lit(" "), p["text"])).otherwise(F.concat(s["text"], F.lit("\n"), p["text"]))
        return F.struct(F.when(same, s["y"]).otherwise(p["y"].cast("double")).alias("y"), text.alias("text"))

    return F.aggregate(F.array_sort(points), start, step, lambda s: s["text"])


def ocr_text(items: Column) -> Column:
    """Reading-order text of OCR items (box of corner points, text)."""
    points = F.transform(items, lambda it, i: F.struct(it["box"][0][1].alias("y"), it["box"][0][0].alias("x"), i.alias("pos"), it["text"].alias("text")))
    return lines_of_points(points)


def prepend_to_first(turns: Column, prefix: Column) -> Column:
    """The prefix before the first turn's text; null prefixes and texts count as empty."""
    return F.transform(turns, lambda t, i: F.when(i == 0, t.withField("text", F.concat(F.coalesce(prefix, F.lit("")), F.coalesce(t["text"], F.lit(""))))).otherwise(t))


def interleave(turns: Column, tags: Column) -> Column:
    """Tag i is put before the text of turn i; turns beyond the tags stay."""
    return F.transform(turns, lambda t, i: t.withField("text", F.concat(F.coalesce(F.get(tags, i), F.lit("")), t["text"])))


def answered(turns: Column, answers: Column, model: str) -> Column:
    """Answer i is stored under a model's name in turn 2i + 1; an odd last turn stays."""

    def put(t: Column, i: Column) -> Column:
        pair = (i % 2 == 1) & F.get(answers, F.floor(i / 2).cast("int")).isNotNull()
        told = F.map_concat(F.map_filter(t["responses"], lambda k, v: k != model), F.create_map(F.lit(model), F.get(answers, F.floor(i / 2).cast("int"))))
        return F.when(pair, t.withField("responses", told)).otherwise(t)

    return F.transform(turns, put)


def chat_messages(parts: Column) -> Column:
    """(type, text, image) parts as messages that name an image by its address."""
    return F.transform(parts, lambda p: F.struct(F.when(p["type"] == "image", F.lit("image_url")).otherwise(p["type"]).alias("type"), p["text"].alias("text"), F.when(p["type"] == "image", p["image"]).alias("image_url")))


def joined_turns(turns: Column, sep: str = "\n") -> Column:
    from millrace.functions.text import role_text

    return F.array_join(F.transform(turns, lambda t: role_text(t["role"], t["text"])), sep)


def extents(sizes: Column) -> Column:
    """The largest width and height of (w, h) structs."""
    return F.struct(F.array_max(F.transform(sizes, lambda s: s["w"])).alias("w"), F.array_max(F.transform(sizes, lambda s: s["h"])).alias("h"))

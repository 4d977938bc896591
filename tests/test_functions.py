"""Hand-derived results of the scalar and sequence functions."""

import base64
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import geometry, images, prompts, sequences, text


def one(spark, column, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "want"),
    [("01:02:03.5", 3723.5), ("1:2:3.000001", 3723.000001), ("23:59:59.999999", 86399.999999), ("01:02:03", None), ("01:02:60.0", None), ("24:00:00.0", None), ("x", None)],
)
def test_seconds(spark, given, want):
    assert one(spark, text.seconds(F.col("s")), s=given) == want


def test_strip_and_stop_tokens(spark):
    assert one(spark, text.strip(F.col("s")), s="　 a b \n") == "a b"
    assert one(spark, text.strip_chars(F.col("s"), "<|eot_id|>"), s="<|eot_id|>dot<|eot_id|>") == ""
    assert one(spark, text.strip_stop_token(F.col("s"), "<|eot_id|>"), s="<|eot_id|>dot<|eot_id|>") == "<|eot_id|>dot"


def test_markup_order(spark):
    assert one(spark, text.without_markup(F.col("s")), s="a***---<sup>2</sup>\n#{x}$^> [Image](q)b") == "a2x b"


def test_boxes(spark):
    got = one(spark, text.boxes(F.col("s")), s="[Image](1,2,.5,-.5) [Image](1,2,3,-4) [Image](+1.5, 2,3,4)")
    assert [tuple(b) for b in got] == [(1, 2, 0.5, -0.5), (1.5, 2, 3, 4)]
    got = one(spark, text.boxes(F.col("s"), text.LIST_BOX), s="[ 1.0, -2.5 ,3.0,4.0] [1,2,3,4]")
    assert [tuple(b) for b in got] == [(1.0, -2.5, 3.0, 4.0)]


def test_fences_html_and_paths(spark):
    assert one(spark, text.fenced_block(F.col("s")), s="x ```markdown\n# a\n``` y ```b```") == "markdown\n# a"
    assert one(spark, text.fenced_block(F.col("s")), s="none") == "none"
    assert one(spark, text.flat_html(F.col("s")), s=" <p>\n\t x \n</p>\n") == "<p>x</p>"
    assert one(spark, text.without_prefix(F.col("s"), "/a/b/"), s="/a/b/c/d") == "c/d"
    assert one(spark, text.without_prefix(F.col("s"), "/a/b"), s="/a/bc") == "/a/bc"
    assert one(spark, text.last_parts(F.col("s"), 4, "_"), s="/w/x/y/z/q") == "x_y_z_q"
    assert one(spark, text.ends_with_any(F.col("s"), "jsonl"), s="ajsonl") is True
    assert one(spark, text.is_url(F.col("s")), s="file:/x") is False


def test_pointers_and_reports(spark):
    pointer = "version https://git-lfs.github.com/spec/v1\noid sha256:ab\nsize 1234\n"
    assert one(spark, text.lfs_size(F.col("s")), s=pointer) == 1234
    assert one(spark, text.lfs_size(F.col("s")), s="size 3") is None
    assert one(spark, text.resolve_url(F.col("s"), F.lit("d/f")), s="https://h/r/") == "https://h/r/resolve/main/d/f"
    assert one(spark, text.saved_path(F.col("s"), "/root"), s="https://h/r/resolve/main/d/f") == "/root/d/f"
    assert one(spark, text.tail_number(F.col("s")), s="a\n123it/s 4\n") == 123
    assert one(spark, text.percent(F.col("s")), s="12.5%") == 12.5
    assert one(spark, text.report_line(F.col("s"), F.lit("1"), True), s="k") == "**k**: 1\n"


def test_repetition(spark):
    df = spark.createDataFrame([("ab" * 900,), ("".join(chr(33 + i * 7 % 90) + str(i) for i in range(400)),), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(text.is_repetitive("s")).collect()] == [True, False, False, False]


def test_values_as_text(spark):
    assert one(spark, text.values_as_text(F.col("s")), s='{"a": true, "b": null, "c": 1.0, "d": {"e": 1}, "f": "x"}') == '{"a": "True", "b": "None", "c": "1.0", "d": "{\'e\': 1}", "f": "x"}'


def test_divisors_and_sizes(spark):
    assert geometry.divisor_pairs(6) == [(1, 6), (2, 3), (3, 2), (6, 1)]
    assert tuple(one(spark, geometry.best_size(F.col("w"), F.col("h")), w=1000, h=500)) == (672, 336)
    assert tuple(one(spark, geometry.best_slices(F.col("w"), F.col("h"), F.col("w") / F.col("h")), w=3, h=3)) == (3, 3)
    assert one(spark, geometry.stride(F.col("w"), F.lit(224), F.lit(4)), w=100) == -42
    assert one(spark, geometry.origins(F.col("w"), F.lit(224), F.lit(0)), w=500) == [0, 224]
    assert one(spark, geometry.origins(F.col("w"), F.lit(224), F.lit(10)), w=100) == []
    assert tuple(one(spark, geometry.square_crop(F.col("w"), F.col("h")), w=7, h=4)) == (1, 0, 5, 4)
    assert one(spark, geometry.pixels(F.col("s"), 100), s=-0.119) == -11
    assert tuple(one(spark, geometry.limited(F.col("w"), F.col("h"), 100), w=20, h=20)) == (10, 10)
    assert one(spark, geometry.video_tokens(F.array(F.lit(3), F.lit(5), F.lit(3))), w=1) == 11
    got = one(spark, geometry.smart_size(F.col("w"), F.col("h")), w=1000, h=800)
    assert got["w"] % 28 == got["h"] % 28 == 0 and got["w"] * got["h"] <= geometry.MAX_PIXELS


def test_samplers(spark):
    frames = F.sequence(F.lit(0), F.lit(299))
    got = one(spark, sequences.sampled_frames(frames, F.lit(10.0), F.lit(10.0), 64), w=1)
    assert len(got) == 65
    rate = sequences.effective_fps(2, F.lit(1.0), F.lit(30.0), 64)
    assert one(spark, rate, w=1) == 1.0
    assert one(spark, sequences.strided(F.sequence(F.lit(0), F.lit(129)), 64), w=1) == list(range(0, 128, 2))
    assert one(spark, sequences.even_places(F.lit(11.0), F.col("n")), n=1) == [0]
    assert one(spark, sequences.even_places(F.lit(11.0), F.col("n")), n=0) == []
    assert one(spark, sequences.even_places(F.lit(6.0), F.col("n")), n=3) == [0, 2, 5]


def test_lines_use_an_anchor_not_the_item_before(spark):
    items = [("a", 0.0), ("b", 6.0), ("c", 12.0), ("d", 22.0)]
    rows = F.array(*[F.struct(F.array(F.array(F.lit(float(i)), F.lit(y))).alias("box"), F.lit(t).alias("text")) for i, (t, y) in enumerate(items)])
    assert one(spark, sequences.ocr_text(rows), w=1) == "a b\nc\nd"


def test_turns(spark):
    turns = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(t).alias("text"), F.create_map().cast("map<string,string>").alias("responses")) for r, t in (("user", "q"), ("assistant", "a"), ("user", "z"))])
    got = one(spark, sequences.answered(turns, F.array(F.lit("new")), "m"), w=1)
    assert [t["responses"] for t in got] == [{}, {"m": "new"}, {}]
    assert one(spark, sequences.interleave(turns, F.array(F.lit("<1>"), F.lit("<2>"))), w=1)[1]["text"] == "<2>a"
    assert one(spark, sequences.joined_turns(turns), w=1) == "user: q\nassistant: a\nuser: z"


def test_prompts(spark):
    assert one(spark, prompts.pick(F.col("n"), "box_en", F.lit("cat")), n=0) == "Please find cat and give its box"
    assert one(spark, prompts.pick(F.col("n"), "ocr"), n=-1) == prompts.PROMPTS["ocr"][-1]


def test_pixels(spark):
    p = np.arange(4 * 6 * 3, dtype=np.uint8).reshape(4, 6, 3)
    raw = images.encode(p)
    assert images.size_of(raw) == (6, 4) and (images.decode(raw) == p).all()
    assert images.rotate(p, 90).shape == (6, 4, 3) and len(images.tiles(images.resize(p, 4, 4), 2)) == 4
    assert images.size_of(b"\xff\xd8\xff\xc0" + struct.pack(">HBHH", 11, 8, 40, 30) + b"\0" * 9) == (30, 40)
    assert images.grid([p, p, p], 2).shape == (8, 12, 3) and (images.outlined(p, (0, 0, 6, 4), 1)[0] == (255, 0, 0)).all()
    good = base64.b64encode(raw).decode()
    df = spark.createDataFrame([(good,), (good[:40],), ("!!",), (None,)], "c string")
    assert [r[0] for r in df.select(images.intact("c")).collect()] == [True, False, False, False]
    assert tuple(df.select(images.dimensions("c").alias("d")).first()["d"]) == (6, 4)
    tiles = df.limit(1).select(images.cut_tiles("c", F.lit(4), F.lit(4), F.lit(2)).alias("t")).first()["t"]
    assert len(tiles) == 5

"""Pictures, videos, PDFs, configurations, reports and batch inference on files made here."""

import base64
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import images
from millrace.operators import inference, packing, reports, views
from millrace.sources import config, files, media


def png(pixels):
    return base64.b64encode(images.encode(np.asarray(pixels, np.uint8))).decode()


def pixels(content):
    return images.decode(base64.b64decode(content))


def ramp(w, h):
    return np.stack([np.tile(np.linspace(0, 255, w), (h, 1)), np.tile(np.linspace(0, 255, h)[:, None], (1, w)), np.full((h, w), 40)], axis=2).astype(np.uint8)


def test_resizing():
    p = ramp(64, 32)
    for kind in ("bilinear", "bicubic"):
        assert (images.resize(p, 64, 32, kind) == p).all()
        small = images.resize(p, 16, 8, kind).astype(int)
        assert np.abs(small - p.reshape(8, 4, 16, 4, 3).mean(axis=(1, 3)))[1:-1, 1:-1].max() <= 3  # borders lack neighbours
        assert (images.resize(np.full((5, 7, 3), 99, np.uint8), 40, 31, kind) == 99).all()


def test_rotating_and_cropping():
    p = ramp(30, 20)
    assert (images.rotate(p, 90) == np.rot90(p)).all() and images.rotate(p, 30).shape[:2] == (33, 36)
    back = images.rotate(images.rotate(np.full((40, 40, 3), 200, np.uint8), 45), -45)
    middle = back[back.shape[0] // 2 - 10 : back.shape[0] // 2 + 10, back.shape[1] // 2 - 10 : back.shape[1] // 2 + 10]
    assert (middle == 200).mean() > 0.99
    assert images.centre_square(p).shape == (20, 20, 3) and images.centre_square(p, 8).shape == (8, 8, 3)
    assert (images.crop(p, (-2, -1, 5, 4))[1:, 2:] == p[:4, :5]).all() and not images.crop(p, (-2, -1, 5, 4))[0].any()
    assert base64.b64decode(images.array_base64(np.arange(3, dtype="<i4"))) == b"\0\0\0\0\1\0\0\0\2\0\0\0"


def test_columns_of_pictures(spark):
    df = spark.createDataFrame([(1, png(ramp(30, 20))), (2, "@@"), (3, None)], "id int, content string")
    grid = df.select("id", images.in_grid(F.array("content", "content", "content"), F.lit(2)).alias("g"), images.squared("content", F.lit(0)).alias("s")).orderBy("id").collect()
    assert pixels(grid[0]["g"]).shape == (40, 60, 3) and pixels(grid[0]["s"]).shape == (20, 20, 3) and grid[1]["g"] is None and grid[2]["s"] is None
    box = F.array(F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("x1"), F.lit(1.0).alias("y1")))
    drawn = pixels(df.where("id = 1").select(images.boxed("content", box)).first()[0])
    assert (drawn[0] == [255, 0, 0]).all() and (drawn[10, 15] == ramp(30, 20)[10, 15]).all()
    turned = packing.rotated(df.where("id = 1").select(F.lit("n").alias("k"), "content"), "k", "content", (0, 33.5)).collect()
    assert len(turned) == 2 and pixels(turned[1]["content"]).shape[1] > 30


def test_overlapping_windows(spark):
    df = spark.createDataFrame([("a", png(ramp(100, 60))), ("wide", png(ramp(390, 30))), ("bad", "@@")], "id string, content string")
    got = {r["id"]: r for r in packing.overlapping(df, size=56, thumbnail=True).collect()}
    assert got["wide"]["images"] is None and got["bad"]["images"] is None
    parts = [pixels(x["content"]) for x in got["a"]["images"]]
    assert all(p.shape == (56, 56, 3) for p in parts) and [x["id"] for x in got["a"]["images"]] == [f"a_{i}" for i in range(len(parts))]
    assert got["a"]["text"] == "".join(f"<img>a_{i}</img>" for i in range(len(parts)))
    whole = images.resize(ramp(100, 60), 93, 56)  # two slices beside each other, whose windows overlap
    assert len(parts) == 3 and (parts[0] == whole[:, :56]).all() and (parts[1] == whole[:, 37:]).all() and (parts[2] == images.resize(whole, 56, 56)).all()
    assert {r["id"]: r["images"] for r in packing.overlapping(df, size=56, shrink=True).collect()}["wide"] is not None


class Clip:
    n, fps = 30, 10.0

    def frames(self, places):
        return [b"f%d" % p for p in places]


class Paper:
    n = 5

    def slice(self, pages):
        return ",".join(map(str, pages)).encode()

    def render(self, page, zoom):
        return b"%d@%g" % (page, zoom)


def opened(of):
    def read(path):
        if "broken" in path:
            raise OSError(path)
        return of

    return lambda: read


def test_videos_and_papers(spark):
    df = spark.createDataFrame([("a.mp4",), ("broken.mp4",)], "path string")
    got = media.video_frames(df, opened(Clip()), rate=2, most=4).collect()
    assert [(r["i"], r["place"]) for r in got] == [(0, 0), (1, 10), (2, 19), (3, 29)] and base64.b64decode(got[1]["content"]) == b"f10"
    assert [r["place"] for r in media.video_frames(df, opened(Clip()), rate=2, span=(1.0, 2.0)).collect()] == [10, 19]
    assert [r["pages"] for r in media.page_counts(df, opened(Paper())).collect()] == [5]
    assert [(r["slice"], bytes(r["content"])) for r in media.pdf_slices(df, opened(Paper()), size=2).collect()] == [(0, b"0,1"), (1, b"2,3"), (2, b"4")]
    assert [(r["slice"], r["pages"]) for r in media.pdf_slices(df, opened(Paper()), size=2, first=1, end=99).collect()] == [(0, [1]), (1, [2, 3]), (2, [4])]
    assert [base64.b64decode(r["content"]) for r in media.pdf_pages(df, opened(Paper()), first=3).collect()] == [b"3@2", b"4@2"]


def test_fetching_and_writing(spark, tmp_path):
    def open_fetch():
        def fetch(url):
            if "down" in url:
                raise OSError
            return (200, b"body") if "ok" in url else (404, b"none")

        return fetch

    df = spark.createDataFrame([("ok",), ("gone",), ("down",), (None,)], "url string")
    assert [r["content"] for r in media.fetched(df, open_fetch).collect()] == [b"body", None, None, None]
    pics = spark.createDataFrame([("a/0.png", png(ramp(4, 4))), ("1.png", None)], "name string, content string")
    assert media.write_images(pics, str(tmp_path)) == 1 and images.size_of((tmp_path / "a/0.png").read_bytes()) == (4, 4)


def test_configurations(spark, tmp_path):
    base = {"optimizer": {"lr": 1}, "data": {"train": {"index_file": "x"}}, "checkpoint": {"save_dir": "y", "deep": {"save_path": "z"}}, "list": [{"save_dir": "no"}], "size": 3}
    assert config.values_of(base) == ["y", "z"]
    made = config.training_config(base, 1010, "/i/set/a_b.idx", "/save/")
    assert made["optimizer"] == {"lr": 1, "warmup_iters": 30, "lr_decay_iters": 980} and made["checkpoint"]["save_dir"] == "/save/seta-sft" and base["checkpoint"]["save_dir"] == "y"
    assert "size" not in config.patched(base, {"a": 1}, ("size",))
    pytest.importorskip("yaml")
    config.write_yaml(made, str(tmp_path / "c.yaml"))
    assert config.read_yaml(str(tmp_path / "c.yaml")) == made
    config.write_report({"a": 1}, str(tmp_path / "r.json"))
    assert (tmp_path / "r.json").read_text() == '{\n  "a": 1\n}'


def test_index_names(spark):
    df = spark.createDataFrame([(0, "/d/one_x.rio"), (1, "/d/docvqa_x.rio"), (2, "/d/ai2d_x.rio")], "pos int, name string")
    assert [r["dataset"] for r in config.index_names(df, ("ai2d", "docvqa")).orderBy("pos").collect()] == ["one", "docvqa", "ai2d"]
    assert config.index_names(df.where("pos = 0"), ("ai2d",)).count() == 0
    assert [r["dataset"] for r in config.index_names(df.select("pos", F.regexp_replace("name", "_x.rio", "").alias("name")), ("docvqa",)).orderBy("pos").collect()] == ["one", "docvqa", "ai2d"]


def test_report_files(spark, tmp_path):
    (tmp_path / "m_A.csv").write_text("split,Overall\ntest,0.5\nvalidation,0.7\n")
    (tmp_path / "m_B.csv").write_text("name,acc\nx,10\nOverall,33.25\n")
    (tmp_path / "m_C.json").write_text(json.dumps({"overall": {"overall": "0.41"}, "list": [1, "62.5%"]}))
    (tmp_path / "m_D.csv").write_text("p,r\n10,30\n")
    rules = [
        reports.Report("A", "A.csv", pick="validation"), reports.Report("B", "B.csv", "indexed", "Overall", ("acc",)), reports.Report("C", "C.json", "json", metrics=("overall.overall",)),
        reports.Report("C2", "C.json", "json", metrics=("list.-1",)), reports.Report("D", "D.csv", metrics=("p", "r"), how="sum"), reports.Report("E", "none.csv"), reports.Report("B9", "B.csv", "indexed", "1", ("acc",)),
        reports.Report("F", "f.xlsx", link="submit"),
    ]
    got = {r["benchmark"]: r["score"] for r in reports.scores(reports.read_reports(spark, str(tmp_path), lambda f: f"m_{f}", rules), reports.rule_table(spark, rules)).collect()}
    assert got == {"A": 70.0, "B": 33.2, "C": 41.0, "C2": 62.5, "D": 40.0, "B9": 33.2}
    told = reports.suite_report(spark, str(tmp_path), lambda f: f"m_{f}", rules, "exp")
    assert told.startswith("exp\n\nA: 70.0\nB: 33.2\n") and "F: submit" in told and "E:" not in told and told.endswith("Average: 46.6")
    assert reports.read_reports(spark, str(tmp_path), str, rules).count() == 0


def samples(spark, folder):
    turn = lambda r, t: {"role": r, "text": t}
    for name, ids in (("a", range(3)), ("b", range(3, 5))):
        rows = [{"id": f"s{i}", "conversations": [turn("user", f"q{i}"), turn("assistant", "old"), turn("user", "fail" if i == 1 else "more"), turn("assistant", "old")]} for i in ids]
        (folder / f"{name}.jsonl").write_text("\n".join(map(json.dumps, rows)))
    return files.raw_samples(spark, str(folder))


def shout():
    def call(prompt, shown):
        if prompt == "fail":
            raise OSError
        return prompt.upper()

    return call


def test_batch_inference(spark, tmp_path):
    (tmp_path / "in").mkdir()
    raw = samples(spark, tmp_path / "in")
    told = inference.by_rank(raw, 2, ["id"], shout, "m", inference.Retry(1))
    got = {r["id"]: r for r in told.collect()}
    assert set(got) == {"s0", "s2", "s3", "s4"} and [got[i]["rank"] for i in sorted(got)] == [0, 0, 1, 1]
    assert [t["responses"] for t in got["s3"]["conversations"]] == [{}, {"m": "Q3"}, {}, {"m": "MORE"}]
    inference.write_by(told, str(tmp_path / "ranks"))
    assert sorted(p.name for p in (tmp_path / "ranks").glob("rank=*")) == ["rank=0", "rank=1"]
    part = inference.by_file(raw, "/out", shout, "m", 1, 2, retry=inference.Retry(1))
    assert {(r["id"], r["path"]) for r in part.collect()} == {("s3", "/out/b.jsonl"), ("s4", "/out/b.jsonl")}
    done = spark.createDataFrame([("/x/b.jsonl",)], "file string")
    assert {r["id"] for r in inference.by_file(raw, "/out", shout, "m", done=done, retry=inference.Retry(1)).collect()} == {"s0", "s2"}


def test_views(spark):
    talk = [("user", "see [Image](0.1,0.1,0.9,0.9)", {}), ("assistant", "old", {"m": "new"})]
    rows = [("a", [("p", png(ramp(20, 10)))], talk), ("b", None, talk)]
    df = spark.createDataFrame(rows, "id string, images array<struct<name: string, content: string>>, conversations array<struct<role: string, text: string, responses: map<string,string>>>")
    got = {r["id"]: r for r in views.training(df, "m").collect()}
    assert got["a"]["text"] == "image size:(20, 10)\n\nuser: see [Image](0.1,0.1,0.9,0.9)\nassistant: new\n" and len(got["a"]["boxes"]) == 1
    assert (pixels(got["a"]["image"])[1, 5] == [255, 0, 0]).all() and got["b"]["text"].startswith("image size:N/A\n\n") and got["b"]["image"] is None
    cap = spark.createDataFrame([("c", png(ramp(3, 4)))], "caption string, base64_image string")
    assert views.captions(cap).first()["text"] == "image size:(3, 4)\n\nc"
    assert views.results(spark.createDataFrame([("a*", "a"), ("x", "y")], "label string, answer string")).where("same").count() == 1


def test_reports_of_many_experiments_in_one_scan(spark, tmp_path):
    for e, k in (("one", 0.5), ("two", 0.25)):
        (tmp_path / f"{e}_acc.csv").write_text(f'split,Overall,"a ""b"", c"\r\ntest,{k},7\r\n\r\n"validation",{k + 0.1},"8"\n')
        (tmp_path / f"{e}_val_acc.csv").write_text('Index,Overall\n"x\ny",9.5%\nz,word\n')
    (tmp_path / "one_s.json").write_text('{"a": [1, {"b": "12.25%"}]}')
    (tmp_path / "unknown.txt").write_text("not a report")
    rules = [
        reports.Report("A", "_acc.csv", pick="validation"), reports.Report("B", "_acc.csv", pick="last", metrics=('a "b", c',)), reports.Report("C", "_val_acc.csv", "indexed", "x\ny"),
        reports.Report("D", "_s.json", "json", metrics=("a.-1.b",)), reports.Report("E", "_no.csv"), reports.Report("F", "f", link="submit"),
    ]
    got = {(r["experiment"], r["benchmark"]): r["score"] for r in reports.scores(reports.scanned(spark, str(tmp_path), rules), reports.rule_table(spark, rules), ("experiment",)).collect()}
    assert got == {("one", "A"): 60.0, ("two", "A"): 35.0, ("one", "B"): 8.0, ("two", "B"): 8.0, ("one", "C"): 9.5, ("two", "C"): 9.5, ("one", "D"): 12.2}
    told = {r["experiment"]: r["report"] for r in reports.suite(spark, str(tmp_path), rules).collect()}
    assert told == {"one": "A: 60.0\nB: 8.0\nC: 9.5\nD: 12.2\nF: submit\nAverage: 22.4", "two": "A: 35.0\nB: 8.0\nC: 9.5\nF: submit\nAverage: 17.5"}

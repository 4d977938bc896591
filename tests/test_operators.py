import base64
import io
import json
import tarfile
import zipfile

import numpy as np
from pyspark.sql import functions as F

from millrace.functions import images
from millrace.operators import inference, packing, relational, reports
from millrace.sources import archives, files
from millrace.streaming import packing as stream


def png(seed, w=60, h=40):
    return base64.b64encode(images.encode(np.full((h, w, 3), seed, np.uint8))).decode()


def test_shards_cover_and_balance(spark):
    df = relational.positioned(spark.range(23).select(((F.col("id") * 7) % 23).alias("k")), "k")
    got = [(r["k"], r["pos"], r["r"]) for r in df.withColumn("r", relational.block_rank(F.col("pos"), F.lit(23), 4)).collect()]
    assert all(k == p for k, p, _ in got)
    sizes = [sum(r == x for _, _, r in got) for x in range(4)]
    assert sizes == [6, 6, 6, 5]
    assert relational.positioned(spark.range(0), "id").count() == 0


def test_balance_loses_nothing(spark):
    df = spark.createDataFrame([(f"f{i}", 2) for i in range(5)], "name string, size long").agg(F.collect_list(F.struct("name", "size")).alias("f"))
    got = [tuple(x) for x in df.select(relational.balanced(F.col("f"), 4).alias("x")).first()["x"]]
    assert got == [("f0", 0), ("f1", 1), ("f2", 2), ("f3", 3), ("f4", 3)]


def test_first_of_each_is_idempotent(spark):
    df = spark.createDataFrame([(1, "image", 0), (1, "image", 1), (2, "conversation", 2), (2, "conversation", 3)], "id int, type string, pos int")
    once = relational.first_of_each(df, "id", ["pos"], F.col("type") == "conversation")
    twice = relational.first_of_each(once, "id", ["pos"], F.col("type") == "conversation")
    assert sorted(once.collect()) == sorted(twice.collect()) and {r["pos"] for r in once.collect()} == {0, 2, 3}


def test_lookups(spark):
    have = spark.createDataFrame([("a/x.jsonl",), ("b/x.jsonl",), ("b/x.jsonl",)], "path string")
    done = spark.createDataFrame([("out/a/x.jsonl",)], "path string")
    assert [r["path"] for r in relational.remaining(have, done).collect()] == ["b/x.jsonl"] * 2
    assert relational.remaining(have, done, only_name=True).count() == 0
    members = spark.createDataFrame([("d/1.jpg",), ("d/1.json",), ("d/2.jpg",)], "name string")
    assert [r["stem"] for r in relational.by_stem(members, members).collect()] == ["d/1"]
    assert relational.all_true(spark.createDataFrame([(True,), (False,)], "f boolean"), "f").first()[0] is False


def raw_rows():
    many = {f"i{k}": png(k % 5) for k in range(70)}
    talk = [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a", "model-x": "m"}]
    return [
        {"id": "text", "conversations": talk}, {"id": "none", "base64_image": {}, "conversations": talk}, {"id": "one", "base64_image": {"z": png(1), "a": png(2)}, "conversations": talk},
        {"id": "bad", "base64_image": {"x": "@@"}, "conversations": talk}, {"id": "null", "base64_images": {"x": None}, "conversations": talk},
        {"id": "many", "base64_images": many, "conversations": talk}, {"id": "clip", "base64_images": {f"f{k}": png(k % 3) for k in range(40)}, "fps": 10.0, "conversations": talk},
        {"id": "pad", "conversations": [talk[0], {"role": "assistant", "text": "x <|image_pad|>"}]},
    ]


def test_packing_from_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text("\n".join(map(json.dumps, raw_rows())) + "\n\n")
    raw = files.raw_samples(spark, str(tmp_path / "in"))
    assert raw.where("id = 'one'").first()["images"][0]["name"] == "z"
    assert raw.where("id = 'one'").first()["conversations"][1]["responses"] == {"model-x": "m"}
    records = packing.pack(raw).collect()
    talk = {r["id"]: r for r in records if r["type"] == "conversation"}
    assert set(talk) == {"text", "none", "one", "many", "clip", "pad"}
    assert talk["one"]["conversations"][0]["text"].count("<img>z#") == 1 and talk["one"]["conversations"][0]["text"].endswith("q")
    assert talk["many"]["conversations"][0]["text"].count("<img>") == 64 and talk["clip"]["is_video"]
    assert talk["clip"]["conversations"][0]["text"].count("<img>") in (7, 8)
    shown = [r for r in records if r["type"] == "image"]
    assert len({r["id"] for r in shown}) == len(shown) and all(images.size_of(base64.b64decode(r["content"])) == (56, 28) for r in shown)
    assert {r["reject"]: r["count"] for r in packing.rejected(raw).collect()} == {"first image is null": 1, "image does not decode": 1}
    held = packing.pack_holistic(raw, lambda c: F.lit(4)).collect()
    told = {r["id"]: r for r in held if r["type"] == "conversation"}
    assert set(told) == {"text", "none", "one", "null", "many", "clip", "pad"}
    assert all(told[i]["conversations"][0]["text"] == "q" and told[i]["seq_lens"] is None for i in ("text", "none", "null"))
    assert told["one"]["seq_lens"] == {"one": 8} and told["one"]["conversations"][0]["text"].count("<img>") == 2
    assert all(images.size_of(base64.b64decode(r["content"])) == (60, 40) for r in held if r["type"] == "image")
    told = packing.pack(raw, interleave=True).where("id = 'one'").first()["conversations"]
    assert told[0]["text"].startswith("<img>z#") and told[1]["text"].startswith("<img>a#")
    _, batches = packing.prepare(raw, limit=500)
    assert batches.count() == len(talk)
    files.write_json_lines(packing.pack(raw), str(tmp_path / "out"), by="type")
    assert spark.read.json(str(tmp_path / "out")).count() == len(records)


def test_every_row_stays_a_row(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    talk = [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}]
    rows = [{"id": "x", "base64_image": {"p": png(1)}, "conversations": talk}] * 2
    rows += [{"id": "still", "base64_image": {"f": png(2)}, "fps": 30.0, "conversations": talk}, {"id": "bad", "base64_image": {"f": "@@"}, "conversations": talk}]
    rows += [{"id": "pad", "base64_image": {"f": png(3)}, "conversations": [talk[0], {"role": "assistant", "text": "<|image_pad|>"}]}]
    for name in ("a", "b"):
        (tmp_path / f"in/sub/{name}.jsonl").write_text("\n".join(map(json.dumps, rows if name == "a" else rows[:1])))
    raw = files.raw_samples(spark, str(tmp_path / "in"))
    records = packing.pack(raw).collect()
    talks = [r for r in records if r["type"] == "conversation"]
    assert sorted(r["id"] for r in talks) == ["pad", "still", "x", "x", "x"]
    assert {r["id"]: r["seq_lens"] for r in talks}["still"] == {} and all(r["conversations"][0]["text"].count("<img>") == 1 for r in talks if r["id"] == "x")
    assert len([r for r in records if r["type"] == "image"]) == 2
    assert {r["reject"]: r["count"] for r in packing.rejected(raw, holistic=True).collect()} == {"placeholder in the answer": 1, "image does not decode": 1}
    done = packing.processed(raw, str(tmp_path / "out/in"))
    paths = {}
    for r in done.collect():
        paths.setdefault(r["path"].split("/out/in/")[1], []).append((r["type"], r["content"] == packing.DUMMY))
    assert set(paths) == {"sub/a.jsonl", "sub/b.jsonl"} and all(p.count(("image", True)) == 1 for p in paths.values())
    assert paths["sub/b.jsonl"].count(("image", False)) == 1
    packing.write_processed(done, str(tmp_path / "w"))
    assert spark.read.json(str(tmp_path / "w")).count() == done.count()


def test_paths(spark):
    df = spark.createDataFrame([("/data/set/x/a.jsonl",), ("/data/set/b.jsonl",)], "p string")
    assert [r[0] for r in df.select(packing.output_path(F.col("p"), "/out/set")).collect()] == ["/out/set/x/a.jsonl", "/out/set/b.jsonl"]
    assert df.select(packing.output_root(F.lit("/data/set"), "jsonl", 2, 64)).first()[0] == "/jsonl/set/fps2_maxframe64"


def test_archives(spark, tmp_path):
    members = {"d/x.jpg": b"\xff\xd8pic", "d/x.json": b'{"caption": "c", "status": "ok"}', "d/l.jsonl": b'{"caption": "1"}\n\n{"caption": "2"}\n'}
    with tarfile.open(tmp_path / "a.tar", "w") as t:
        folder = tarfile.TarInfo("d")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for name, body in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for name, body in members.items():
            z.writestr(name, body)
    for kind, everything in (("tar", 4), ("zip", 3)):
        path = str(tmp_path / f"a.{kind}")
        assert archives.members(spark, path, kind).count() == everything
        large = archives.members(spark, path, kind, small=10)  # read by path, a member at a time
        assert sorted(map(tuple, large.collect()), key=repr) == sorted(map(tuple, archives.members(spark, path, kind).collect()), key=repr)
        assert archives.as_base64(archives.members(spark, path, kind, ".jpg")).first()["content"] == base64.b64encode(b"\xff\xd8pic").decode()
        assert archives.as_json(archives.members(spark, path, kind, ".json"), "caption string, status string").first()["status"] == "ok"
        assert [r["caption"] for r in archives.as_json_lines(archives.members(spark, path, kind, "jsonl"), "caption string").orderBy("line").collect()] == ["1", "2"]
    assert spark.range(1).select(archives.saved_name(F.lit("a/b.c"), F.lit("p"))).first()[0] == "p_a_b.c"


def test_sources(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p/w.bin").write_text("version https://git-lfs.github.com/spec/v1\noid x\nsize 77\n")
    (tmp_path / "p/raw.bin").write_bytes(b"\xff\xfe\x00")
    got = [tuple(r) for r in files.pointers(spark, str(tmp_path / "p"), "https://h/r").collect()]
    assert got == [(77, "https://h/r/resolve/main/w.bin")]
    assert files.listing(spark, str(tmp_path), "bin").count() == 2
    (tmp_path / "t.tsv").write_text("question\timage\nq1\tAA\n")
    assert files.table_file(spark, str(tmp_path / "t.tsv"), sep="\t").first()["question"] == "q1"
    (tmp_path / "c.csv").write_text("name,acc\nx,1.5\nOverall,2.5\n")
    assert files.indexed_value(files.table_file(spark, str(tmp_path / "c.csv")), "Overall", "acc").first()[0] == 2.5
    (tmp_path / "m.json").write_text('[{"a": 1}, {"a": 2}]')
    assert files.array_files(spark, [str(tmp_path / "m.json")] * 2, "a int").count() == 4
    assert json.loads(files.bot_message(spark.createDataFrame([("r",)], "report string"), "c").first()[0]) == {"chatid": "c", "msgtype": "markdown", "markdown": {"content": "r"}}


def test_inference(spark):
    rows = [(1, 0, "a"), (1, 1, "x"), (1, 2, "b"), (2, 0, "fail"), (2, 1, "y"), (3, 0, "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")

    def flaky():
        seen = {}

        def call(prompt, images):
            seen[prompt] = seen.get(prompt, 0) + 1
            if prompt == "fail" or seen[prompt] < 3:
                raise OSError("busy")
            return prompt.upper()

        return call

    got = inference.answer_turns(df, flaky, retry=inference.Retry(sleep=lambda s: None)).collect()
    assert [(r["conv_id"], r["i"], r["answer"]) for r in got] == [(1, 0, "A")]
    pics = spark.createDataFrame([("p", png(3))], "id string, content string")
    out = inference.distilled(pics, lambda: lambda prompt, shown: "see ```md``` end", retry=inference.Retry(1)).collect()
    assert len(out) == 4 and {r["conversations"][1]["text"] for r in out} == {"md"} and len({r["id"] for r in out}) == 4


def test_reports(spark):
    long = spark.createDataFrame(
        [("a", 0, "test", "acc", 0.5), ("a", 1, "validation", "acc", 0.7), ("b", 0, "", "p", 10.0), ("b", 0, "", "r", 30.0), ("c", 0, "", "s", 1.0), ("d", 0, "", "s", 0.999)],
        "benchmark string, row int, split string, metric string, value double",
    )
    rules = spark.createDataFrame([("a", "validation", ["acc"], "mean"), ("b", "first", ["p", "r"], "sum"), ("c", "last", ["s"], "mean"), ("d", "last", ["s"], "mean"), ("e", "first", ["s"], "mean")], reports.RULES)
    scored = reports.scores(long, rules)
    assert {r["benchmark"]: r["score"] for r in scored.collect()} == {"a": 70.0, "b": 40.0, "c": 1.0, "d": 99.9}
    assert reports.overall(scored, ["a", "b", "d"], ("a", "b")).first()[0] == 77.4 or reports.overall(scored, ["a", "b", "d"], ("a", "b")).first()[0] == 77.5
    assert reports.overall(scored, ["a", "e"]).first()[0] is None
    present = reports.mean_of_present(spark.createDataFrame([("y", 2.0), ("x", 1.0)], "dataset string, score double"), ["x", "q", "y"])
    assert [(r["ord"], r["mean"]) for r in present.orderBy("ord").collect()] == [(0, "1.50"), (2, "1.50")]
    assert reports.markdown_report(present).first()[0] == "**x**: 1.0\n**y**: 2.0\n"


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    sample = {"id": "1", "conversations": [{"role": "user", "text": " hi "}]}
    (tmp_path / "in/a.txt").write_text(json.dumps(sample) + "\n\n")
    for _ in range(2):  # the second run finds nothing new
        stream.written(stream.packed(stream.conversations(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    got = spark.read.json(str(tmp_path / "out")).collect()
    assert [(r["id"], r["text"], r["repetitive"]) for r in got] == [("1", "user:  hi", False)]


def test_union_and_constants(spark):
    df = spark.createDataFrame([("f", "1"), ("f", "2"), ("g", "3")], "file string, id string")
    assert relational.with_constant_rows(df, "file", "dummy").where("type = 'image'").count() == 2
    assert relational.bag_union(df, df).count() == 6
    roots = spark.createDataFrame([("/a",), ("/b",)], "root string")
    inner = spark.createDataFrame([("/a", "/a/1"), ("/a", "/a/2")], "root string, folder string")
    assert sorted(r["root"] for r in relational.flattened_roots(roots, inner).collect()) == ["/a/1", "/a/2", "/b"]
    assert relational.between(spark.range(10), 2, 5, "id").count() == 3

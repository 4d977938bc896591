import json
import os

import pytest

from millrace.sources import routed


def tree(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f)).read() for d, _, fs in os.walk(root) for f in fs if "/_" not in d and not f.startswith(("_", "."))}


def rows_of(n):
    return [(f"a/f{i % 5}.jsonl" if i % 2 else "hot.jsonl", 2**60 + i, None if i % 3 else "é") for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "path string, id long, t string").repartition(4)


def want(rows):
    out = {}
    for p, i, t in sorted(rows):
        out[p] = out.get(p, "") + json.dumps({"id": i, "t": t}, ensure_ascii=False, separators=(",", ":")) + "\n"
    return out


def test_one_file_for_each_path(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    routed.write_files(frame(spark, rows_of(200)), root, order=("id",))
    assert tree(tmp_path / "out") == want(rows_of(200))
    told = {r["path"]: (r["rows"], r["bytes"]) for r in routed.manifests(spark, root).collect()}
    assert told == {p: (t.count("\n"), len(t.encode())) for p, t in want(rows_of(200)).items()}
    assert not [n for n in os.listdir(tmp_path / "out") if "staging" in n]


def test_a_second_run_writes_what_is_missing(spark, tmp_path):
    root = str(tmp_path / "out")
    first = [r for r in rows_of(60) if r[0] != "hot.jsonl"]
    routed.write_files(frame(spark, first), root, order=("id",))
    before = {p: os.stat(os.path.join(root, p)).st_mtime_ns for p in tree(root)}
    routed.write_files(frame(spark, rows_of(60)), root, order=("id",))
    assert tree(root) == want(rows_of(60))
    assert all(os.stat(os.path.join(root, p)).st_mtime_ns == t for p, t in before.items())
    routed.write_files(frame(spark, rows_of(60)), root, order=("id",))
    assert len(os.listdir(os.path.join(root, "_manifests"))) == 2


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(Exception, match="not the name of a file"):  # in its task, when others have written
        routed.write_files(frame(spark, [*rows_of(60), ("zz/../../x", 1, "t")]), root)
    assert os.path.isdir(root) and os.listdir(root) == []
    routed.write_files(frame(spark, rows_of(60)), root, order=("id",))
    assert tree(root) == want(rows_of(60))


@pytest.mark.parametrize("name", [None, "/etc/x", "../x", "a/../../x", "_manifests/x", ""])
def test_names_that_leave_the_root_fail(spark, tmp_path, name):
    with pytest.raises(Exception, match="not the name of a file"):
        routed.write_files(spark.createDataFrame([(name, 1)], "path string, id long"), str(tmp_path / "out"))


def test_rows_of_a_file_in_two_tasks_fail(spark, tmp_path):
    spark.dataSource.register(routed.RoutedLines)
    df = spark.range(10, numPartitions=2).selectExpr("'x' AS path", "'v' AS value")
    with pytest.raises(Exception, match="several tasks"):
        df.write.format("routed_lines").mode("append").option("path", str(tmp_path / "out")).save()
    assert tree(tmp_path / "out") == {}


def test_no_rows(spark, tmp_path):
    routed.write_files(frame(spark, rows_of(4)).where("false"), str(tmp_path / "out"))
    assert routed.written(spark, str(tmp_path / "none")).count() == 0


def test_a_folder_is_packed_file_by_file_and_again(spark, tmp_path):
    from millrace.operators import packing

    raw = tmp_path / "data" / "set"
    raw.mkdir(parents=True)
    for k in range(3):
        lines = [{"id": f"r{k}{i}", "conversations": [{"role": "user", "text": f"q{i}"}, {"role": "assistant", "text": "a"}]} for i in range(4)]
        (raw / f"f{k}.jsonl").write_text("\n".join(map(json.dumps, [*lines, lines[0]])) + "\n\n")
    out = str(tmp_path / "jsonl")
    packing.process_folder(spark, str(raw), out)
    made = tree(out)
    assert sorted(made) == [f"set/f{k}.jsonl" for k in range(3)]
    told = [json.loads(x) for x in made["set/f1.jsonl"].splitlines()]
    assert [r["id"] for r in told[:-1]] == ["r10", "r11", "r12", "r13", "r10"] and told[-1]["content"] == packing.DUMMY
    os.remove(os.path.join(out, "set/f1.jsonl"))
    os.utime(os.path.join(out, "set/f0.jsonl"), ns=(1, 1))
    packing.process_folder(spark, str(raw), out)
    assert tree(out) == made and os.stat(os.path.join(out, "set/f0.jsonl")).st_mtime_ns == 1


def test_answers_in_files_named_by_rank(spark, tmp_path):
    from millrace.operators import inference

    talk = [{"role": "user", "text": "q", "responses": {}}, {"role": "assistant", "text": "a", "responses": {}}]
    df = spark.createDataFrame([(f"s{i}", talk) for i in range(7)], "id string, conversations array<struct<role:string,text:string,responses:map<string,string>>>")
    told = inference.by_rank(df, 3, ["id"], lambda: lambda p, x: p * 2, "m", concurrency=2).drop("pos")
    inference.save(told, str(tmp_path / "out"))
    made = tree(tmp_path / "out")
    assert {n: [json.loads(x)["id"] for x in t.splitlines()] for n, t in made.items()} == {"rank0.jsonl": ["s0", "s1", "s2"], "rank1.jsonl": ["s3", "s4"], "rank2.jsonl": ["s5", "s6"]}
    assert json.loads(made["rank0.jsonl"].splitlines()[0])["conversations"][1]["responses"] == {"m": "qq"}

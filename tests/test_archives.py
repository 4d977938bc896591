import io
import os
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import archives

NAMES = [f"d{i % 3}/x{i}.{'jpg' if i % 2 else 'json'}" for i in range(10)]


def body(i):
    r = random.Random(i)
    return bytes(r.randrange(256) for _ in range(400 + 300 * i)) + b"same " * 100


def make_zip(path):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("folder/", b"")
        for i, n in enumerate(NAMES):
            z.writestr(n, body(i), (zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED, zipfile.ZIP_BZIP2)[i % 3])
        z.writestr("empty.jpg", b"")


def make_tar(path, mode="w"):
    with tarfile.open(path, mode) as t:
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for i, n in enumerate([*NAMES, "long/" + "n" * 150 + ".jpg", "empty.jpg"]):
            raw = b"" if n == "empty.jpg" else body(i)
            m = tarfile.TarInfo(n)
            m.size = len(raw)
            t.addfile(m, io.BytesIO(raw))


@pytest.fixture(scope="module", params=["zip", "tar", "tgz"])
def archive(request, tmp_path_factory):
    folder = tmp_path_factory.mktemp(request.param)
    path = str(folder / f"a.{request.param}")
    make_zip(path) if request.param == "zip" else make_tar(path, "w:gz" if request.param == "tgz" else "w")
    return path, "zip" if request.param == "zip" else "tar"


def want(archive):
    path, kind = archive
    return sorted((m[0], m[1], m[2], m[3]) for m in (archives._zip if kind == "zip" else archives._tar)(open(path, "rb")))


def got(df):
    return sorted((r["member"], r["size"], r["is_file"], None if r["content"] is None else bytes(r["content"])) for r in df.collect())


def test_members_of_large_archives_are_dealt_out(spark, archive):
    path, kind = archive
    whole = archives.members(spark, path, kind)
    parts = archives.members(spark, path, kind, small=0, split=1_000)
    assert got(whole) == got(parts) == want(archive)
    some = [m for m in want(archive) if m[2] and m[0].endswith((".jpg", ".txt"))]
    assert got(archives.members(spark, path, kind, (".jpg", ".txt"))) == got(archives.members(spark, path, kind, (".jpg", ".txt"), small=0)) == some
    if not path.endswith("tgz"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert parts.where("is_file").select(F.spark_partition_id()).distinct().count() > 1
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_data_source(spark, archive):
    path, kind = archive
    spark.dataSource.register(archives.Archives)
    read = lambda **o: spark.read.format("archive").option("kind", kind).options(**o).load(path)
    assert got(read()) == want(archive)
    split = read(splitBytes=1_000)
    assert got(split) == want(archive)
    if not path.endswith("tgz"):
        assert split.rdd.getNumPartitions() > 3
    assert got(read(splitBytes=1_000, suffixes=".json,.txt")) == [m for m in want(archive) if m[0].endswith(".json")]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        asked = read(splitBytes=1_000, pushdown="true").where(F.col("member").endswith("3.jpg") & (F.col("size") > 10))
        assert got(asked) == [m for m in want(archive) if m[0].endswith("3.jpg")]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_members_that_are_not_wanted_are_not_unpacked(tmp_path, monkeypatch):
    path = str(tmp_path / "a.zip")
    make_zip(path)
    reader = archives.FilteringReader({"path": path, "kind": "zip", "splitBytes": "1000"})
    left = list(reader.pushFilters([archives.StringEndsWith(("member",), "3.jpg"), "other"]))
    assert left == ["other"]
    unpacked = []
    own = archives.content
    monkeypatch.setattr(archives, "content", lambda f, k, p: (unpacked.append(p[0]), own(f, k, p))[1])
    rows = [b.to_pylist()[0] for part in reader.partitions() for b in reader.read(part)]
    assert [r["member"] for r in rows] == unpacked == ["d0/x3.jpg"]
    whole = archives.ArchiveReader({"path": path, "kind": "zip", "splitBytes": "1000"}).partitions()
    read = sorted(p[0] for part in whole for _, places in part.parts for p in places)
    assert len(whole) > 3 and read == sorted(["folder/", "empty.jpg", *NAMES])


def test_a_broken_member_fails(tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x.bin", b"0123456789" * 10)
    raw = bytearray(open(path, "rb").read())
    raw[50] ^= 1
    open(path, "wb").write(raw)
    with open(path, "rb") as f, pytest.raises(ValueError, match="broken"):
        archives.content(f, "zip", archives.index(open(path, "rb"), "zip")[0])


def test_members_are_saved(spark, archive, tmp_path):
    path, kind = archive
    told = archives.save_members(archives.members(spark, path, kind, ".jpg"), f"file://{tmp_path}/out", "pre")
    saved = {r["saved"]: r["member"] for r in told.collect()}
    files = {m[0]: m[3] for m in want(archive) if m[0].endswith(".jpg")}
    assert {m: open(os.path.join(tmp_path, "out", s), "rb").read() for s, m in saved.items()} == files
    assert all(s == "pre_" + m.replace("/", "_") for s, m in saved.items())
    archives.save_members(archives.members(spark, path, kind, ".jpg"), str(tmp_path / "deep"), deep=True)
    assert {m: open(os.path.join(tmp_path, "deep", m), "rb").read() for m in files} == files

"""Archives as a table, and files written from rows."""

import pytest
from pyspark.sql import functions as F

from satchel.functions import archive_tasks
from satchel.operators import unpack
from satchel.sources import archive_source, files
from tests.conftest import tar_of, zip_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("archives")
    inner = zip_of([("in.txt", "inner")])
    (path / "a.zip").write_bytes(zip_of([("inner.zip", inner), ("d/one.txt", b"1" * 10), ("two.txt", b"2" * 2000)]))
    (path / "sub").mkdir()
    (path / "sub" / "b.tar").write_bytes(tar_of([("d/", b""), ("one.txt", b"B" * 50)], uname="me"))
    (path / "c.zip").write_bytes(zip_of([("x", b"x" * 500)])[:60])
    (path / "plain.txt").write_bytes(b"text")
    (path / "_SUCCESS").write_bytes(b"")
    archive_source.register(spark)
    return str(path)


def load(spark, folder, **options):
    return spark.read.format("archive").options(**options).load(folder)


def test_rows_equal_those_of_unpack(spark, folder):
    raw = files.read_files(spark, folder + "/*").unionByName(files.read_files(spark, folder + "/sub")).dropDuplicates(["source_path"])
    raw = raw.where("length > 0")
    for recursive in ("false", "true"):
        rows = load(spark, folder, recursive=recursive)
        whole = unpack.children(unpack.unpack(raw, recursive=recursive == "true", budget=-1)).select("entry_name", "depth", "content")
        got = rows.where("pos is not null").select("name", "depth", "data")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect())) and got.count() == 4
        assert rows.where("pos is null").count() == 4


def test_what_is_read_is_chosen(spark, folder):
    found = load(spark, folder, name="*.txt", minSize="101 B", emit="children").select("name", F.length("data"))
    assert [tuple(r) for r in found.collect()] == [("two.txt", 2000)]
    assert {r.name for r in load(spark, folder, glob="*.tar", emit="children").collect()} == {"one.txt"}
    parents = load(spark, folder, emit="parents")
    assert {r.error_class for r in parents.collect()} == {None, "CORRUPT", "NOT_AN_ARCHIVE"} and "data" not in parents.columns
    lean = load(spark, folder, withData="false", maxSize="50 B")
    assert sorted(r.name for r in lean.where("pos is not null").collect()) == ["d/one.txt", "one.txt"] and "data" not in lean.columns
    assert lean.where("pos is null").count() == 4  # a parent has no size
    with pytest.raises(Exception, match="emit"):
        load(spark, folder, emit="some")


def test_a_frame_gives_the_same_rows_whatever_was_asked_before(spark, folder):
    rows = load(spark, folder)
    assert rows.where("name = 'two.txt'").count() == 1 and rows.where("size = 10 or size = 2000").count() == 2
    assert rows.where("pos is null").count() == 4 and rows.count() == 8


def reader(folder, **options):
    source = archive_source.ArchiveSource({"path": folder, **options})
    return source.reader(source.schema())


def test_only_chosen_files_are_held(folder, monkeypatch):
    made = []
    whole = archive_tasks.entry_rows
    monkeypatch.setattr(archive_tasks, "entry_rows", lambda pos, entry, *given: made.append(entry.name) or whole(pos, entry, *given))
    for options, expected in (({"emit": "parents"}, []), ({"name": "two*"}, ["two.txt"])):
        made.clear()
        found = reader(folder, **options)
        assert sum(len(batch) for part in found.partitions() for batch in found.read(part)) == 4 + len(expected)
        assert made == expected


def test_partitions_follow_the_sizes(folder):
    found = reader(folder, partBytes="1 B")
    assert [p.paths for p in found.partitions()] == [[f"{folder}/{x}"] for x in ("a.zip", "c.zip", "plain.txt", "sub/b.tar")]
    assert len(reader(folder).partitions()) == 1


def test_files_are_written_and_read_back(spark, make_files, tmp_path):
    df = make_files(("1", "a.bin", b"\x00\x01"), ("2", "x/y/b.txt", b"text"), ("3", "none", None))
    files.write_files(df, f"file://{tmp_path}/out")
    files.write_files(df, f"{tmp_path}/out")
    assert {f.name: f.read_bytes() for f in (tmp_path / "out").iterdir()} == {"a.bin": b"\x00\x01", "b.txt": b"text", "none": b""}
    got = {r.filename: bytes(r.content) for r in files.read_files(spark, f"{tmp_path}/out").collect()}
    assert got == {"a.bin": b"\x00\x01", "b.txt": b"text"}  # Spark's reader leaves empty files out

"""Files listed by tasks: the rows of Spark's reader, and no file known to the driver."""

import os

import pytest
from pyspark.sql import functions as F

from satchel.operators import unpack
from satchel.plans.queries import QUERIES
from satchel.sources import files, samples
from tests.conftest import SMALL

NAMES = ("a.zip", "b.tar", "b c%20.t", "a{b}.zip", "_x=1", "_hidden", "_metadata", ".dot", "c._COPYING_", "é.zip")


def rows_of(df):
    return sorted(tuple(r) for r in df.select("file_id", "filename", "source_path", "mtime", "length").collect())


def filled(folder):
    folder.mkdir(parents=True)
    for i, name in enumerate(NAMES):
        (folder / name).write_bytes(b"x" * (i + 1))
        os.utime(folder / name, ns=(0, 10**18 + i * 1_234_567))
    (folder / "empty").write_bytes(b"")
    (folder / "link").symlink_to(folder / "a.zip")


def test_the_query_has_no_list_of_files(spark):
    """Before, the driver held each archive's path, and its part of a scan, while the query ran."""
    assert QUERIES["unpack_large"](spark, SMALL).inputFiles() == []


@pytest.mark.parametrize("glob", [None, "*.zip", "*.{zip,t[^x]r}", "?.*"])
def test_a_flat_folder(spark, tmp_path, glob):
    filled(tmp_path / "in")
    filled(tmp_path / "in" / "sub")
    for path in (f"{tmp_path}/in", f"file://{tmp_path}/in/", f"file:{tmp_path}/in"):
        read = files.read_files(spark, path, glob)
        listed = files.read_files(spark, path, glob, with_content=False)
        assert listed.columns == [c for c in read.columns if c != "content"] and listed.inputFiles() == []
        assert listed.dtypes == read.drop("content").dtypes
        assert rows_of(listed) == rows_of(read) != []


def test_subfolders_as_of_a_partitioned_table(spark, tmp_path):
    for folder in ("k=1", "k=2/j=1", "k=3/sub", "sub/k=4", "sub/none", "_tmp/k=5", ".dot/k=6", "k=7/_tmp"):
        filled(tmp_path / "in" / folder)
    listed = files.read_files(spark, f"{tmp_path}/in", with_content=False)
    deep = [p.relative_to(tmp_path) for p in (tmp_path / "in").rglob("*") if p.is_file() and p.stat().st_size]
    shown = {"a.zip", "b.tar", "b c%20.t", "a{b}.zip", "_x=1", "é.zip", "link"}
    wanted = [str(p) for p in deep if p.name in shown and "=" in str(p.parent) and not {"_tmp", ".dot"} & set(p.parts)]
    assert len(wanted) == 4 * len(shown)
    assert sorted(r.source_path for r in listed.collect()) == sorted(f"file:{tmp_path}/{p}" for p in wanted)
    for one in ("k=1", "k=2", "k=3", "k=7"):
        assert rows_of(files.read_files(spark, f"{tmp_path}/in/{one}", with_content=False)) == rows_of(files.read_files(spark, f"{tmp_path}/in/{one}"))


def test_what_tasks_cannot_list_is_left_to_the_driver(spark, tmp_path):
    filled(tmp_path / "a b")
    for path in (f"{tmp_path}/a b", f"{tmp_path}/a b/*.zip", f"{tmp_path}/a b/a.zip"):
        listed = files.read_files(spark, path, with_content=False)
        assert "content" not in listed.columns and rows_of(listed) == rows_of(files.read_files(spark, path)) != []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_files(spark, f"{tmp_path}/none", with_content=False)


def test_long_listings_come_in_batches(spark, tmp_path, monkeypatch):
    for i in range(25):
        (tmp_path / f"{i}.txt").write_bytes(b"x")
    monkeypatch.setattr(files.archive_tasks, "FLUSH_ROWS", 10)
    assert files.read_files(spark, str(tmp_path), with_content=False).count() == 25


def test_written_into_subfolders_and_read_back(spark, tmp_path):
    content = F.encode(F.concat(F.lit("text "), "id"), "UTF-8")
    rows = spark.range(500).select(F.concat(F.lit("x/"), "id", F.lit(".txt")).alias("filename"), content.alias("content"))
    for _ in range(2):  # a second time writes the same files
        files.write_files(rows.repartition(3), f"file://{tmp_path}/out", 16)
    assert {len(list(p.iterdir())) for p in (tmp_path / "out").iterdir()} <= set(range(15, 50))
    read = files.read_files(spark, f"{tmp_path}/out")
    assert {r.filename: bytes(r.content) for r in read.collect()} == {f"{i}.txt": b"text %d" % i for i in range(500)}
    assert rows_of(files.read_files(spark, f"{tmp_path}/out", with_content=False)) == rows_of(read)


def test_archives_of_a_listed_folder(spark, tmp_path):
    made = [(f"line-{i}.txt", b"%d" % i * 40) for i in range(7)]
    packed = [(f"{i}.zip", samples.pack_zip(made[: i % 7 + 1])) for i in range(40)]
    files.write_files(spark.createDataFrame(packed, "filename string, content binary"), f"{tmp_path}/out", 8)
    inbox = files.read_files(spark, f"{tmp_path}/out", with_content=False)
    rows = unpack.children(unpack.unpack_large(inbox, part_bytes="100 B")).collect()
    whole = unpack.children(unpack.unpack(files.read_files(spark, f"{tmp_path}/out"))).collect()
    told = [sorted((r.filename, r.parent_id, r.entry_name, bytes(r.content)) for r in found) for found in (rows, whole)]
    assert told[0] == told[1] and len(rows) == sum(i % 7 + 1 for i in range(40))

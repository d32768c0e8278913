"""Folders of many small archives by path: parts side by side are read in one walk."""

import io

import pyarrow as pa

from satchel.functions import archive_tasks
from satchel.operators import unpack
from satchel.sources import files, samples

FILES = [(f"line-{i}.txt", b"%d" % i * 40) for i in range(30)]
CUT = pa.struct(list(archive_tasks.CUT_FIELDS.items()))
PARTS = pa.schema([("tag", "string"), ("_path", "string"), ("_part", "int64"), ("_cut", CUT), ("_to", "int64"), ("_good", "bool")])
OPTIONS = archive_tasks.UnpackOptions(False, -1, True, True)


def tallied(paths, tags, part_bytes):
    batch = pa.RecordBatch.from_pydict({"_path": paths, "tag": tags})
    out = []
    for told in archive_tasks.tally_batches([batch], OPTIONS, part_bytes):
        for row in told.to_pylist():
            cuts = row["_cuts"]
            for at, cut in enumerate(cuts):
                to = cuts[at + 1]["files"] if at + 1 < len(cuts) else row["n_unpacked"]
                out.append({"tag": row["tag"], "_path": row["_path"], "_part": at, "_cut": cut, "_to": to, "_good": True})
    return sorted(out, key=lambda r: (r["_path"], r["_part"]))


def read(parts, monkeypatch):
    opened = []
    source = archive_tasks.remote_source
    monkeypatch.setattr(archive_tasks, "remote_source", lambda path: opened.append(path) or source(path))
    batches = list(archive_tasks.part_batches([pa.RecordBatch.from_pylist(parts, PARTS)], OPTIONS))
    monkeypatch.setattr(archive_tasks, "remote_source", source)
    return [r for b in batches for r in b.to_pylist()], opened


def test_parts_side_by_side_are_read_in_one_walk(tmp_path, monkeypatch):
    for name, data in (("a.zip", samples.pack_zip(FILES)), ("b.tar", samples.pack_tar(FILES, 1))):
        (tmp_path / name).write_bytes(data)
    paths = [str(tmp_path / x) for x in ("a.zip", "b.tar")]
    parts = tallied(paths, ["x", "y"], 200)
    assert len(parts) > 10
    rows, opened = read(parts, monkeypatch)
    assert opened == paths
    for path, tag in zip(paths, "xy"):
        assert [(r["name"], r["data"]) for r in rows if r["tag"] == tag and r["pos"]] == FILES
        assert sum(r["tag"] == tag and r["pos"] is None for r in rows) == 1
    # parts with a gap between them are walks of their own
    some, opened = read([p for p in parts if p["_part"] % 3 != 1], monkeypatch)
    assert len(opened) > 4 and all(r in rows for r in some) and len(some) < len(rows)


def test_one_path_in_two_rows_keeps_their_columns(tmp_path, monkeypatch):
    (tmp_path / "a.zip").write_bytes(samples.pack_zip(FILES))
    for tags in (["x", "y"], ["x", "x"]):
        rows, _ = read(tallied([str(tmp_path / "a.zip")] * 2, tags, 200), monkeypatch)
        found = sorted((r["tag"], r["pos"]) for r in rows if r["pos"])
        assert found == sorted((t, i + 1) for t in tags for i in range(30))


def test_small_archives_by_path(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.zip").write_bytes(samples.pack_zip(FILES[: i % 7 + 1]))
    inbox = files.read_files(spark, str(tmp_path)).drop("content")
    rows = unpack.children(unpack.unpack_large(inbox, part_bytes="100 B")).collect()
    assert len(rows) == sum(i % 7 + 1 for i in range(40))
    assert {(r.entry_name, bytes(r.content)) for r in rows} == set(FILES[:7])


def test_a_small_file_is_read_at_once(tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 1000)
    (tmp_path / "b").write_bytes(b"x" * (archive_tasks.READ_AHEAD_BYTES + 1))
    with archive_tasks.remote_source(str(tmp_path / "a")) as small, archive_tasks.remote_source(str(tmp_path / "b")) as large:
        assert isinstance(small, io.BytesIO) and small.read() == b"x" * 1000
        assert not isinstance(large, io.BytesIO) and len(large.read()) == archive_tasks.READ_AHEAD_BYTES + 1

"""Archives read without what is not needed: parents, members without bytes, early stop, chunks."""

import hashlib
import io

import pytest
from pyspark.sql import functions as F

from satchel.functions import archive_tasks, walker
from satchel.operators import contains, unpack
from satchel.sources import files
from tests.conftest import plan_of, tar_of, zip_of

PDF = b"%PDF-1.4\n"


def sampler():
    inner = zip_of([(f"in{i}", f"inner {i}") for i in range(7)])
    broken = bytearray(zip_of([("first", b"good" * 10), ("second", b"bad" * 10)], stored=True))
    broken[broken.index(b"badbad")] ^= 0xFF
    return [
        ("nested", zip_of([("inner.zip", inner), ("own.pdf", PDF), ("page", b"<html>")])),
        ("tar", tar_of([("d/", b""), ("d/a.txt", b"A"), ("b.txt", b"BB")], "w:gz", uname="me")),
        ("damaged", bytes(broken)), ("holds damage", zip_of([("b.zip", bytes(broken)), ("x", b"x")])),
        ("cut", tar_of([("a", b"x" * 2000)])[:1500]), ("empty", zip_of([])), ("text", b"no archive"), ("null", None),
    ]


@pytest.mark.parametrize("recursive", [False, True])
@pytest.mark.parametrize("fail_on_sub_error", [False, True])
def test_lean_forms_equal_the_full_one(make_files, recursive, fail_on_sub_error):
    df = make_files(*sampler())
    options = {"recursive": recursive, "fail_on_sub_error": fail_on_sub_error}
    full = unpack.unpack(df, **options)

    def rows(frame):
        return sorted(str(r.asDict()) for r in frame.select(sorted(frame.columns)).collect())

    assert rows(unpack.parents(unpack.unpack(df, emit="parents", **options))) == rows(unpack.parents(full))
    for emit in ("all", "children"):
        lean = unpack.children(unpack.unpack(df, emit=emit, with_data=False, **options))
        assert rows(lean) == rows(unpack.children(full).select(lean.columns))
        assert "content" not in lean.columns and len(rows(lean)) > 3
    with pytest.raises(ValueError):
        unpack.unpack(df, emit="some")


def test_what_is_not_asked_for_leaves_no_stage(make_files):
    df = make_files(("a", b"x"))
    for options in ({"emit": "parents"}, {"emit": "children", "with_data": False}):
        rows = unpack.unpack(df, **options)
        assert "data" not in rows.columns and plan_of(rows).count("MapInArrow") == 1


def test_nothing_is_held_without_data(monkeypatch):
    monkeypatch.setattr(archive_tasks, "HOLD_BYTES", 10_000)
    content = zip_of([(str(i), b"x" * 1000) for i in range(30)])
    source = io.BytesIO(content)
    walks = []
    whole = walker.walk
    monkeypatch.setattr(walker, "walk", lambda *given: walks.append(1) or whole(*given))
    options = archive_tasks.UnpackOptions(False, -1, True, True, "children", False)
    assert len(list(archive_tasks.archive_rows(source, options))) == 30 and len(walks) == 1
    assert len(list(archive_tasks.archive_rows(source, options._replace(with_data=True)))) == 30 and len(walks) == 3


class Counting(io.BytesIO):
    """Remembers the furthest byte read."""

    reached = 0

    def read(self, *size):
        data = super().read(*size)
        Counting.reached = max(Counting.reached, self.tell())
        return data

    def readinto(self, buffer):
        n = super().readinto(buffer)
        Counting.reached = max(Counting.reached, self.tell())
        return n

    def getbuffer(self):
        raise AssertionError("the whole content was asked for")


@pytest.mark.parametrize("wanted", ["text/plain", "text/html", "application/pdf", "application/octet-stream"])
def test_a_search_reads_up_to_its_match(monkeypatch, wanted):
    first = {"text/plain": b"plain text", "text/html": b" \n<html>", "application/pdf": PDF, "application/octet-stream": b"\x00"}[wanted]
    others = [c for c in (b"GIF89a", b"\x89PNG\r\n\x1a\n") for _ in range(3)]
    members = [(f"o{i}", c + b"\x00" * 3000) for i, c in enumerate(others)] + [("match", first + b" " * 5000)]
    data = tar_of([*members, *((f"l{i}", b"\xff\xd8\xff" * 30_000) for i in range(40))])
    monkeypatch.setattr(Counting, "reached", 0)
    monkeypatch.setattr(walker, "open_tar_member", lambda archive, info: archive.extractfile(info))
    found, error = archive_tasks.first_match(Counting(data), archive_tasks.SearchOptions(True, True, frozenset([wanted])))
    assert (found, error) == (wanted, None) and Counting.reached < 80_000 < len(data) // 10


def test_many_text_files_are_searched_in_little_memory(make_files):
    members = [(f"t{i}", b"text " * 50) for i in range(3000)] + [("x.pdf", PDF)]
    df = make_files(("z", zip_of(members)))
    (row,) = contains.contains_type(df, ["application/pdf", "text/html"]).collect()
    assert row.found_mime == "application/pdf"


@pytest.mark.parametrize("recursive", [False, True])
def test_a_large_file_comes_in_chunks(make_files, recursive):
    big = bytes(range(256)) * 40
    df = make_files(("z", zip_of([("big", big), ("small", b"s"), ("none", b""), ("even", b"e" * 2000)])), ("t", tar_of([("big", big)], "w:gz")))
    child = unpack.children(unpack.unpack(df, recursive=recursive, budget=-1, chunk_bytes=1000))
    by_file = {}
    for r in child.collect():
        by_file.setdefault((r.parent_id, r.entry_name), []).append(r)
    assert {k: len(v) for k, v in by_file.items()} == {("z", "big"): 11, ("z", "small"): 1, ("z", "none"): 1, ("z", "even"): 2, ("t", "big"): 11}
    for (_, name), rows in by_file.items():
        rows.sort(key=lambda r: r.chunk_index)
        assert [r.chunk_index for r in rows] == list(range(len(rows))) and len({r.file_id for r in rows}) == 1
        assert [r.chunks_sha256 is None for r in rows] == [True] * (len(rows) - 1) + [len(rows) == 1]
        content = b"".join(bytes(r.content) for r in rows)
        assert content == {"big": big, "small": b"s", "none": b"", "even": b"e" * 2000}[name]
        if len(rows) > 1:
            assert rows[-1].chunks_sha256 == hashlib.sha256(content).hexdigest()
    parents = unpack.parents(unpack.unpack(df, recursive=recursive, budget=-1, chunk_bytes=1000)).collect()
    assert {p.file_id: p.fragment_count for p in parents} == {"z": 4, "t": 1} and all(p.error is None for p in parents)
    with pytest.raises(ValueError):
        unpack.unpack(df, chunk_bytes=0)


def test_nested_archives_too_large_for_memory_are_read_where_they_lie(make_files, monkeypatch):
    inner = zip_of([(f"in{i}", f"inner {i}" * 50) for i in range(5)])
    df = make_files(("z", zip_of([("a.zip", inner), ("b.tgz", tar_of([("t", b"t" * 700)], "w:gz"))])), ("t", tar_of([("a.zip", inner)])))
    expected = unpack.children(unpack.unpack(df, recursive=True)).orderBy("parent_id", "fragment_index").collect()
    monkeypatch.setattr(walker, "NESTED_HOLD_BYTES", 0)
    monkeypatch.setattr(walker, "NESTED_MEMORY_BYTES", 0)
    assert unpack.children(unpack.unpack(df, recursive=True)).orderBy("parent_id", "fragment_index").collect() == expected
    assert len(expected) == 11


def test_lean_forms_by_path(spark, tmp_path):
    for name, content in sampler():
        (tmp_path / name.replace(" ", "_")).write_bytes(content or b"")
    df = files.read_files(spark, str(tmp_path))
    full = unpack.unpack_large(df, recursive=True, part_bytes=20)
    lean = unpack.unpack_large(df, recursive=True, part_bytes=20, with_data=False, emit="children")
    key = ["parent_id", "fragment_index", "entry_name", "mime_type"]
    assert sorted(unpack.children(lean).select(key).collect()) == sorted(unpack.children(full).select(key).collect())
    chunked = unpack.children(unpack.unpack_large(df, recursive=True, chunk_bytes=2, emit="children"))
    assert chunked.agg(F.sum(F.length("content"))).first() == unpack.children(full).agg(F.sum(F.length("content"))).first()


@pytest.mark.parametrize("kind", ["zip", "tar", "tar with long names"])
def test_parts_together_read_an_archive_once(monkeypatch, kind):
    name = "n" * 150 if kind == "tar with long names" else "f"
    members = [(f"{name}{i}", bytes([i]) * 20_000) for i in range(60)]
    data = zip_of(members, stored=True) if kind == "zip" else tar_of([("d/", b""), *members])
    read = [0]

    class Metered(io.BytesIO):
        def readinto(self, buffer):
            n = super().readinto(buffer)
            read[0] += n
            return n

    sources = lambda path: io.BufferedReader(Metered(data), 4096)
    monkeypatch.setattr(archive_tasks, "remote_source", sources)
    options = archive_tasks.UnpackOptions(False, -1, True, True)
    import pyarrow as pa

    (tallied,) = archive_tasks.tally_batches([pa.RecordBatch.from_pydict({"_path": ["x"]})], options, 100_000)
    cuts = [tuple(c.values()) for c in tallied.column("_cuts").to_pylist()[0]]
    assert len(cuts) == 12 and [c[:2] for c in cuts] == [(5 * i, 100_000 * i) for i in range(12)]
    assert read[0] < 1.3 * len(data)
    read[0] = 0
    found = []
    for at, cut in enumerate(cuts):
        to = cuts[at + 1][0] if at + 1 < len(cuts) else 60
        found += archive_tasks.part_rows(sources("x"), options, *cut, to)
    assert [(r[0], r[1], r[-1]) for r in found] == [(i + 1, n, d) for i, (n, d) in enumerate(members)]
    assert read[0] < 1.3 * len(data)


def test_parts_under_a_budget_pass_over_the_same_files(spark, tmp_path):
    sizes = [30, 90, 30, 5, 90, 20, 40, 1]
    (tmp_path / "a.tar").write_bytes(tar_of([(f"f{i}", b"x" * n) for i, n in enumerate(sizes)]))
    (tmp_path / "b.zip").write_bytes(zip_of([(f"f{i}", b"x" * n) for i, n in enumerate(sizes)]))
    (tmp_path / "c.tgz").write_bytes(tar_of([(f"f{i}", b"x" * n) for i, n in enumerate(sizes)], "w:gz"))
    df = files.read_files(spark, str(tmp_path))
    options = {"budget": 100, "fail_on_breach": False}
    whole = unpack.children(unpack.unpack(df, **options)).select("parent_id", "fragment_index", "entry_name", "content")
    parts = unpack.children(unpack.unpack_large(df, part_bytes=25, **options)).select(whole.columns)
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect())) and whole.count() == 15

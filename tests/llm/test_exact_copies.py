"""Exact copies by the extendible-hash index, against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from satchel.llm import extendible

SCHEMA = "doc_id long, text string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(lowered(text), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        stays = ids.index(keep)
        out += [(i, keep, len(ids), at == stays, digest) for at, i in enumerate(ids)]
    return out


def check(spark, rows, parts=4, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = [tuple(r) for r in extendible.duplicates(df, **options).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(rows)))


ROWS = [
    (1, None), (2, ""), (3, " "), (4, "Same TEXT"), (5, "same text"), (6, "SAME text "), (7, "ÄÖ İ"), (8, "äö İ"), (9, "Äö İ"),
    (4, "same text"), (5, "Same text"), (None, "same text"), (None, "alone"), (None, "ALONE"), (12, "x" * 300_000), (13, "X" * 300_000),
]


def test_nulls_ties_case_and_long_texts(spark):
    check(spark, ROWS)


def test_other_columns_and_an_empty_table(spark):
    names = ["key", "entry", "head", "salt", "slot", "n", "ids", "at", "sha256", "kept", "links"]
    rows = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("?") for c in names})
    found = extendible.duplicates(rows)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and found.count() == len(ROWS)
    assert extendible.duplicates(rows.where("false")).count() == 0


@pytest.mark.parametrize("bits", [1, 4, 64])
def test_keys_that_collide_are_chained_and_bytes_compared(spark, bits):
    rng = random.Random(bits)
    check(spark, [(i, f"text {rng.randrange(60)}") for i in range(400)], key_bits=bits, bucket_bytes=2_000)


def test_a_group_larger_than_a_bucket_goes_to_pages_and_rounds(spark):
    rows = [(i, "the same words again and again" if i % 3 else f"other {i}") for i in range(900)]
    # 30 scanning tasks give 30 entries of the large group, 3 to a page; the pages' texts meet in another round
    check(spark, rows, parts=30, bucket_bytes=500, page_entries=3)
    check(spark, rows, parts=30, bucket_bytes=500, page_entries=3, key_bits=2)


def test_entries_that_are_full_begin_anew(spark, monkeypatch):
    monkeypatch.setattr(extendible, "ENTRY_IDS", 3)
    monkeypatch.setattr(extendible, "HELD_BYTES", 200)
    monkeypatch.setattr(extendible, "SALT", 2)
    monkeypatch.setattr(extendible, "OUT_ROWS", 2)
    rows = [(i, ["a", "b" * 50, f"c{i}"][i % 3]) for i in range(200)]
    check(spark, rows, bucket_bytes=1_000)
    texts = [b"a", b"b", b"a", b"a", b"a"]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([1, 2, None, 3, 4]), "key": pa.array([7] * 5), "sha256": ["s"] * 5, "text": pa.array(texts, pa.binary())
    })
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    assert [(x[3], x[7], x[8]) for x in extendible._combined([batch])] == [(3, [1, None, 3], b"a"), (1, [2], b"b"), (1, [4], b"a")]


def test_a_directory_doubles_until_its_buckets_fit():
    rng = np.random.default_rng(1)
    cells = {int(c): int(s) for c, s in zip(rng.integers(0, 1 << 10, 400), rng.integers(1, 100, 400), strict=True)}
    where = extendible.directory(cells, 500, 10)
    loads = {}
    for cell, size in cells.items():
        bucket = int(where.slots[cell >> (10 - where.depth)])
        loads.setdefault(bucket, []).append((cell, size))
    assert len(where.slots) == 1 << where.depth and where.tasks == len(set(where.slots.tolist()))
    assert all(sum(s for _, s in held) <= 500 or len({c for c, _ in held}) == 1 for held in loads.values())
    # a bucket is one range of keys
    changes = np.flatnonzero(np.diff(where.slots)) + 1
    assert len(changes) + 1 == where.tasks
    assert extendible.directory({}, 10).tasks == 1


def test_keys_find_the_bucket_of_their_first_bits():
    where = extendible.Directory(2, np.array([0, 0, 1, 2], dtype=np.int32), {-1: (3, 4)}, 7)
    keys = np.array([0, 1 << 62, -(1 << 63), -(1 << 62), -1], dtype=np.int64)
    slots, paged = where.place(keys, np.array([5, 5, 5, 5, 5]))
    assert slots.tolist() == [0, 0, 1, 2, 4] and paged.tolist() == [False] * 4 + [True]

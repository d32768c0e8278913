"""The k-d tree against a plain recursion over all rows."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from satchel.llm import kd_shards

SMALL = "/root/testdata/sf0.001/documents.parquet"
TOP = (1 << kd_shards.CODE_BITS) - 1


def plain_codes(rows):
    """``doc_id`` with its four codes, from ``(doc_id, text, source, lang)``."""
    sizes = [len((r[1] or "").encode()) + kd_shards.OVERHEAD for r in rows]
    lengths = [len(r[1] or "") for r in rows]

    def scale(values):
        low, high = math.log2(min(values) + 1), math.log2(max(values) + 1)
        return [int((math.log2(v + 1) - low) / (high - low) * TOP) if high > low else 0 for v in values]

    def shares(column):
        held = Counter()
        for row, size in zip(rows, sizes, strict=True):
            held[row[column]] += size
        order = sorted(held, key=lambda v: (v is not None, (v or "").encode()))
        before = {v: sum(held[u] for u in order[:i]) for i, v in enumerate(order)}
        return [int(before[r[column]] / sum(sizes) * (TOP + 1)) for r in rows]

    return {r[0]: c for r, *c in zip(rows, scale(sizes), scale(lengths), shares(2), shares(3), strict=True)}


def plain_tree(rows, first, shards, out):
    """``rows``: ``(id, size, keys)``; the cut is the key up to which the bytes are nearest to the goal."""
    if shards == 1 or not rows:
        out.update({r[0]: first for r in rows})
        return
    codes = [[r[2][d] >> kd_shards.TIE_BITS for r in rows] for d in range(4)]
    wide = [max(c) - min(c) for c in codes]
    best = wide.index(max(wide))
    half, goal = shards // 2, sum(r[1] for r in rows) * (shards // 2) / shards
    below, left = 0, []
    for row in sorted(rows, key=lambda r: r[2][best]):
        if below + row[1] >= goal:
            if not goal - below < below + row[1] - goal:
                left.append(row)
            break
        below += row[1]
        left.append(row)
    ids = {r[0] for r in left}
    plain_tree(left, first, half, out)
    plain_tree([r for r in rows if r[0] not in ids], first + half, shards - half, out)


def test_codes_are_metadata(spark):
    draw = random.Random(3)
    rows = [
        (i, draw.choice(["é" * draw.randrange(400), "a" * draw.randrange(9000), "", None]),
         draw.choice(["web", "web", "Books", "ärchiv", "", None]), draw.choice(["de", "en", None]))
        for i in range(300)
    ]
    want = plain_codes(rows)
    got = kd_shards.keyed(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"))
    for row in got.collect():
        codes = [row[f"k_{d}"] >> kd_shards.TIE_BITS for d in kd_shards.DIMENSIONS]
        assert all(abs(a - b) <= 1 for a, b in zip(codes, want[row.doc_id], strict=True))


def test_tree_is_the_plain_one(spark):
    docs = spark.read.parquet(SMALL)
    keyed = kd_shards.keep(kd_shards.keyed(docs), "keys")
    rows = [(r.doc_id, r.size, [r[f"k_{d}"] for d in kd_shards.DIMENSIONS]) for r in keyed.collect()]
    assert len({k for r in rows for k in enumerate(r[2])}) == 4 * len(rows)  # no two rows share a key
    for shards in (2, 7, 24):
        want: dict = {}
        plain_tree(rows, 0, shards, want)
        assert {r.doc_id: r.shard for r in kd_shards.tree(keyed, shards).collect()} == want


def test_first_split_is_along_the_widest(spark):
    """Texts are all alike in size, so sources, half of the bytes each, are parted whole."""
    rows = [(i, f"{i:06d}", "ab"[i % 2], "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = kd_shards.shard(docs, shards=2).join(docs, "doc_id").groupBy("shard").agg(F.collect_set("source").alias("s"))
    assert sorted(r.s for r in found.collect()) == [["a"], ["b"]]


def test_very_many_values(spark):
    """A dimension of as many values as rows."""
    rows = [(i, "x" * 50, f"s{i:05d}", None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = kd_shards.shard(docs, shards=3).join(docs, "doc_id").groupBy("shard").agg(F.min("source"), F.max("source"), F.count("*"))
    assert [tuple(r)[1:] for r in found.orderBy("shard").collect()] == [
        ("s00000", "s00999", 1000), ("s01000", "s01999", 1000), ("s02000", "s02999", 1000)
    ]

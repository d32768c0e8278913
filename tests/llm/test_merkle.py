"""The Merkle manifest, against plain Python."""

import hashlib
import zlib
from itertools import count

import pytest
from pyspark.sql import functions as F

from satchel.llm import merkle, queries
from satchel.llm.extendible import lowered

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """The root, and for each node its path from below."""
    paths = [[] for _ in nodes]
    at = {i: [i] for i in range(len(nodes))}
    while len(nodes) > 1:
        above, under = [], {}
        for start in range(0, len(nodes), 16):
            run = nodes[start : start + 16]
            for place, _ in enumerate(run):
                for i in at[start + place]:
                    paths[i].append((run[:place], run[place + 1 :]))
            under[len(above)] = [i for place in range(len(run)) for i in at[start + place]]
            above.append(h(*run))
        nodes, at = above, under
    return nodes[0], paths


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for source in order:
        held = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        subs[source] = (held, *climb([leaf(*r) for r in held]))
    root, tops = climb([subs[s][1] for s in order])
    out = []
    for source, top in zip(order, tops, strict=True):
        held, subroot, paths = subs[source]
        for row, path in zip(held, paths, strict=True):
            path = path + top
            found = leaf(*row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                found = leaf(*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))
            for before, after in path:
                found = h(*before, found, *after)
            out.append((row[0], leaf(*row), subroot, root, h(*(d for b, a in path for d in b + a)), found, found == root))
    return out


def prove(df):
    touched = F.when(queries.crc_mod("doc_id", 5) == 0, merkle.digest(*(
        merkle.field(lowered(F.col(c)) if c == "text" else F.col(c)) for c in queries.LEAF
    )))
    return merkle.prove(df, queries.LEAF, "doc_id", "source", touched)


def check(spark, rows):
    got = prove(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected(rows)))


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 1], [300, 1, 16, 17], [3] * 18])
def test_trees_of_many_shapes(spark, sizes):
    ids = count(1)
    rows = [(next(ids), f"s{s}", "en", i, f"Text {i} of {s}") for s, n in enumerate(sizes) for i in range(n)]
    check(spark, rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "", "", 0, ""), (1, None, "", 0, ""), (2, "-", "é", 5, "ÄÖ Abc"),
        (7, "a", None, -3, "x" * 100_000), (7, "a", None, -3, "X"), *[(5, "a", "en", 1, "again and Again")] * 40, (-12, "é", "en", 1, "minus"),
    ]
    check(spark, rows)


def test_other_columns_and_an_empty_table(spark):
    names = ["tree", "rank", "leaf", "number", "digest", "children", "path", "digit", "position", "asked", "tampered"]
    rows = spark.createDataFrame([(1, "a", "en", 1, "T"), (5, "b", "en", 1, "T")], SCHEMA).withColumns({c: F.lit("?") for c in names})
    found = prove(rows)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and found.count() == 2
    assert prove(rows.where("false")).count() == 0


def test_proofs_of_some_rows_only(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"text {i}") for i in range(700)]
    docs = spark.createDataFrame(rows, SCHEMA)
    leaves = merkle.leaves_of(docs, "doc_id", "source", queries.LEAF)
    manifest = merkle.build(leaves)
    some = leaves.where("doc_id in (0, 1, 350, 699)")
    got = merkle.paths(manifest, some).select("doc_id", merkle.folded(F.col("leaf"), F.col("path")).alias("r"), F.size("path").alias("n"))
    assert {(r.doc_id, r.r, r.n) for r in got.collect()} == {(i, manifest.root, 3) for i in (0, 1, 350, 699)}
    nowhere = spark.createDataFrame([("=s0", 5000), ("=none", 0), ("=s1", 239)], "tree string, rank long")
    assert merkle.paths(manifest, nowhere).count() == 0
    # whatever changes in a row, the root changes
    other = docs.withColumn("n_chars", F.expr("if(doc_id = 350, 0, n_chars)"))
    assert merkle.build(merkle.leaves_of(other, "doc_id", "source", queries.LEAF)).root != manifest.root

"""A Merkle manifest of a dataset: digests of rows, runs of digests, and proofs read from them by descent.

The manifest is content-addressed: a record says which children a digest has, and a node is found by its digest alone.
Leaves are ranked within their tree (a source); every 16 nodes in a row become the digest of their digests until one is
left, the subroot; subroots become the root in the same way.  Each level is one grouping of nodes by tree and number, in
which a group holds 16 rows at most, and is written before the next.

Proofs are read from the root down.  A request is a rank, and its digits to base 16 say which child to take at each
level; the children not taken are a segment of its path, and the reversed segments are the proof.  Requests that share
the digits so far are one row, so a level has as many rows as nodes asked for and the root is no hot key; only the last
step, out of a run of 16 leaves, gives a row for each request, in the task that already holds the run.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satchel.llm.ranks import numbered
from satchel.llm.scratch import keep

FAN = 16
SEGMENT = "array<struct<before:string,after:string>>"


class Manifest(NamedTuple):
    """``subroots``: ``tree, height, digest, position`` among the trees; ``records`` and ``top``: for each level from the
    leaves up a table ``tree, number, digest, children``, of the trees and of the tree of their subroots; ``root``: a
    digest, None for an empty dataset."""

    records: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None


def field(column: Column) -> Column:
    """A value with its length in bytes before it, ``-`` for a null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _children(nodes: DataFrame, fan: int) -> DataFrame:
    """The nodes of the next level; a tree's only node has no digest of its own yet and is number 0 with one child."""
    by_run = nodes.groupBy("tree", F.expr(f"number div {fan}").alias("number"))
    runs = by_run.agg(F.sort_array(F.collect_list(F.struct("number", "digest"))).alias("run"))
    return runs.select("tree", "number", F.col("run.digest").alias("children"))


def climb(nodes: DataFrame, fan: int = FAN) -> tuple[list[DataFrame], DataFrame]:
    """Records of each level over ``nodes`` (``tree, number, digest``, numbered from 0), and ``tree, height, digest``."""
    levels, tops = [], []
    alone = (F.col("number") == 0) & (F.size("children") == 1)
    while True:
        runs = keep(_children(nodes, fan), f"level-{len(levels)}")
        tops.append(runs.where(alone).select("tree", F.lit(len(levels)).alias("height"), F.col("children")[0].alias("digest")))
        level = runs.where(~alone).withColumn("digest", F.sha2(F.concat_ws("", "children"), 256))
        if level.isEmpty():
            break
        levels.append(level.select("tree", "number", "digest", "children"))
        nodes = level.select("tree", "number", "digest")
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    return levels, keep(roots, "subroots")


def build(leaves: DataFrame, fan: int = FAN) -> Manifest:
    """The manifest of ``leaves``: ``tree`` (a string that orders the trees by its bytes), ``rank`` in it from 0, ``leaf``."""
    records, subroots = climb(leaves.select("tree", F.col("rank").alias("number"), F.col("leaf").alias("digest")), fan)
    placed = keep(numbered(subroots, ["tree"], "position"), "trees")
    top, root = climb(placed.select(F.lit("").alias("tree"), F.col("position").alias("number"), "digest"), fan)
    first = root.first()
    return Manifest(records, placed, top, first["digest"] if first else None)


def _opened(at: DataFrame, records: DataFrame, fan: int) -> DataFrame:
    """Every child of the nodes ``at`` (``tree, number, digest, path, ...``), its siblings added to the path."""
    # Equal digests have equal children, so one record serves them all.
    known = records.groupBy("digest").agg(F.first("children").alias("children"))
    others = [c for c in at.columns if c not in ("tree", "number", "digest", "path")]
    each = at.join(known, "digest").select("tree", "number", "path", *others, "children", F.posexplode("children").alias("digit", "digest"))
    return each.select(
        "tree", (F.col("number") * fan + F.col("digit")).alias("number"), "digest",
        _extended(F.col("digit"), fan).alias("path"), *others,
    )


def _extended(digit: Column, fan: int) -> Column:
    before = F.concat_ws("", F.slice("children", F.lit(1), digit))
    after = F.concat_ws("", F.slice("children", digit + 2, F.lit(fan)))
    return F.concat("path", F.array(F.struct(before.alias("before"), after.alias("after"))))


def paths(manifest: Manifest, requests: DataFrame, fan: int = FAN) -> DataFrame:
    """``requests`` (``tree``, ``rank``, any other columns; a rank of a tree at most once) with ``subroot`` and ``path``.

    ``path`` goes from the leaf up to the root; of each level it holds the digests before and after the node, as text.
    Requests for a rank that is not there give no row.
    """
    carried = [c for c in requests.columns if c not in ("tree", "rank")]
    # A run has at most 16 ranks, so a bundle has at most 16 requests.
    bundles = keep(
        requests.groupBy("tree", F.expr(f"rank div {fan}").alias("number")).agg(
            F.collect_list(F.struct(F.expr(f"cast(rank % {fan} as int)").alias("digit"), "rank", *carried)).alias("asked")
        ),
        "requests",
    )
    wanted = [bundles.select("tree", "number")]
    for _ in manifest.records[1:]:
        wanted.append(wanted[-1].select("tree", F.expr(f"number div {fan}").alias("number")).distinct())
    # From the root to the subroots of the trees asked for.
    asked = manifest.subroots.join(wanted[-1].select("tree").distinct(), "tree", "left_semi")
    ways = [asked.select("position")]
    for _ in manifest.top[1:]:
        ways.append(ways[-1].select(F.expr(f"position div {fan}").alias("position")).distinct())
    spark = requests.sparkSession
    at = spark.createDataFrame([("", 0, manifest.root, [])], f"tree string, number long, digest string, path {SEGMENT}")
    for records, way in zip(reversed(manifest.top), reversed(ways), strict=False):
        at = _opened(at, records, fan).join(way.withColumnRenamed("position", "number"), "number", "left_semi")
    starts = asked.join(at.select(F.col("number").alias("position"), "path"), "position").select(
        "tree", F.lit(0).cast("long").alias("number"), "digest", "path", F.col("digest").alias("subroot"), "height"
    )
    starts = keep(starts, "starts")
    # From the subroots to the runs of leaves; a tree joins in at its own height.
    at = None
    for level in range(len(manifest.records), 0, -1):
        own = starts.where(F.col("height") == level).drop("height")
        at = own if at is None else own.unionByName(at.join(wanted[level - 1], ["tree", "number"], "left_semi"))
        if level > 1:
            at = keep(_opened(at, manifest.records[level - 1], fan), f"descent-{level}")
    lone = starts.where("height = 0").join(bundles, ["tree", "number"])
    found = lone.select("tree", "subroot", "path", F.explode("asked").alias("asked"))
    if at is not None:
        known = manifest.records[0].groupBy("digest").agg(F.first("children").alias("children"))
        runs = at.join(known, "digest").join(bundles, ["tree", "number"])
        each = runs.select("tree", "subroot", "path", "children", F.explode("asked").alias("asked"))
        within = each.where(F.col("asked.digit") < F.size("children"))
        found = found.unionByName(within.select("tree", "subroot", _extended(F.col("asked.digit"), fan).alias("path"), "asked"))
    return found.select("tree", "asked.rank", *(F.col("asked")[c].alias(c) for c in carried), "subroot", F.reverse("path").alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda found, level: digest(level["before"], found, level["after"]))


def proof(path: Column) -> Column:
    """One digest over all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda level: F.concat(level["before"], level["after"]))), 256)


def leaves_of(docs: DataFrame, order: str, tree: str, columns: Sequence[str], **more: Column) -> DataFrame:
    """``tree, rank, leaf`` and ``order`` for each row of ``docs``: ranks ascend by ``order`` within a tree.

    A null ``tree`` comes before all others, a null ``order`` before all others of its tree; rows alike in ``order`` go by
    their leaves, so repeated rows are leaves each and it does not matter which is which.  ``more`` columns ride along.
    """
    leaf = digest(*(field(F.col(c)) for c in columns))
    # No name is shorter than this mark, so a null is before an empty one.
    name = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    rows = docs.select(name.alias("tree"), F.col(order).alias("_order"), leaf.alias("leaf"), *(c.alias(n) for n, c in more.items()))
    # Written first: ranking by range reads its input twice, which would hash every text twice.
    ranked = numbered(keep(rows, "leaves"), ["_order", "leaf"], "rank", ["tree"])
    return keep(ranked.withColumnRenamed("_order", order), "ranked")


def prove(docs: DataFrame, columns: Sequence[str], order: str, tree: str, tampered: Column, fan: int = FAN) -> DataFrame:
    """For each row of ``docs`` its leaf, the root, its proof, and the root that its leaf, or a tampered one, folds to.

    ``tampered``: the digest to fold instead, null for rows that nobody touched.  Returns ``order``, ``leaf, subroot, root,
    proof_sha256, folded_root, verified``.  Nulls in any column are digested as such; extra columns are left out, whatever
    they are called; an empty table gives an empty one; a tree with one row has its leaf as its subroot.
    """
    leaves = leaves_of(docs, order, tree, columns, tampered=tampered)
    manifest = build(leaves, fan)
    if manifest.root is None:
        names = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.select(order).where("false").join(docs.sparkSession.createDataFrame([], names))
    found = paths(manifest, leaves, fan).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    root = F.lit(manifest.root)
    return found.select(
        order, "leaf", "subroot", root.alias("root"), proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )

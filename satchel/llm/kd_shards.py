"""Shards by a k-d tree over metadata.

A node is split along the metadata dimension that is widest in it, at the weighted median of the rows' bytes, until each
leaf holds the target bytes.  The dimensions are the text's bytes and its characters, both on a logarithmic scale from
the table's least to its largest, and source and language, each value at the share of all bytes that lies in smaller
values.  So all have one scale, on which widths compare.  Where the median falls among rows of one value, checksums
of the text and then of the id part them.

All nodes of a level are split together: rows are counted into bins of their node's range, the bin that the median falls
into is cut into bins again, and so on until a single value is left.  Only narrow rows take part, and only sums over
bins leave the tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satchel.llm.ranks import numbered, running
from satchel.llm.scratch import keep

DIMENSIONS = ("size", "length", "source", "lang")
CODE_BITS, TIE_BITS = 20, 42  # a key is a dimension's code, then the tie of equal codes
BINS = 1024
OVERHEAD = 8  # bytes of a row besides its text


def _hash_bits(bits: int, *columns: str | Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - bits)


def _on_scale(name: str, least: int, largest: int) -> Column:
    """Where a number lies between the table's least and largest, by logarithms."""
    low, span = math.log2(least + 1), math.log2(largest + 1) - math.log2(least + 1)
    if not span:
        return F.lit(0).cast("long")
    at = F.floor((F.log2(F.col(name) + 1) - low) / span * ((1 << CODE_BITS) - 1))
    return F.greatest(F.lit(0), F.least(F.lit((1 << CODE_BITS) - 1), at)).cast("long")


def _value(docs: DataFrame, name: str) -> Column:
    """A value as text; null comes before all values, and a column that is not there is null."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("")) if name in docs.columns else F.lit("")


def positions(rows: DataFrame, names: tuple[str, ...], total: int) -> dict[str, DataFrame]:
    """For each column: ``<name>, c_<name>``, its values with the share of the bytes in smaller ones."""
    named = [F.struct(F.lit(n).alias("_dimension"), F.col(n).alias("_value")) for n in names]
    values = rows.select("size", F.inline(F.array(*named))).groupBy("_dimension", "_value").agg(F.sum("size").alias("_bytes"))
    placed = keep(running(values, ["_value"], ["_dimension"], F.col("_bytes"), "_before"), "positions")
    code = F.floor(F.col("_before") / F.lit(float(max(total, 1))) * (1 << CODE_BITS)).cast("long")
    return {
        n: placed.where(F.col("_dimension") == n).select(F.col("_value").alias(n), code.alias(f"c_{n}")) for n in names
    }


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32`` and a key for each dimension; equal texts are neighbours in each."""
    text = F.coalesce("text", F.lit(""))
    octets = F.encode(text, "UTF-8")
    rows = keep(
        docs.select(
            "doc_id", (F.octet_length(octets) + OVERHEAD).cast("long").alias("size"), F.length(text).alias("length"),
            F.crc32(octets).alias("text_crc32"), *(_value(docs, n).alias(n) for n in ("source", "lang")),
        ),
        "metadata",
    )
    ends = rows.agg(F.sum("size"), *(f(n) for n in ("size", "length") for f in (F.min, F.max))).first()
    total, *spans = (x or 0 for x in ends)
    placed = rows
    for name, places in positions(rows, ("source", "lang"), total).items():
        placed = placed.join(places, name)
    tie = F.shiftleft(_hash_bits(TIE_BITS // 2, "text_crc32", "size"), TIE_BITS // 2).bitwiseOR(
        _hash_bits(TIE_BITS // 2, "doc_id")
    )
    codes = {
        "size": _on_scale("size", *spans[:2]),
        "length": _on_scale("length", *spans[2:]),
        "source": F.col("c_source"),
        "lang": F.col("c_lang"),
    }
    keys = [F.shiftleft(codes[d], TIE_BITS).bitwiseOR(tie).alias(f"k_{d}") for d in DIMENSIONS]
    return placed.select("doc_id", "size", "text_crc32", *keys)


def _widest(rows: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """For each node: its bytes, the number of its widest dimension, and the range of keys there."""
    ends = [f(f"k_{d}").alias(f"{name}_{d}") for d in DIMENSIONS for name, f in (("lo", F.min), ("hi", F.max))]
    found = {}
    for row in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect():
        # Codes of all dimensions have one scale, so their ranges compare; ties go to the first dimension.
        wide = [(row[f"hi_{d}"] >> TIE_BITS) - (row[f"lo_{d}"] >> TIE_BITS) for d in DIMENSIONS]
        best = wide.index(max(wide))
        found[row["node"]] = (row["bytes"], best, row[f"lo_{DIMENSIONS[best]}"], row[f"hi_{DIMENSIONS[best]}"])
    return found


def _medians(rows: DataFrame, nodes: dict[int, tuple[int, int, int, int]], goals: dict[int, float]) -> dict[int, int]:
    """For each node the key up to which its rows hold nearest to ``goals`` bytes."""
    spark = rows.sparkSession
    open_ = {node: (dimension, lo, hi, 0) for node, (_, dimension, lo, hi) in nodes.items()}
    cuts: dict[int, int] = {}
    key = F.element_at(F.array(*[f"k_{d}" for d in DIMENSIONS]), F.col("_dim") + 1)
    while open_:
        table = spark.createDataFrame(
            [(n, d, lo, hi, -(-(hi - lo + 1) // BINS), below, goals[n]) for n, (d, lo, hi, below) in open_.items()],
            "node long, _dim int, _lo long, _hi long, _step long, _below long, _goal double",
        )
        # One row per node, and nodes are at most the shards.
        inside = rows.join(F.broadcast(table), "node").withColumn("_key", key).where("_key between _lo and _hi")
        bins = inside.groupBy("node", F.expr("(_key - _lo) div _step").alias("bin")).agg(
            F.sum("size").alias("bytes"), F.min("_key").alias("lo"), F.max("_key").alias("hi"),
            F.first("_below").alias("_below"), F.first("_goal").alias("_goal"),
        )
        order = Window.partitionBy("node").orderBy("bin")
        upto = bins.withColumn("upto", F.col("_below") + F.sum("bytes").over(order))
        # The first bin that reaches the goal, and the last key before it.
        before = upto.withColumn("last", F.lag("hi").over(order)).where("upto >= _goal")
        first = before.withColumn("_r", F.row_number().over(order)).where("_r = 1")
        hit = {row["node"]: row for row in first.collect()}
        for node in list(open_):
            dimension, lo, hi, below = open_.pop(node)
            row = hit.get(node)
            if row is None:
                cuts[node] = hi
            elif row["lo"] == row["hi"]:
                under = row["upto"] - row["bytes"]
                nearer = goals[node] - under < row["upto"] - goals[node]
                cuts[node] = row["lo"] - 1 if nearer else row["lo"]
            else:
                open_[node] = (dimension, row["lo"], row["hi"], row["upto"] - row["bytes"])
    return cuts


def tree(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (from ``keyed``) with ``shard``, 0 to ``shards`` - 1, each with near the same bytes."""
    spark = rows.sparkSession
    at = rows.withColumn("node", F.lit(0).cast("long"))
    leaves = {0: (0, shards)}  # node: first shard and number of shards below it
    while split := {node: span for node, span in leaves.items() if span[1] > 1}:
        nodes = _widest(at.where(F.col("node").isin(*split)))
        goals = {n: nodes[n][0] * (split[n][1] // 2) / split[n][1] for n in nodes}
        cuts = _medians(at, nodes, goals)
        table = [(n, nodes[n][1], cuts[n], split[n][0], split[n][0] + split[n][1] // 2) for n in nodes]
        made = spark.createDataFrame(table, "node long, _dim int, _cut long, _left long, _right long")
        key = F.element_at(F.array(*[f"k_{d}" for d in DIMENSIONS]), F.col("_dim") + 1)
        child = F.when(F.col("_dim").isNull(), F.col("node")).when(key <= F.col("_cut"), F.col("_left")).otherwise(F.col("_right"))
        at = keep(at.join(F.broadcast(made), "node", "left").withColumn("node", child).select(at.columns), "level")
        # A node is named by its first shard, so a leaf's name is its shard.
        leaves = {n: (first, count) for n, (first, count) in leaves.items() if count == 1}
        for first, count in split.values():
            half = count // 2
            leaves[first], leaves[first + half] = (first, half), (first + half, count - half)
    return at.withColumnRenamed("node", "shard")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs`` (``doc_id, text`` and, if there, ``source, lang``).

    Give the number of shards or the bytes one should hold.  ``size`` is the text's UTF-8 bytes and eight more; a null text
    has none and the checksum of an empty one.  ``slot`` numbers a shard's rows from 0 by ``doc_id``.  Equal texts lie side
    by side in every dimension and so mostly in one shard, but a group of copies larger than a shard is split.  Repeated
    rows are placed each; null sources and languages are values of their own; an empty table gives an empty one.
    """
    rows = keep(keyed(docs), "keys")
    if shards is None:
        if not target_bytes:
            raise ValueError("give shards or target_bytes")
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, round(total / target_bytes))
    placed = tree(rows, shards).select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"))
    return numbered(placed, ["doc_id", "text_crc32"], "slot", ["shard"])

"""Mixing sources to target weights by Pfair scheduling; rows are placed with DataFrame functions only.

Each source's documents, in a hashed order, are cut into blocks of equal bytes.  In a schedule of one block a slot, block i
of a source with weight w is released at floor(i / w) and due at ceil((i + 1) / w), and earliest deadline first then
never is a whole block off the target.  Both bounds are those of the exact weights over running block numbers, so nothing
adds up, however long the mix.  The schedule is a row for each block, not for each document; the driver makes it in
one pass in memory that does not grow and writes it in chunks, and documents meet it by the number of their block.

No document is dropped or repeated.  A source that runs out ends a phase, and the others share the slots from then on;
a phase counts its slots and its blocks from where it starts.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satchel.llm.ranks import numbered, running
from satchel.llm.scratch import keep, new_path

BLOCK_BYTES = 1 << 16
EXPONENT = 0.5  # of the default weights: source bytes to this power
NO_SOURCE = "(none)"
CHUNK = 1 << 18  # blocks of the schedule on the driver at a time
SCHEDULE = "_s long, block long, phase long, slot long, release long, deadline long"


def schedule(blocks: list[int], weights: list[Fraction]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """``(source, block, phase, slot, release, deadline)`` for every block, by slot."""
    left, done, start, phase = list(blocks), [0] * len(blocks), 0, 0
    while active := [s for s, n in enumerate(left) if n]:
        scale = math.lcm(*(weights[s].denominator for s in active))
        share = {s: int(weights[s] * scale) for s in active}
        total = sum(share.values())
        # Of each source the next block waits for its release or is ready for its slot.
        waiting, ready = [(0, s, 0) for s in active], []
        slot, first = 0, {s: done[s] for s in active}
        s = active[0]
        while left[s]:  # the source served last; the first one to run out ends the phase
            while waiting and waiting[0][0] <= slot:
                release, s, i = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(i + 1) * total // share[s]), s, i, release))
            deadline, s, i, release = heapq.heappop(ready)
            yield s, first[s] + i, phase, start + slot, start + release, start + deadline
            left[s], done[s], slot = left[s] - 1, done[s] + 1, slot + 1
            heapq.heappush(waiting, ((i + 1) * total // share[s], s, i + 1))
        start, phase = start + slot, phase + 1


def _written(spark: SparkSession, rows: Iterator[tuple[int, ...]]) -> DataFrame:
    """The schedule as a table, chunk by chunk."""
    import pyarrow as pa

    path, names = new_path(spark, "schedule"), [x.split()[0] for x in SCHEDULE.split(", ")]
    while some := list(islice(rows, CHUNK)):
        columns = [pa.array(c, pa.int64()) for c in zip(*some, strict=True)]
        spark.createDataFrame(pa.table(columns, names)).write.mode("append").parquet(path)
    return spark.read.schema(SCHEDULE).parquet(path)


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id, text, source``) with its place in the mix.

    ``doc_id, source, size, block, phase, slot, release, deadline, position``: ``size`` in bytes, ``block`` the number of
    the block of its source in which the document starts, ``slot`` the block's place in the mix, ``release`` and
    ``deadline`` the bounds of the slot, ``position`` the row's number in the mix, from 0 and without gaps.

    ``weights`` of sources that are missing count as the smallest one given; by default a source weighs its bytes to the
    power ``EXPONENT``.  A null source is one called ``(none)``; null and empty texts have size 0 and stay with the
    document before them.  Repeated rows are placed each; extra columns are left out; an empty table gives an empty one.
    A row for each source, of which there are few, comes to the driver, which makes the schedule.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        "doc_id", F.coalesce("source", F.lit(NO_SOURCE)).alias("source"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"), F.xxhash64("doc_id").alias("_h"),
    )
    started = running(narrow, ["_h", "doc_id"], ["source"], F.col("size"), "_start")
    blocked = keep(started.withColumn("block", F.expr(f"_start div {block_bytes}")), "blocks")
    by_source = blocked.groupBy("source").agg(F.sum("size").alias("bytes"), (F.max("block") + 1).alias("n"))
    sources = keep(by_source.withColumn("_s", F.row_number().over(Window.orderBy("source")).cast("long") - 1), "sources")
    rows = sorted(sources.collect(), key=lambda row: row["_s"])
    if not rows:
        placed = blocked.withColumns({c: F.lit(None).cast("long") for c in ("phase", "slot", "release", "deadline")})
    else:
        if weights is None:
            given = [Fraction(max(row["bytes"], 1) ** EXPONENT) for row in rows]
        else:
            least = min((Fraction(w) for w in weights.values() if w > 0), default=Fraction(1))
            given = [Fraction(weights[row["source"]]) if weights.get(row["source"], 0) > 0 else least for row in rows]
        slots = _written(spark, schedule([row["n"] for row in rows], given))
        placed = blocked.join(sources.select("source", "_s"), "source").join(slots, ["_s", "block"]).drop("_s")
    return numbered(placed, ["slot", "_start", "_h", "doc_id"], "position").select(
        "doc_id", "source", "size", "block", "phase", "slot", "release", "deadline", "position"
    )

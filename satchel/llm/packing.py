"""Packing documents into windows of tokens by best fit, longest first.

An overlong document is first cut into full windows, which need no search; its rest is packed with the other documents.
Best fit decreasing asks only for lengths, and lengths are below the window, so the search runs over how many pieces
there are of each length: a segment tree indexed by remaining capacity gives the tightest open windows, and pieces of
one length fill windows of one capacity in runs.  The search is therefore as large as the window, whatever the corpus,
and gives just what placing piece after piece gives.  Each piece then finds its run by its rank among its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satchel.llm.ranks import numbered
from satchel.llm.scratch import keep
from satchel.llm.tokens import encoder

WINDOW = 4096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
RUNS = "length long, from_rank long, to_rank long, first long, each long, offset long"


class CapacityTree:
    """Leaves 0 to ``window``; a node knows whether any leaf below it is set."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.set = bytearray(2 * self.size)

    def put(self, capacity: int, is_open: bool) -> None:
        at = self.size + capacity
        self.set[at] = is_open
        while at > 1:
            at //= 2
            self.set[at] = self.set[2 * at] or self.set[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that is set."""
        at = self.size + length
        if self.set[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.set[at + 1]:
                at += 1
                break
            at //= 2
        else:
            return None
        while at < self.size:
            at = 2 * at if self.set[2 * at] else 2 * at + 1
        return at - self.size


def best_fit(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, from_rank, to_rank, first window, pieces in each, offset of the first in its window)``."""
    tree = CapacityTree(window)
    open_windows: dict[int, list[tuple[int, int]]] = {}
    runs, opened = [], 0

    def leave(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            open_windows.setdefault(capacity, []).append((first, n))
            tree.put(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        while n:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = window
                first, there = opened, n // min(window // length, n)
                opened += there
            else:
                first, there = open_windows[capacity].pop()
                tree.put(capacity, bool(open_windows[capacity]))
            # Once a piece lies in a window, that window is the tightest for the next piece of this length.
            each = min(capacity // length, n)
            used = min(there, n // each)
            runs.append((length, rank, rank + used * each, first, each, window - capacity))
            rank, n = rank + used * each, n - used * each
            leave(capacity - each * length, first, used)
            leave(capacity, first + used, there - used)
    return runs


def _cut(batches: Iterator, tokenizer: str, kind: str, end_id: int, window: int, with_ids: bool) -> Iterator:
    import pyarrow as pa

    encode, end = encoder(tokenizer, kind), np.array([end_id], dtype="<u4").tobytes()
    names = [x.split()[0] for x in PIECES.split(", ")]
    types = [pa.int64()] * 5 + [pa.binary()]
    for batch in batches:
        rows, held = [], 0
        texts = batch.column("text")
        for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            ids = encode(texts[i].as_py()) + end
            for at in range(0, len(ids), 4 * window):
                piece = ids[at : at + 4 * window]
                rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece if with_ids else None))
                held += len(piece) if with_ids else 0
            if held > 1 << 24 or len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def pieces(
    docs: DataFrame, tokenizer: str, kind: str, end_id: int, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """The documents' ids in pieces of at most ``window``: ``doc_id, start, length, ids_crc32, doc_tokens, ids``.

    A null text is an empty one and has the end as its only id; repeated rows are packed each; extra columns are left out.
    """
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _cut(batches, tokenizer, kind, end_id, window, with_ids), PIECES
    )


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """``cut`` (rows with ``doc_id, start, length``) with ``sequence_id`` and ``offset``.

    Sequences are numbered without gaps: first the full pieces, one each, then the windows in the order they are opened.
    Rows that are alike in length are ranked by ``doc_id`` and ``start``.  An empty table gives an empty one.
    """
    # Written first: sorting by range reads its input twice, which would cut and tokenize every text twice.
    ranked = numbered(keep(cut, "cut"), ["doc_id", "start"], "_rank", ["length"])
    # At most one row per length.
    counts = {row["length"]: row["count"] for row in ranked.groupBy("length").count().collect()}
    full = counts.pop(window, 0)
    runs = best_fit(counts, window)
    table = ranked.sparkSession.createDataFrame(runs, RUNS)
    # Runs are bounded by the window, not by the corpus (see best_fit), so this side is small at any size.
    runs_of = F.broadcast(table.withColumnRenamed("length", "_length"))
    whole = ranked.where(F.col("length") == window).withColumns({"sequence_id": F.col("_rank"), "offset": F.lit(0).cast("long")})
    fits = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("from_rank")) & (F.col("_rank") < F.col("to_rank"))
    place = F.col("_rank") - F.col("from_rank")
    rest = ranked.where(F.col("length") < window).join(runs_of, fits).withColumns({
        "sequence_id": F.lit(full) + F.col("first") + F.floor(place / F.col("each")),
        "offset": F.col("offset") + (place % F.col("each")) * F.col("length"),
    })
    columns = [*cut.columns, "sequence_id", "offset"]
    return whole.select(columns).unionByName(rest.select(columns))


def _plan(counts, window: int):
    """The counts of one run of the mix as its ``RUNS``, full windows first, with the number of its windows."""
    import pyarrow as pa

    run, of_length = counts["run"][0].as_py(), dict(zip(counts["length"].to_pylist(), counts["count"].to_pylist(), strict=True))
    full = of_length.pop(window, 0)
    rows = [(window, 0, full, 0, 1, 0)] if full else []
    rows += [(*row[:3], full + row[3], *row[4:]) for row in best_fit(of_length, window)]
    windows = max(first - (-(to - start) // each) for _, start, to, first, each, _ in rows)
    names = ["run", *(x.split()[0] for x in RUNS.split(", ")), "windows"]
    return pa.table([pa.array(c, pa.int64()) for c in zip(*((run, *row, windows) for row in rows), strict=True)], names)


def pack_mixed(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """As ``pack``, in the order of a mix: ``cut`` also has ``run`` and ``position``, whole numbers that are never null.

    Each run is packed by itself and its sequences come before those of the next run, so the first sequences hold the
    first rows of the mix.  Within a run, rows that are alike in length are ranked by ``position`` and ``start``.
    """
    ranked = numbered(keep(cut, "cut"), ["position", "start"], "_rank", ["run", "length"])
    counts = ranked.groupBy("run", "length").count()
    planned = keep(counts.groupBy("run").applyInArrow(lambda t: _plan(t, window), f"run long, {RUNS}, windows long"), "plan")
    # One row for each run.
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = planned.groupBy("run").agg(F.first("windows").alias("windows"))
    before = before.select("run", F.coalesce(F.sum("windows").over(earlier), F.lit(0)).alias("before"))
    runs_of = planned.join(before, "run").withColumnsRenamed({"run": "_run", "length": "_length"})
    fits = (
        (F.col("run") == F.col("_run")) & (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("from_rank")) & (F.col("_rank") < F.col("to_rank"))
    )
    place = F.col("_rank") - F.col("from_rank")
    return ranked.join(runs_of, fits).withColumns({
        "sequence_id": F.col("before") + F.col("first") + F.floor(place / F.col("each")),
        "offset": F.col("offset") + (place % F.col("each")) * F.col("length"),
    }).select(*cut.columns, "sequence_id", "offset")

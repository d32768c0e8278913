"""Hard negatives by Fagin's threshold algorithm.

Vectors are whole numbers.  Rows are dealt into shards; a shard sorts its rows by every dimension.  For an anchor each of
these lists is read from the end that its component favours: a positive component from the largest values down, a negative
one from the smallest up, one of zero not at all.  A row met for the first time is scored at once by its whole vector.  The
threshold is the score of a row that had in every dimension the value last read, so no row still unread can score more.  A
window, the range of scores that one positive allows, is done once the threshold is strictly below its k-th best score, or
below its lower end; strictly, so that rows that tie with the k-th are all read and ids decide.

Two passes: the positives are the best of all shards, the windows follow from them, and the negatives are the best of all
shards again.  Anchors pass every shard in blocks.  Shards grow with the table up to what a task may hold, since each one
costs a copy of the anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satchel.llm.scratch import keep

SHARD_ROWS, MOST_SHARD_ROWS, SHARDS = 4096, 1 << 17, 64
BLOCK = 256  # anchors in one row
FIRST_DEPTH = 16  # of the lists read before the threshold is looked at; doubles from there
EXACT = 1 << 53  # up to here floating point numbers hold every whole number
FOUND = "anchor_id long, positive_id long, vec_id long, score long"
PASSING = (
    "shard int, is_anchor boolean, vec_id long, label int, vector array<long>, ids array<long>, labels array<int>,"
    " vectors array<array<long>>, windows array<array<struct<positive_id:long,low:long,high:long>>>"
)


class Lists:
    """The rows of a shard, sorted by each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        at = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[at], labels[at], vectors[at]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.sort(self.vectors, axis=0).T
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.floats = self.vectors.astype(np.float64)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products, exact: by floating point where no sum can leave the whole numbers it holds."""
        if len(anchor) * self.largest * int(np.abs(anchor).max(initial=0)) < EXACT:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor

    def best(
        self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int, first: int = FIRST_DEPTH
    ) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """For each window its ``k`` best rows of those ``allowed`` and their scores, and the depth that was read to."""
        n, up = len(self.ids), np.flatnonzero(anchor > 0)
        down = np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            up = np.arange(len(anchor))  # every score is 0; one way through the lists is as good as another
        seen = np.zeros(n, dtype=bool)
        kept = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)) for _ in windows]
        depth, to = 0, min(first, n)
        while depth < n:
            met = np.zeros(n, dtype=bool)
            met[self.order[up, n - to : n - depth]] = True
            met[self.order[down, depth:to]] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            new = new[allowed[new]]
            scores = self.scores(new, anchor)
            threshold = int(self.values[up, n - to] @ anchor[up]) + int(self.values[down, to - 1] @ anchor[down])
            going = False
            for w, (low, high) in enumerate(windows):
                inside = (scores >= low) & (scores <= high)
                rows, found = np.concatenate([kept[w][0], new[inside]]), np.concatenate([kept[w][1], scores[inside]])
                order = np.lexsort((rows, -found))[:k]  # rows ascend by id
                kept[w] = rows[order], found[order]
                floor = int(kept[w][1][-1]) if len(order) == k else low
                going |= threshold >= floor
            depth, to = to, min(2 * to, n)
            if not going:
                break
        return kept, depth


LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _mine(batches: Iterator, k: int, negatives: bool) -> Iterator:
    """Rows sorted by shard, each shard's own rows before the blocks of anchors that pass it."""
    import pyarrow as pa

    shard, parts, lists = None, [], None
    for batch in batches:
        shards, kinds = batch.column("shard").to_numpy(), batch.column("is_anchor").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((np.diff(shards) != 0) | (np.diff(kinds.astype(np.int8)) != 0)) + 1
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(shards)], strict=True):
            if start == end:
                continue
            if shards[start] != shard:
                shard, parts, lists = shards[start], [], None
            some = batch.slice(start, end - start)
            if not kinds[start]:
                vectors = some.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(end - start, -1)
                parts.append((some.column("vec_id").to_numpy(), some.column("label").to_numpy(), vectors))
                continue
            if lists is None:
                if not parts:
                    continue
                lists = Lists(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            for block in some.to_pylist():
                rows = []
                windows = block["windows"] or [[{"positive_id": None, "low": LEAST, "high": MOST}]] * len(block["ids"])
                for anchor_id, label, vector, asked in zip(block["ids"], block["labels"], block["vectors"], windows, strict=True):
                    same = lists.labels == label
                    allowed = ~same if negatives else same & (lists.ids != anchor_id)
                    found, _ = lists.best(np.array(vector, dtype=np.int64), allowed, [(w["low"], w["high"]) for w in asked], k)
                    for w, (at, scores) in zip(asked, found, strict=True):
                        rows += [(anchor_id, w["positive_id"], i, s) for i, s in zip(lists.ids[at].tolist(), scores.tolist(), strict=True)]
                if rows:
                    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "positive_id", "vec_id", "score"])


def _best(dealt: DataFrame, anchors: DataFrame, shards: int, k: int, negatives: bool) -> DataFrame:
    """``FOUND`` with ``rank``: the best of all shards for each anchor and window."""
    windows = "windows" if negatives else F.lit(None).cast("array<struct<positive_id:long,low:long,high:long>>").alias("windows")
    # An anchor per row would be as many rows as anchors times shards.
    numbered = anchors.select("vec_id", "label", "vector", windows, F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)).alias("_h"))
    blocks = numbered.repartitionByRange("_h", "vec_id").mapInArrow(_blocks, PASSING.replace("shard int, ", ""))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    passing = blocks.select(every, *blocks.columns)
    rows = dealt.unionByName(passing, allowMissingColumns=True).repartition(shards, "shard")
    found = rows.sortWithinPartitions("shard", "is_anchor").mapInArrow(lambda batches: _mine(batches, k, negatives), FOUND)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(batches: Iterator) -> Iterator:
    import pyarrow as pa

    lists = ["ids", "labels", "vectors", "windows"]
    window = pa.struct([("positive_id", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
    types = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int64())), pa.list_(pa.list_(window))]
    none = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.list_(pa.int64()))]
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            some = batch.slice(at, BLOCK)
            held = [some.column(c).to_pylist() for c in ("vec_id", "label", "vector", "windows")]
            held[3] = None if held[3][0] is None else held[3]
            arrays = [pa.array([x], t) for x, t in zip(held, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([True]), *none, *arrays], ["is_anchor", "vec_id", "label", "vector", *lists]
            )


def whole(vector: str, scale: int = 256):
    """``floor(scale * x)`` of each component."""
    return F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x))


def usable(rows: DataFrame) -> DataFrame:
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where("vec_id is not null and label is not null and vector is not null").where(~bad)


def mine(
    rows: DataFrame, anchors: str, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows``: ``vec_id, label, vector``; ``anchors``: a condition on ``vec_id``.  A score is the inner product of the
    floors of ``scale`` times the components, which must fit a long.  An anchor's positives are its ``positives`` best other
    rows of its label; for each, its negatives are the ``negatives`` best rows of other labels whose score lies between
    ``low`` and ``high`` hundredths of the positive's, so below 0 there are none.  Ties go to the smaller ``vec_id``.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part, nor do vectors with
    another number of components than most.  Of rows that share an id the one with the smallest label and vector counts.
    Extra columns are left out; an empty table gives an empty one.
    """
    found = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    vector = F.col("vector").cast("array<double>").alias("vector")
    good = usable(rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), vector))
    one = good.groupBy("vec_id").agg(F.min(F.struct("label", whole("vector", scale).alias("vector"))).alias("_row"))
    ready = keep(one.select("vec_id", "_row.*"), "vectors")
    sizes = ready.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return rows.sparkSession.createDataFrame([], found)
    ready = ready.where(F.size("vector") == sizes[0]["d"])
    shard_rows = min(max(sizes[0]["count"] // SHARDS, SHARD_ROWS), MOST_SHARD_ROWS)
    shards = -(-sizes[0]["count"] // shard_rows)
    own = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    dealt, asking = ready.select(own, F.lit(False).alias("is_anchor"), "vec_id", "label", "vector"), ready.where(anchors)
    best = _best(dealt, asking, shards, positives, False)
    # low * positive <= 100 * negative <= high * positive, in whole numbers; positives below 0 allow none.
    window = F.struct(
        F.col("vec_id").alias("positive_id"), F.expr(f"({low} * score + 99) div 100").alias("low"),
        F.expr(f"({high} * score) div 100").alias("high"), F.col("score").alias("positive_score"),
    )
    chosen = keep(best.where("score >= 0").select("anchor_id", window.alias("w")), "positives")
    windows = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("w.positive_id", "w.low", "w.high")).alias("windows"))
    ranged = asking.join(windows, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    hard = _best(dealt, ranged, shards, negatives, True)
    scores = chosen.select("anchor_id", "w.positive_id", "w.positive_score")
    return hard.join(scores, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )

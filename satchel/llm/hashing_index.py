"""Nearest neighbours by multi-index hashing of learned binary codes.

Several rotations, each learned on a bounded sample so that the signs of the rotated vectors keep as much of them as
signs can, give a code of ``bits`` bits.  A code is split into substrings of 16 bits, each indexed in a table of its own.
If two codes differ in at most r bits, one of the m substrings differs in at most r / m, so probing every table within
that radius finds every code within r; what is found is checked over the whole code and ranked by the vectors.

The radius is a query's own.  The sample holds rows of the table, so its k best by cosine are no nearer than the k best
of all.  Codes are signs of vectors with the mean taken off, so of those k rows the widest angle counts that they make
with the query once the mean is off; a row at that angle has a Hamming distance whose mean and spread are known, and the
radius is that mean and ``SPREADS`` times the spread, and wider where that finds fewer than k rows in a shard.

Rows are dealt into shards of bounded size, each with its own tables; queries stream past every shard in blocks, and
only the best of each shard are passed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satchel.llm.sampling import about

BITS, PIECE = 256, 16
SAMPLE, TURNS = 8192, 20
SPREADS = 1.5
SHARD_ROWS = 8192
FLIPS = 2  # up to this radius keys are probed one by one; beyond it there are more of them than a shard has keys
BLOCK = 256  # queries ranked at a time


@dataclass
class Codes:
    mean: np.ndarray
    turns: list[np.ndarray]  # rotations

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        """``(n, bits / 16)`` substrings."""
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True) - self.mean
        signs = np.concatenate([units @ turn > 0 for turn in self.turns], axis=1)
        return np.packbits(signs, axis=1, bitorder="little").view("<u2")


def learn(sample: np.ndarray, bits: int = BITS, turns: int = TURNS, seed: int = 7) -> Codes:
    """Rotations from ``sample``: each is turned until signs of the rotated rows and the rows themselves fit best."""
    dimension = sample.shape[1]
    units = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = units.mean(axis=0)
    centred, draw, found = units - mean, np.random.default_rng(seed), []
    while sum(x.shape[1] for x in found) < bits:
        turn = np.linalg.qr(draw.standard_normal((dimension, dimension)))[0]
        for _ in range(turns):
            signs = np.where(centred @ turn > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ centred)
            turn = (left @ right).T
        found.append(turn)
    found[-1] = found[-1][:, : found[-1].shape[1] - (sum(x.shape[1] for x in found) - bits)]
    return Codes(mean, found)


def radius(cosine: np.ndarray, bits: int, spreads: float = SPREADS) -> np.ndarray:
    """Hamming distance within which neighbours of at least ``cosine``, with the mean off, are looked for."""
    share = np.arccos(np.clip(cosine, -1, 1)) / math.pi
    return np.minimum(np.ceil(bits * share + spreads * np.sqrt(bits * share * (1 - share)) + 1), bits).astype(int)


class Tables:
    """One table per substring over a shard's codes: the distinct keys, and the rows of each."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.keys, self.rows, self.starts, self.key_of = [], [], [], []
        for piece in codes.T:
            keys, where, counts = np.unique(piece, return_inverse=True, return_counts=True)
            self.keys.append(keys)
            self.rows.append(np.argsort(where, kind="stable"))
            self.starts.append(np.concatenate([[0], np.cumsum(counts)]))
            self.key_of.append(where)

    def within(self, code: np.ndarray, r: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``r`` bits."""
        reach = r // len(self.keys)
        found = np.zeros(len(self.codes), dtype=bool)
        for piece, keys, rows, starts, key_of in zip(code, self.keys, self.rows, self.starts, self.key_of, strict=True):
            if reach <= FLIPS:
                masks = [sum(1 << b for b in flips) for n in range(reach + 1) for flips in combinations(range(PIECE), n)]
                probes = piece ^ np.array(masks, dtype=np.uint16)
                at = np.searchsorted(keys, probes)
                hits = at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == probes)]
                for hit in hits.tolist():
                    found[rows[starts[hit] : starts[hit + 1]]] = True
            else:
                found |= (np.bitwise_count(keys ^ piece) <= reach)[key_of]
        rows = np.flatnonzero(found)
        apart = np.bitwise_count(self.codes[rows] ^ code).sum(axis=1, dtype=np.int64)
        return rows[apart <= r]


    def nearest_within(self, code: np.ndarray, r: int, own: np.ndarray, asked: int, k: int) -> np.ndarray:
        """Rows within ``r``, or within a wider radius until there are ``k`` besides the query's own."""
        while True:
            rows = self.within(code, r)
            rows = rows[own[rows] != asked]
            if len(rows) >= k or r >= PIECE * len(self.keys):
                return rows
            r = min(r + max(r // 4, len(self.keys)), PIECE * len(self.keys))


def usable(rows: DataFrame, vector: str, dimension: int | None) -> DataFrame:
    """Rows with an id whose vector is not null or zero, has only finite components, and as many as the others."""
    good = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & good & F.exists(vector, lambda x: x != 0))
    return rows if dimension is None else rows.where(F.size(vector) == dimension)


def _matrix(column) -> np.ndarray:
    import pyarrow as pa

    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _search(batches: Iterator, codes: Codes, k: int) -> Iterator:
    """Rows sorted by shard, each shard's own rows before the queries that pass it."""
    import pyarrow as pa

    shard, ids, vectors, tables = None, [], [], None
    units = own = None
    for batch in batches:
        shards, kinds = batch.column("shard").to_numpy(), batch.column("is_query").to_numpy(zero_copy_only=False)
        all_ids, radii = batch.column("vec_id").to_numpy(), batch.column("radius").to_numpy()
        matrix = _matrix(batch.column("vector"))
        edges = np.flatnonzero((np.diff(shards) != 0) | (np.diff(kinds.astype(np.int8)) != 0)) + 1
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(shards)]):
            if start == end:
                continue
            if shards[start] != shard:
                shard, ids, vectors, tables = shards[start], [], [], None
            if not kinds[start]:
                ids.append(all_ids[start:end])
                vectors.append(matrix[start:end])
                continue
            if tables is None:
                if not ids:
                    continue
                own, mine = np.concatenate(ids), np.concatenate(vectors)
                tables = Tables(codes(mine))
                units = mine / np.linalg.norm(mine, axis=1, keepdims=True)
            for at in range(start, end, BLOCK):
                some = slice(at, min(at + BLOCK, end))
                found = codes(matrix[some])
                asked, near, scores = [], [], []
                for row, code in enumerate(found):
                    q = matrix[at + row]
                    rows = tables.nearest_within(code, int(radii[at + row]), own, all_ids[at + row], k)
                    cosines = units[rows] @ (q / np.linalg.norm(q))
                    if len(rows) > k:
                        least = np.partition(cosines, len(rows) - k)[len(rows) - k]
                        rows, cosines = rows[cosines >= least], cosines[cosines >= least]
                    best = np.lexsort((own[rows], -cosines))[:k]
                    asked += [all_ids[at + row]] * len(best)
                    near.append(own[rows[best]])
                    scores.append(cosines[best])
                if asked:
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(asked, pa.int64()), "vec_id": np.concatenate(near), "score": np.concatenate(scores),
                    })


def search(rows: DataFrame, queries: DataFrame, k: int, bits: int = BITS, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` nearest rows found, by cosine in double precision.

    ``rows`` and ``queries`` have ``vec_id`` and ``vector``; a row with the query's own id is no candidate.  Vectors that are
    null or zero, hold a null or a component that is not finite, or have another number of components than most take no
    part, nor do rows without an id.  Ties go to the smaller ``vec_id``.  Of rows that share an id the one with the smallest vector counts.  The
    codes are learned on about ``sample`` rows, but every row is indexed.  Empty tables give an empty one.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    ids = F.col("vec_id").cast("long").alias("vec_id")
    vector = F.col("vector").cast("array<double>").alias("vector")
    whole = usable(rows.select(ids, vector), "vector", None)
    sizes = whole.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    dimension, n = sizes[0]["d"], sizes[0]["count"]
    whole = usable(whole, "vector", dimension).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = usable(queries.select(ids, vector), "vector", dimension).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    drawn = about(whole, sample, "vec_id").toArrow()
    known, known_ids = _matrix(drawn.column("vector")), drawn.column("vec_id").to_numpy()
    codes = learn(known, bits)
    known_units = known / np.linalg.norm(known, axis=1, keepdims=True)
    known_off = known_units - codes.mean
    known_off /= np.maximum(np.linalg.norm(known_off, axis=1, keepdims=True), 1e-300)
    shards = max(1, -(-n // shard_rows))

    def with_radius(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, matrix = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"))
            bound = np.full(len(ids), -1.0)
            for at in range(0, len(ids), 1024):
                some = matrix[at : at + 1024]
                units = some / np.linalg.norm(some, axis=1, keepdims=True)
                cosines = units @ known_units.T
                cosines[ids[at : at + 1024, None] == known_ids[None, :]] = -1.0
                if cosines.shape[1] >= k:
                    best = np.argpartition(cosines, -k, axis=1)[:, -k:]
                    off = units - codes.mean
                    off /= np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-300)
                    bound[at : at + 1024] = np.einsum("qd,qkd->qk", off, known_off[best]).min(axis=1)
            columns = [batch.column("vec_id"), batch.column("vector"), pa.array(radius(bound, bits), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "radius"])

    ready = asked.mapInArrow(with_radius, "vec_id long, vector array<double>, radius int")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    passing = ready.select(every, F.lit(True).alias("is_query"), "vec_id", "vector", "radius")
    own = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    indexed = whole.select(own, F.lit(False).alias("is_query"), "vec_id", "vector", F.lit(0).alias("radius"))
    dealt = indexed.unionByName(passing).repartition(shards, "shard").sortWithinPartitions("shard", "is_query")
    best = dealt.mapInArrow(lambda batches: _search(batches, codes, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

"""Near-duplicates by SimHash, found through Golay-code keys.

A fingerprint of 64 bits is cut into three segments of 22, 21 and 21 bits.  If two fingerprints differ in at most four
bits, two of their segments differ in at most two bits together, so for one of the three pairs of segments both share a
Golay key.  A pair of keys has 24 bits; rows that share one are compared bit by bit where they meet.

Only distinct fingerprints take part, so copies cost nothing.  Rows of one key lie in one sorted run that a task streams
through, and only links that connect something leave it, never all pairs.  A key with more fingerprints than a task
should compare is split by exact blocks of the 64 bits: four wrong bits leave at least ``blocks - 4`` blocks untouched,
so every choice of that many blocks is a finer key for the fingerprints in question, and finer again where that is not
enough; each step starts from the fingerprints, not from the keys before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satchel.llm import golay
from satchel.llm.components import components
from satchel.llm.scratch import keep

SHINGLE = 5
DISTANCE = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SPREAD_ROWS = 20_000
GROUP = 2048  # fingerprints of one key that are compared in place
FINER = (6, 8, 12, 16)  # numbers of blocks of the finer keys, from coarse to fine
UPPER = bytes(range(65, 91))
LOWERED = bytes.maketrans(UPPER, UPPER.lower())


def fingerprint(text: str | None, shingle: int) -> int:
    """Bit i is set if more than half of the shingles' XXH64 (seed 42) have it set; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().translate(LOWERED).split() if text else ()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]])
    ends = ends[shingle - 1 :] - 1
    counts, n = np.zeros(64, dtype=np.int64), len(ends)
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([xxh64_intdigest(joined[s:e], 42) for s, e in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of distinct shingles, given by their XXH64."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long.

    Words are what white space of ASCII parts; A to Z are lowered; a null text has no words.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text")
            found = np.array([fingerprint(texts[i].as_py(), shingle) for i in range(len(batch))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys; each row's keys are distinct."""
    parts = [golay.keys(fps >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, out = [], []
    for number, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        pairs = (parts[i][:, :, None] << 12 | parts[j][:, None, :]).reshape(len(fps), -1) | number << 24
        pairs.sort(axis=1)
        new = np.ones(pairs.shape, dtype=bool)
        new[:, 1:] = pairs[:, 1:] != pairs[:, :-1]
        rows.append(np.nonzero(new)[0])
        out.append(pairs[new])
    return np.concatenate(rows), np.concatenate(out)


def block_keys(fps: np.ndarray, blocks: int) -> np.ndarray:
    """``(n, choices)``: for each choice of ``blocks - 4`` blocks, the bits in them together with the choice's number."""
    edges = np.linspace(0, 64, blocks + 1).astype(int)
    masks = [((1 << int(e)) - 1) ^ ((1 << int(s)) - 1) for s, e in zip(edges, edges[1:])]
    choices = list(combinations(range(blocks), blocks - DISTANCE))
    out = np.empty((len(fps), len(choices)), dtype=np.uint64)
    for number, choice in enumerate(choices):
        held = fps & np.uint64(sum(masks[b] for b in choice))
        # Mixed, so that sorting by it spreads; the links are verified, so a collision costs only a comparison.
        out[:, number] = (held ^ np.uint64(number)) * np.uint64(0x9E3779B97F4A7C15)
    return out.view(np.int64)


def _with_keys(distinct: DataFrame) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            all_fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(all_fps), 2000):
                fps = all_fps[at : at + 2000]
                rows, found = golay_keys(fps.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(fps[rows])], ["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


def _finer(fps: DataFrame, blocks: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            all_fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(all_fps), 200):
                some = all_fps[at : at + 200]
                found = block_keys(some.view(np.uint64), blocks)
                columns = [pa.array(found.ravel()), pa.array(np.repeat(some, found.shape[1]))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "fp"])

    return fps.mapInArrow(run, "key long, fp long")


def near_in_group(fps: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """A spanning forest of the links of one group: as many links as it takes to connect what is connected."""
    left, links = fps.view(np.uint64), []
    while len(left):
        front, left = left[:1], left[1:]
        root = front[0]
        while len(front) and len(left):
            reached = np.zeros(len(left), dtype=bool)
            for at in range(0, len(front), 256):
                apart = np.bitwise_count(front[at : at + 256, None] ^ left[None, :])
                reached |= (apart <= distance).any(axis=0)
            front, left = left[reached], left[~reached]
            links += [(int(root), int(x)) for x in front]
    return links


def _links(batches: Iterator, group: int | None) -> Iterator:
    """Rows sorted by key, as links that connect; what the task has connected already is not said again.

    A key with more than ``group`` rows is not compared but named in ``over``; its rows are not held.
    """
    import pyarrow as pa

    parent: dict[int, int] = {}
    limit = np.iinfo(np.int64).max if group is None else group

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = up = parent[up]
            x = up
        return x

    def told(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out = []
        for a, b in links:
            if (a := find(a)) != (b := find(b)):
                parent[max(a, b)] = min(a, b)
                out.append((a, b))
        if len(parent) > 1 << 18:
            parent.clear()  # memory stays bounded; a link may then be said again
        return out

    def found(links: list[tuple[int, int]], over: list[int]):
        pairs = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        columns = [np.concatenate([pairs[:, i], np.zeros(len(over), np.int64)]) for i in (0, 1)]
        columns.append(pa.array([None] * len(pairs) + over, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "over"])

    rest = np.empty((2, 0), dtype=np.int64)
    skipped, done = None, False
    while not done:
        batch = next(batches, None)
        done = batch is None
        new = rest[:, :0] if done else np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp")])
        if skipped is not None:
            new = new[:, np.searchsorted(new[0], skipped, side="right") :]
        keys, fps = rows = np.concatenate([rest, new], axis=1)
        if not len(keys):
            continue
        borders = np.flatnonzero(np.diff(keys)) + 1
        last = len(keys) if done else int(borders[-1]) if len(borders) else 0
        rest, over = rows[:, last:], []
        if rest.shape[1] > limit:
            skipped = int(rest[0, 0])
            over.append(skipped)
            rest = rest[:, :0]
        starts = np.concatenate([[0], borders[borders < last]]) if last else np.empty(0, dtype=np.int64)
        sizes = np.diff(np.concatenate([starts, [last]]))
        over += keys[starts[sizes > limit]].tolist()
        links: list[tuple[int, int]] = []
        small = np.repeat(sizes <= 16, sizes)
        for step in range(1, min(16, last)):  # neighbours at each distance within small groups, all groups at once
            i = np.flatnonzero((keys[: last - step] == keys[step:last]) & small[step:last])
            i = i[np.bitwise_count(fps[i].view(np.uint64) ^ fps[i + step].view(np.uint64)) <= DISTANCE]
            links += zip(fps[i].view(np.uint64).tolist(), fps[i + step].view(np.uint64).tolist(), strict=True)
        large = (sizes > 16) & (sizes <= limit)
        for start, size in zip(starts[large].tolist(), sizes[large].tolist(), strict=True):
            links += near_in_group(np.unique(fps[start : start + size]))
        if (links := told(links)) or over:
            yield found(links, over)


def near_links(distinct: DataFrame, group: int = GROUP) -> DataFrame:
    """Links ``a, b`` that connect the distinct fingerprints of ``distinct`` (``fp``) as all links of 4 bits would."""
    # A fingerprint becomes some 84 keys, so partitions are cut by rows and not by bytes.
    parts = max(distinct.count() // SPREAD_ROWS, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = _with_keys(distinct.repartition(parts, "fp"))
    links = None
    for blocks in (*FINER, None):
        limit = None if blocks is None else group
        runs = keyed.repartition("key").sortWithinPartitions("key")
        out = keep(runs.mapInArrow(lambda rows, limit=limit: _links(rows, limit), "a long, b long, over long"), "near")
        some = out.where("over IS NULL").select("a", "b")
        links = some if links is None else links.unionByName(some)
        over = out.where("over IS NOT NULL").select(F.col("over").alias("key")).distinct()
        if blocks is None or over.isEmpty():
            break
        larger = keep(keyed.join(over, "key", "left_semi").select("fp").distinct(), "larger")
        keyed = _finer(larger.repartition(parts, "fp"), blocks)
    return links


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per document.

    ``fingerprint`` is 16 hexadecimal digits, ``component_id`` the smallest ``doc_id`` reachable over links of at most four
    bits.  Documents without words have fingerprint 0 and are linked like any other.  Repeated rows come out each;
    a null ``doc_id`` is in its group but never names it, unless nothing else can.  An empty table gives an empty one.
    """
    prints = keep(fingerprints(docs, shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = components(near_links(distinct))
    group = F.coalesce(F.col("component"), F.col("fp")).alias("group")
    classes = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", group)
    classes = keep(classes, "classes")
    named = classes.groupBy("group").agg(F.min("least").alias("component_id"))
    names = classes.join(named, "group").select("fp", "component_id")
    return prints.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

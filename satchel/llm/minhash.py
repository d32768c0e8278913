"""Near copies: texts whose shingles of five words have a Jaccard similarity of at least 0.8.

Keys only propose.  Golay keys of SimHash fingerprints, as in ``simhash``, connect all texts whose fingerprints differ in
at most four bits.  At a similarity of 0.8 fingerprints differ in some ten bits, so MinHash keys propose what lies farther
apart: a text has ``BANDS`` keys of ``ROWS`` minima each, and two texts of a similarity of s share one with probability
1 - (1 - s^ROWS)^BANDS, 0.9999 at 0.8.  What keys connect is brought into one task, and there texts that share a key of
either kind are linked if the exact similarity of their shingles is 0.8 or more; links that connect leave the task, never
all pairs.  Texts with the same shingles, known by a hash of 64 bits over them, are one node, so copies cost nothing.

A connected set of more than ``GROUP`` nodes is dealt out in chunks, each with the set's first node in it, which connects
what is alike to that node or lies in one chunk.  What this leaves apart meets again by key: each MinHash key with nodes
of more than one group is compared as a whole, and so are the two nodes of each Golay link between groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satchel.llm import simhash
from satchel.llm.components import components
from satchel.llm.scratch import keep
from satchel.llm.simhash import LOWERED

SHINGLE = 5
NUMERATOR, DENOMINATOR = 4, 5  # of the similarity
BANDS, ROWS = 30, 6
_DRAW = np.random.default_rng(11)
MASKS = _DRAW.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)
FACTORS = _DRAW.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)
MIX = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 2048
GROUP = 2048  # nodes of one connected set of proposals that are compared in one task


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Distinct XXH64 (seed 42) of the shingles, sorted; a text of fewer words is one shingle, one without words has none.

    Words are what white space of ASCII parts; A to Z are lowered.
    """
    from xxhash import xxh64_intdigest

    words = text.encode().translate(LOWERED).split() if text else ()
    if len(words) <= size:
        return np.array([xxh64_intdigest(b" ".join(words), 42)] if words else [], dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    spans = zip([0, *ends[:-size].tolist()], (ends[size - 1 :] - 1).tolist(), strict=True)
    return np.unique(np.fromiter((xxh64_intdigest(joined[s:e], 42) for s, e in spans), dtype=np.uint64))


def keys(hashes: np.ndarray) -> np.ndarray:
    """One key a band."""
    words = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(words), CHUNK):
        turned = (words[None, at : at + CHUNK] ^ MASKS) * FACTORS
        turned ^= turned >> np.uint32(15)
        turned *= np.uint32(0x846CA68B)
        least = np.minimum(least, turned.min(axis=1))
    found = np.arange(1, BANDS + 1, dtype=np.uint64)
    for part in least.reshape(BANDS, ROWS).T:
        found = (found ^ part) * MIX
        found ^= found >> np.uint64(29)
    return found.view(np.int64)


def node(hashes: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(hashes.tobytes(), 42) - (1 << 63)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the similarity of two sets of shingles is high enough, exactly."""
    if len(a) > len(b):
        a, b = b, a
    if DENOMINATOR * len(a) < NUMERATOR * len(b) or not len(a):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def links_of(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest, by position, of the links between sets that share a MinHash or a Golay key."""
    own = [keys(x).tolist() for x in sets]
    prints = np.array([simhash.majority(x) for x in sets], dtype=np.uint64)
    for i, key in zip(*(x.tolist() for x in simhash.golay_keys(prints)), strict=True):
        own[i].append(key)
    by_key: dict[int, list[int]] = {}
    for i, found in enumerate(own):
        for key in found:
            by_key.setdefault(key, []).append(i)
    left, links = dict.fromkeys(range(len(sets))), []
    while left:
        root = next(iter(left))
        del left[root]
        front = [root]
        while front and left:
            one, seen = front.pop(), set()
            for key in own[one]:
                by_key[key] = there = [x for x in by_key[key] if x in left]
                for x in there:
                    if x in left and x not in seen:
                        seen.add(x)
                        if alike(sets[one], sets[x]):
                            del left[x]
                            front.append(x)
                            links.append((root, x))
    return links


def _sketch(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        texts, nodes, prints, found = batch.column("text"), [], [], []
        for i in range(len(batch)):
            hashes = shingles(texts[i].as_py())
            nodes.append(node(hashes))
            prints.append(simhash.majority(hashes) if len(hashes) else None)
            found.append(keys(hashes) if len(hashes) else [])
        signed = pa.array(prints, pa.uint64()).view(pa.int64())
        columns = [batch.column("doc_id"), batch.column("_row"), pa.array(nodes, pa.int64()), signed, pa.array(found, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_row", "node", "fp", "keys"])


def _verify(batches: Iterator) -> Iterator:
    """Rows sorted by proposal."""
    import pyarrow as pa

    def told(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        names = list(sets)
        found = links_of(list(sets.values()))
        columns = [pa.array([names[pair[side]] for pair in found], pa.int64()) for side in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    proposal, sets = None, {}
    for batch in batches:
        proposals, nodes = batch.column("proposal").to_pylist(), batch.column("node").to_pylist()
        for i, text in enumerate(batch.column("text")):
            if proposals[i] != proposal:
                if len(sets) > 1:
                    yield told(sets)
                proposal, sets = proposals[i], {}
            if nodes[i] not in sets:
                sets[nodes[i]] = shingles(text.as_py())
    if len(sets) > 1:
        yield told(sets)


def _row(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A row's name: a digest of its id and text together."""
    named = F.coalesce(F.col(doc_id).cast("string"), F.lit("-"))
    return F.sha2(F.concat(named, F.lit(":"), F.coalesce(F.concat(F.lit("="), F.col(text)), F.lit(""))), 256)


def _verified(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a, b`` inside each ``proposal`` of ``wanted`` (``proposal, node, _row``)."""
    found = texts.join(wanted, "_row").select("proposal", "node", "text")
    by_proposal = found.repartition("proposal").sortWithinPartitions("proposal", "node")
    return keep(by_proposal.mapInArrow(_verify, "a long, b long"), "verified")


def _chunked(members: DataFrame, large: DataFrame) -> DataFrame:
    """``node, proposal`` with the sets of ``large`` (``of, chunks``) in chunks, the first node of a set in each of its."""
    dealt = members.join(large, F.col("proposal") == F.col("of"), "left").select(
        "node", "proposal", "of", F.expr("pmod(xxhash64(node), chunks)").alias("chunk")
    )
    first = large.select(
        F.col("of").alias("node"), F.col("of").alias("proposal"), "of",
        F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"),
    )
    number = F.when(F.col("of").isNull(), F.col("proposal")).otherwise(F.xxhash64("proposal", "chunk"))
    return dealt.unionByName(first).select("node", number.alias("proposal"))


def _near(nodes: DataFrame) -> DataFrame:
    """Links ``node, other`` that connect the ``nodes`` (``node, fp``) whose fingerprints differ in at most four bits.

    They are found by Golay keys; of nodes with the same fingerprint the smallest stands for all.
    """
    prints = keep(nodes.where("fp IS NOT NULL").groupBy("fp").agg(F.min("node").alias("other")), "prints")
    same = nodes.select("node", "fp").join(prints, "fp").where("node <> other").select("node", "other")
    ends = [prints.select(F.col("fp").alias(end), F.col("other").alias(name)) for end, name in (("a", "node"), ("b", "other"))]
    apart = simhash.near_links(prints.select("fp")).join(ends[0], "a").join(ends[1], "b").select("node", "other")
    return keep(same.unionByName(apart), "golay")


def _apart(members: DataFrame, nodes: DataFrame, links: DataFrame, near: DataFrame) -> DataFrame:
    """``node, proposal`` for every key that nodes of more than one group share, of keys with the same nodes one, and for
    every link of ``near`` between groups."""
    label = F.coalesce("component", "node").alias("label")
    labelled = keep(members.join(components(links), "node", "left").select("node", label), "labelled")
    keyed = keep(labelled.join(nodes, "node").select("node", "label", F.explode("keys").alias("key")), "keyed")
    told = [F.sum(h.cast("decimal(38,0)")) for h in (F.xxhash64("node"), F.xxhash64(F.lit(1), "node"))]
    by_key = keyed.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.struct(F.count("*"), *told).alias("who"))
    mixed = by_key.where("a <> b").groupBy("who").agg(F.min("key").alias("key")).select("key")
    by_key = keyed.join(mixed, "key").select("node", F.col("key").alias("proposal"))
    others = labelled.select(F.col("node").alias("other"), F.col("label").alias("other_label"))
    between = near.join(labelled, "node").join(others, "other").where("label <> other_label")
    ends = between.select(F.explode(F.array("node", "other")).alias("end"), F.xxhash64("node", "other").alias("proposal"))
    return by_key.unionByName(ends.select(F.col("end").alias("node"), "proposal"))


def without_near_copies(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text`` and others) without near copies: of each group the one with the smallest id.

    A group is what links connect, and each link is a pair of a similarity of 0.8 or more.  Texts without words are
    alike.  A row is known by its id and text together, so rows that share an id but not a text are judged each, and
    of repeated rows one stays.  A null id comes after all others.  An empty table gives an empty one; columns of any
    other name are carried along.
    """
    rows = docs.select(_row().alias("_row"), F.struct(*docs.columns).alias("_document"))
    texts = docs.select(_row().alias("_row"), "text")
    drawn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row().alias("_row"), "text")
    sketches = keep(drawn.mapInArrow(_sketch, "doc_id long, _row string, node long, fp long, keys array<long>"), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "_row")).alias("least")
    nodes = keep(sketches.groupBy("node").agg(first, F.min("keys").alias("keys"), F.min("fp").alias("fp")), "nodes")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("other"), F.count("*").alias("n")).where("n > 1")
    near = _near(nodes)
    proposed = components(near.unionByName(keyed.join(shared, "key").where("node <> other").select("node", "other")))
    roots = proposed.select(F.col("component").alias("node"), "component").distinct()
    members = keep(proposed.unionByName(roots).withColumnRenamed("component", "proposal"), "members")
    sizes = members.groupBy("proposal").count().where(F.col("count") > group)
    large = keep(sizes.select(F.col("proposal").alias("of"), F.ceil(F.col("count") / group).alias("chunks")), "large")

    def named(wanted: DataFrame) -> DataFrame:
        return keep(wanted.join(nodes, "node").select("proposal", "node", F.col("least._row").alias("_row")), "proposed")

    links = _verified(named(_chunked(members, large)), texts)
    if not large.isEmpty():
        of_large = members.join(large, F.col("proposal") == F.col("of"), "left_semi")
        links = links.unionByName(_verified(named(_apart(of_large, nodes, links, near)), texts))
    groups = components(links)
    name = F.coalesce(F.col("component"), F.col("node")).alias("group")
    least = nodes.join(groups, "node", "left").groupBy(name).agg(F.min("least").alias("least"))
    staying = keep(least.select(F.col("least._row").alias("_row")), "staying")
    return rows.join(staying, "_row", "left_semi").dropDuplicates(["_row"]).select("_document.*")

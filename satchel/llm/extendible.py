"""Exact duplicates by an extendible-hash index on shared files.

A text's key is a 64-bit hash.  The directory is indexed by the first bits of a key; a bucket whose texts take more than a
bucket may hold is split by the next bit, and the directory doubles when the bucket had as many bits as the directory.
Each bucket, a range of keys, belongs to one task, which reads its entries in the order of their keys, chains the different
texts that share a key, and compares an entry with the texts of its chain byte by byte.  What it finds, links from entries
to chained texts and totals of these, are the files of the index, in the folder that the cluster shares.

An entry stands for all equal texts that a scanning task met while it held them, so copies are collapsed before they move.
A key that alone is more than a bucket cannot be split by bits: its entries go to pages, one task each, and the texts
chained in the pages are the entries of another round.  The directory holds at most 2 ** CELL_BITS slots: buckets grow with
the table once that is reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satchel.llm.scratch import keep

BUCKET_BYTES = 32 << 20
CELL_BITS = 16  # of a key that a directory can tell apart
MOST_BUCKETS = 1 << 13  # of full size; a larger table has larger buckets
ROW_BYTES = 64  # of an entry besides its text
HELD_BYTES, ENTRY_IDS = 32 << 20, 8192  # of equal texts, while scanning
OUT_BYTES, OUT_ROWS = 8 << 20, 4096
SALT = 64  # links that meet their total in one group of rows
BEST = "best_id long, best_entry long, best_at int"
ENTRIES = f"slot int, paged boolean, key long, entry long, sha256 string, n long, {BEST}, ids array<long>, text binary"
INDEX = f"head long, key long, entry long, salt long, ids array<long>, paged boolean, sha256 string, n long, {BEST}, links long, text binary"


@dataclass
class Directory:
    """``slots``: the bucket of each prefix of ``depth`` bits; ``pages``: of keys without a bucket, the first page and how many."""

    depth: int = 0
    slots: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int32))
    pages: dict[int, tuple[int, int]] = field(default_factory=dict)
    tasks: int = 1

    def place(self, keys: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each key, and whether it is a page."""
        prefix = keys.view(np.uint64) >> np.uint64(64 - self.depth) if self.depth else np.zeros(len(keys), dtype=np.uint64)
        slots = self.slots[prefix.astype(np.int64)]
        paged = np.isin(keys, np.fromiter(self.pages, dtype=np.int64, count=len(self.pages)))
        for at in np.flatnonzero(paged).tolist():
            first, n = self.pages[int(keys[at])]
            slots[at] = first + int(entries[at]) % n
        return slots, paged


def directory(cells: dict[int, int], capacity: int, cell_bits: int = CELL_BITS) -> Directory:
    """``cells``: bytes for each prefix of ``cell_bits`` bits.  Overfull buckets are split until they fit or bits run out."""
    loads = np.zeros((1 << cell_bits) + 1, dtype=np.int64)
    for cell, size in cells.items():
        loads[cell + 1] = size
    loads = np.cumsum(loads)
    depth, slots, bits, first = 0, np.zeros(1, dtype=np.int32), [0], [0]  # of each bucket: its bits, its first cell
    todo = [0]
    while todo:
        bucket = todo.pop()
        width = 1 << (cell_bits - bits[bucket])
        if width == 1 or loads[first[bucket] + width] - loads[first[bucket]] <= capacity:
            continue
        if bits[bucket] == depth:
            slots, depth = np.repeat(slots, 2), depth + 1
        bits[bucket] += 1
        new = len(bits)
        bits.append(bits[bucket])
        first.append(first[bucket] + width // 2)
        at = first[new] >> (cell_bits - depth)
        slots[at : at + (1 << (depth - bits[new]))] = new
        todo += [bucket, new]
    return Directory(depth, slots, {}, len(bits))


def lowered(text: Column) -> Column:
    """A-Z lowered, nothing else."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    upper = "".join(map(chr, range(65, 91)))
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def _key(text: Column, key_bits: int) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(-1 << (64 - key_bits)))


def _batch(rows: list[tuple], schema: str):
    import pyarrow as pa

    types = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    kinds = [pa.list_(pa.int64()) if k == "array<long>" else types[k] for k in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def _combined(batches: Iterator) -> Iterator[list]:
    """``[key, entry, sha256, n, best_id, best_entry, best_at, ids, text]`` of the texts held at one time."""
    from pyspark import TaskContext

    entry, held, size = TaskContext.get().partitionId() << 33, {}, 0

    def row(text, found):
        key, number, sha, ids = found
        known = [(i, at) for at, i in enumerate(ids) if i is not None]
        best_id, best_at = max(known) if known else (None, len(ids) - 1)
        return [key, number, sha, len(ids), best_id, number, best_at, ids, text]

    for batch in batches:
        doc_ids, keys, shas = (batch.column(c).to_pylist() for c in ("doc_id", "key", "sha256"))
        for doc_id, key, sha, text in zip(doc_ids, keys, shas, batch.column("text"), strict=True):
            text = text.as_py()
            found = held.get(text)
            if found is None:
                held[text] = [key, entry, sha, [doc_id]]
                entry, size = entry + 1, size + len(text) + ROW_BYTES
            else:
                found[3].append(doc_id)
                if len(found[3]) >= ENTRY_IDS:
                    yield row(text, held.pop(text))
                    size -= len(text) + ROW_BYTES
            if size > HELD_BYTES:
                for text, found in held.items():
                    yield row(text, found)
                held, size = {}, 0
    for text, found in held.items():
        yield row(text, found)


def _again(batches: Iterator) -> Iterator[list]:
    """Texts chained in a page, as entries."""
    names = ["key", "head", "sha256", "n", "best_id", "best_entry", "best_at", "text"]
    for batch in batches:
        for *others, text in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            yield [*others, None, text]


def _dealt(entries: Iterator[list], where: Directory) -> Iterator:
    def placed():
        slots, paged = where.place(np.array([x[0] for x in rows], dtype=np.int64), np.array([x[1] for x in rows], dtype=np.int64))
        return _batch([(s, p, *x) for s, p, x in zip(slots.tolist(), paged.tolist(), rows, strict=True)], ENTRIES)

    rows, size = [], 0
    for entry in entries:
        rows.append(entry)
        size += len(entry[-1]) + 8 * len(entry[-2] or ())
        if size > OUT_BYTES or len(rows) >= OUT_ROWS:
            yield placed()
            rows, size = [], 0
    if rows:
        yield placed()


def _own(batches: Iterator, with_texts: bool) -> Iterator:
    """Entries in the order of slots and keys: a link for each, and each text of a chain once its key is done."""
    chain: list[list] = []  # of the key at hand: head, sha256, n, best, links, text, paged
    last, rows, size = None, [], 0

    def done():
        for head, sha, n, best, links, text, paged in chain:
            kept = text if paged or with_texts else None
            rows.append((head, last[1], None, None, None, paged, sha, n, *best[1:], links, kept))

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in [x.split()[0] for x in ENTRIES.split(", ")][:-1])
        for (slot, paged, key, entry, sha, n, *best, ids), text in zip(zip(*columns, strict=True), batch.column("text"), strict=True):
            text = text.as_py()
            if (slot, key) != last:
                done()
                last, chain = (slot, key), []
            best = (best[0] is not None, *best)
            for found in chain:
                if found[5] == text:
                    found[2] += n
                    # All equal means no id at all, then the last row counts.
                    found[3] = max(found[3], best, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))
                    found[4] += 1
                    break
            else:
                found = [entry, sha, n, best, 1, text, paged]
                chain.append(found)
                size += len(text) if paged or with_texts else 0
            rows.append((found[0], key, entry, (found[4] - 1) // SALT, ids, None, None, None, None, None, None, None, None))
            size += 8 * len(ids or ())
            if size > OUT_BYTES or len(rows) >= OUT_ROWS:
                yield _batch(rows, INDEX)
                rows, size = [], 0
    done()
    if rows:
        yield _batch(rows, INDEX)


def _plan(loads: DataFrame, bucket_bytes: int, least: int) -> Directory:
    """``loads``: ``key, bytes, n``.  At most 65,536 cells and as many keys as there are buckets come to the driver."""
    cell = F.shiftrightunsigned("key", 64 - CELL_BITS).cast("int").alias("cell")
    total = loads.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(bucket_bytes, total // MOST_BUCKETS)
    # A page of few entries would not make them fewer.
    heavy = loads.where((F.col("bytes") > capacity) & (F.col("n") >= least)).withColumn("pages", F.least(
        F.ceil(F.col("bytes") / capacity), F.ceil(F.col("n") / least)
    ))
    pages = {row["key"]: row["pages"] for row in heavy.select("key", "pages").collect()}
    light = loads.where(~F.col("key").isin(list(pages))) if pages else loads
    cells = {row["cell"]: row["size"] for row in light.groupBy(cell).agg(F.sum("bytes").alias("size")).collect()}
    where = directory(cells, capacity)
    for key, n in pages.items():
        where.pages[key] = (where.tasks, n)
        where.tasks += n
    return where


def _round(entries: DataFrame, read, loads: DataFrame, bucket_bytes: int, page_entries: int, with_texts: bool):
    """``(links, classes)``: ``head, salt, entry, ids`` and ``head, links`` beside the totals of the class."""
    where = _plan(loads, bucket_bytes, page_entries)
    dealt = entries.mapInArrow(lambda batches: _dealt(read(batches), where), ENTRIES)
    owned = dealt.repartitionById(where.tasks, F.col("slot")).sortWithinPartitions("slot", "key", "entry")
    index = keep(owned.mapInArrow(lambda batches: _own(batches, with_texts), INDEX), "index")
    links, heads = index.where("entry is not null").select("head", "salt", "entry", "ids"), index.where("entry is null")
    totals = ["sha256", "n", "best_id", "best_entry", "best_at"]
    classes = heads.where("not paged").select("head", "links", *totals)
    if where.pages:
        paged = heads.where("paged")
        sizes = paged.groupBy("key").agg(F.sum(F.octet_length("text") + ROW_BYTES).alias("bytes"), F.count("*").alias("n"))
        before, now = loads.where(F.col("key").isin(list(where.pages))).agg(F.sum("n")).first()[0], paged.count()
        # Where a round left more than half of the entries, they hold different texts and one chain takes them all.
        least = page_entries if 2 * now <= before else now + 1
        over, found = _round(paged, _again, sizes, bucket_bytes, least, with_texts)
        whose = over.select(F.col("entry").alias("head"), F.col("head").alias("top"), "salt").join(
            salted(found).withColumnRenamed("head", "top"), ["top", "salt"]
        )
        classes = classes.unionByName(paged.select("head", "links").join(whose.select("head", *totals), "head"))
    return links, classes


def salted(classes: DataFrame) -> DataFrame:
    """A class once for each ``salt`` of its links, so that no task gets all links of a large class."""
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(links - 1) div {SALT}"))).alias("salt")
    return classes.select("*", salts).drop("links")


def duplicates(
    docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, page_entries: int = 16, key_bits: int = 64, with_texts: bool = False
) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id, text``): ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are the same once A-Z is lowered; a null text is an empty one.  Of equal texts the row with
    the largest ``doc_id`` stays, and of several with that id one; a null id is smaller than any other, and if a group has
    no other id one of its rows stays and ``keep_id`` is null.  Extra columns are left out; an empty table gives an empty
    one.  ``key_bits``: how many bits of the hash count; ``with_texts`` also writes each chained text to the index.
    """
    text = F.coalesce(lowered(F.col("text")), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keyed = rows.select("doc_id", _key(F.col("text"), key_bits).alias("key"), "text")
    loads = keyed.groupBy("key").agg(F.sum(F.octet_length("text") + ROW_BYTES).alias("bytes"), F.count("*").alias("n"))
    read = keyed.select("doc_id", "key", F.sha2("text", 256).alias("sha256"), F.col("text").cast("binary").alias("text"))
    links, classes = _round(read, _combined, keep(loads, "loads"), bucket_bytes, page_entries, with_texts)
    found = links.join(salted(classes), ["head", "salt"]).select("*", F.posexplode("ids").alias("at", "doc_id"))
    return found.select(
        "doc_id", F.col("best_id").alias("keep_id"), F.col("n").alias("group_size"),
        ((F.col("entry") == F.col("best_entry")) & (F.col("at") == F.col("best_at"))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )

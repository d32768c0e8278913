"""Token ids in patched frame-of-reference blocks.

A file is a Parquet part whose rows are segments, in ascending order of documents.  A segment holds the ids of whole
documents as one blob of blocks.  A block of 1,024 ids takes its minimum off, packs the rest at the width that the
given share of them needs, and lists the outliers, position and high bits, after the packed words.  The block starts
stand at the front of the blob, so that any range of ids is read without the blocks before it.

Blob, all numbers little-endian: u4 number of ids, u4 number of blocks, u4 start of each block in the bytes that follow;
a block: u4 minimum, u1 width, u1 width of the outliers' high bits, u2 number of outliers, the packed low bits, u2 position
of each outlier, and the packed high bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satchel.llm.ranks import PART, before
from satchel.llm.scratch import new_path
from satchel.llm.tokens import encoder
from satchel.session import bound_batches

BLOCK = 1024
SHARE = 0.98  # of a block's ids must fit the packed width; the rest are outliers
SEGMENT_IDS = 1 << 18
SEGMENTS = "part int, segment long, doc_ids array<long>, lengths array<int>, blob binary"


def _word(width: int) -> tuple[str, int]:
    """The smallest word of ``width`` bits and its bytes; fewer bits are spread out for it."""
    return ("<u2", 2) if width <= 16 else ("<u4", 4)


def bits(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of each value, one after the other."""
    if not width or not len(values):
        return b""
    kind, size = _word(width)
    if width == 8 * size:
        return values.astype(kind).tobytes()
    planes = np.unpackbits(values.astype(kind).view(np.uint8).reshape(-1, size), axis=1, bitorder="little")
    return np.packbits(planes[:, :width], bitorder="little").tobytes()


def values(packed: np.ndarray, count: int, width: int) -> np.ndarray:
    """The reverse of ``bits``."""
    if not width or not count:
        return np.zeros(count, dtype=np.uint32)
    kind, size = _word(width)
    if width == 8 * size:
        return packed[: count * size].view(kind).astype(np.uint32)
    planes = np.zeros((count, 8 * size), dtype=np.uint8)
    planes[:, :width] = np.unpackbits(packed, count=count * width, bitorder="little").reshape(count, width)
    return np.packbits(planes, axis=1, bitorder="little").view(kind).ravel().astype(np.uint32)


def width_of(value: int) -> int:
    return int(value).bit_length()


def packed_size(count: int, width: int) -> int:
    return (count * width + 7) // 8


def encode_block(ids: np.ndarray, share: float = SHARE) -> bytes:
    low = int(ids.min())
    rest = ids - np.uint32(low)
    most = int(rest.max())
    width = width_of(np.partition(rest, k := int(share * (len(rest) - 1)))[k])
    outliers = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, dtype=np.int64)
    if len(outliers) * (16 + width_of(most) - width) >= len(rest) * (width_of(most) - width):
        width, outliers = width_of(most), outliers[:0]  # the list would take more than the wider words
    high = width_of(most) - width if len(outliers) else 0
    head = np.array([low], dtype="<u4").tobytes() + bytes([width, high]) + np.array([len(outliers)], dtype="<u2").tobytes()
    patches = outliers.astype("<u2").tobytes() + bits(rest[outliers] >> np.uint32(min(width, 31)), high)
    return head + bits(rest, width) + patches


def decode_block(block: memoryview, count: int) -> np.ndarray:
    low, width, high = int.from_bytes(block[:4], "little"), block[4], block[5]
    n = int.from_bytes(block[6:8], "little")
    raw, at = np.frombuffer(block, dtype=np.uint8), 8
    out = values(raw[at:], count, width)
    if n:
        at += packed_size(count, width)
        where = np.frombuffer(block, dtype="<u2", count=n, offset=at)
        out[where] |= values(raw[at + 2 * n :], n, high) << np.uint32(width)
    return out + np.uint32(low)


def encode(ids: np.ndarray, block: int = BLOCK, share: float = SHARE) -> bytes:
    blocks = [encode_block(ids[at : at + block], share) for at in range(0, len(ids), block)]
    starts = np.cumsum([0, *map(len, blocks)], dtype=np.int64)[:-1]
    head = np.array([len(ids), len(blocks)], dtype="<u4").tobytes()
    return head + starts.astype("<u4").tobytes() + b"".join(blocks)


def decode(blob: bytes, start: int = 0, stop: int | None = None, block: int = BLOCK) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a blob; only the blocks that hold them are unpacked."""
    n, blocks = np.frombuffer(blob, dtype="<u4", count=2).tolist()
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.empty(0, dtype=np.uint32)
    starts = np.frombuffer(blob, dtype="<u4", count=blocks, offset=8).tolist()
    body = memoryview(blob)[8 + 4 * blocks :]
    ends = [*starts[1:], len(body)]
    first, last = start // block, (stop - 1) // block
    found = [decode_block(body[starts[b] : ends[b]], min(block, n - b * block)) for b in range(first, last + 1)]
    return np.concatenate(found)[start - first * block : stop - first * block]


class Settings(NamedTuple):
    tokenizer: str
    kind: str
    end_id: int
    block: int
    share: float


def _segments(batches: Iterator, settings: Settings) -> Iterator:
    import pyarrow as pa
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    encode_text, end = encoder(settings.tokenizer, settings.kind), np.array([settings.end_id], dtype="<u4").tobytes()
    segment, ids, lengths, held, size = 0, [], [], [], 0

    def flush():
        nonlocal segment, ids, lengths, held, size
        blob = encode(np.frombuffer(b"".join(held), dtype="<u4"), settings.block, settings.share)
        columns = [[part], [segment], [ids], [lengths], [blob]]
        types = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        row = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "segment", "doc_ids", "lengths", "blob"]
        )
        segment, ids, lengths, held, size = segment + 1, [], [], [], 0
        return row

    for batch in batches:
        texts = batch.column("text")
        for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            found = encode_text(texts[i].as_py()) + end
            ids.append(doc_id)
            lengths.append(len(found) // 4)
            held.append(found)
            size += len(found) // 4
            if size >= SEGMENT_IDS:
                yield flush()
    if ids:
        yield flush()


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, kind: str, end_id: int, block: int = BLOCK, share: float = SHARE
) -> None:
    """Write the ids of ``docs`` (``doc_id``, ``text``) to ``path`` in ascending order of ``doc_id``.

    A null text is an empty one: its only id is the end.  Rows with one ``doc_id`` are kept each, ordered by text, and a
    null ``doc_id`` comes first.  Extra columns are left out.  An empty table gives an empty folder of files.
    """
    bound_batches(docs.sparkSession)
    settings = Settings(tokenizer, kind, end_id, block, share)
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(lambda batches: _segments(batches, settings), SEGMENTS).write.parquet(path)


def _documents(batches: Iterator, block: int, with_ids: bool) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]  # a session with no or a high limit hands over many segments at once
            ids = decode(row["blob"], block=block)
            ends = np.cumsum(row["lengths"], dtype=np.int64)
            starts = ends - row["lengths"]
            raw = [ids[s:e].astype("<u4").tobytes() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(raw)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()), "part": pa.array([row["part"]] * n, pa.int32()),
                "segment": pa.array([row["segment"]] * n, pa.int64()), "in_segment": pa.array(starts, pa.int64()),
                "n_tokens": pa.array(row["lengths"], pa.int64()), "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                "ids": pa.array(raw if with_ids else [None] * n, pa.binary()),
            })


def read_tokens(spark: SparkSession, path: str, block: int = BLOCK, with_ids: bool = True) -> DataFrame:
    """One row per document of the files: ``doc_id, start, n_tokens, ids_crc32, ids``, ``start`` over all files.

    ``ids`` are little-endian unsigned 32-bit integers, null without ``with_ids``.
    """
    bound_batches(spark)
    files = spark.read.schema(SEGMENTS).parquet(path)
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = files.select(F.col("part").alias(PART), "segment", length.alias("n"))
    # One row per segment of a quarter of a million ids: a part's own sum first, then the parts before it.
    parts = sizes.groupBy(PART).agg(F.sum("n").alias("n"))
    base = parts.select(F.col(PART).alias("part"), F.coalesce(F.sum("n").over(before()), F.lit(0)).alias("base"))
    inside = _within(sizes)
    starts = inside.join(base, "part").select("part", "segment", (F.col("base") + F.col("inside")).alias("base"))
    schema = "doc_id long, part int, segment long, in_segment long, n_tokens long, ids_crc32 long, ids binary"
    docs = files.mapInArrow(lambda batches: _documents(batches, block, with_ids), schema)
    return docs.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("in_segment")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def _within(sizes: DataFrame) -> DataFrame:
    """What comes before each segment in its own part."""
    earlier = Window.partitionBy(PART).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        F.col(PART).alias("part"), "segment", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("inside")
    )


def round_trip(docs: DataFrame, tokenizer: str, kind: str, end_id: int) -> DataFrame:
    """Write the files into the shared folder and read them back without their ids."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, kind, end_id)
    return read_tokens(docs.sparkSession, path, with_ids=False).drop("ids")

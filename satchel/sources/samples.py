"""Deterministic files made from the sample tables, for queries, tests and benchmarks.

Every file comes from one row, so nothing is grouped or shuffled to make it and its size is bounded by that row.
An archive holds the lines of one document, one file per line.
"""

from __future__ import annotations

import binascii
import struct
import sys
import tarfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PDF_HEADER = b"%PDF-1.4\n"
BASE_TIME = 1704067200

# Hex prefix put before a document by doc_id % 8.
PREFIXES = (
    "",
    "255044462D312E340A",
    "504B0304",
    "1F8B08",
    "89504E470D0A1A0A",
    "377ABCAF271C",
    "526172211A0700",
    "425A68",
)
# Tar file modes by doc_id div 2 % 4.
MODES = (0o644, 0o755, 0o600, 0o4751)
ZIP_DATE = (2024 - 1980) << 9 | 1 << 5 | 1  # of every file in a zip, at midnight


# The columns used of each sample table; given to the reader so that no job is needed to infer them.
COLUMNS = {
    "documents": "doc_id long, text string, lang string, n_chars long",
    "pages": "page_id long, html string",
    "customer": "c_custkey long, c_name string, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows mean much work each.

    Read from a few splits, it is dealt out over the cores first; read from many, as any large table is, it stays as it
    was scanned and nothing is exchanged.
    """
    rows = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < 4 * cores else rows


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as HTML and documents behind one of eight magic prefixes: ``file_id, filename, content``."""
    pages = text_table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), "page_id").alias("file_id"), F.encode("html", "UTF-8").alias("content")
    )
    prefix = F.element_at(F.array(*[F.lit(p) for p in PREFIXES]), (F.col("doc_id") % 8 + 1).cast("int"))
    docs = text_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), "doc_id").alias("file_id"),
        F.concat(F.unhex(prefix), F.encode("text", "UTF-8")).alias("content"),
    )
    return pages.unionByName(docs).select("file_id", F.col("file_id").alias("filename"), "content")


def archives(spark: SparkSession, sf_dir: str, layout: str = "flat", planted: bool = False) -> DataFrame:
    """One archive per document: ``archive_id, filename, lang, content``.

    Even documents become zips, odd ones tars (with owner, group, mode and time).  Line ``i`` is one file; its name
    shows a case of path handling by ``i % 4``.  Layouts beyond ``flat``: ``nested`` moves lines ``i % 6 = 2`` to
    ``inner.zip``, the first member, and lines ``i % 6 = 5`` to ``deep.tar`` inside that; ``broken`` is the same with
    ``inner.zip`` cut to half its length where ``doc_id % 4 = 1``.  ``planted`` puts a PDF header before lines
    ``i % 4 = 3``.
    """
    docs = text_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("archive_id"),
        F.concat(F.lit("doc-"), "doc_id", F.when(F.col("doc_id") % 2 == 0, ".zip").otherwise(".tar")).alias("filename"),
        "lang",
        F.split("text", "\n", -1).alias("lines"),
    )
    return docs.mapInArrow(
        lambda batches: pack_batches(batches, layout, planted), "archive_id long, filename string, lang string, content binary"
    )


def entry_name(lang: str, i: int) -> str:
    return (f"{lang}/line-{i}.txt", f"line-{i}.txt", f"{lang}//sub/line-{i}.txt", f"/line-{i}.txt")[i % 4]


def pack_zip(members: list[tuple[str, bytes]]) -> bytes:
    """The bytes that ``zipfile`` writes for these members, put together without its bookkeeping for each."""
    out, directory, at = [], [], 0
    for name, data in members:
        encoded = name.encode()
        deflate = zlib.compressobj(zlib.Z_DEFAULT_COMPRESSION, zlib.DEFLATED, -15)
        packed = deflate.compress(data) + deflate.flush()
        flags = 0 if name.isascii() else 0x800
        common = (20, flags, 8, 0, ZIP_DATE, binascii.crc32(data), len(packed), len(data), len(encoded), 0)
        out += (struct.pack("<4s5H3L2H", b"PK\3\4", *common), encoded, packed)
        directory += (struct.pack("<4sBB5H3L5H2L", b"PK\1\2", 20, 3, *common, 0, 0, 0, 0o600 << 16, at), encoded)
        at += 30 + len(encoded) + len(packed)
    listed = b"".join(directory)
    end = struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, len(members), len(members), len(listed), at, 0)
    return b"".join((*out, listed, end))


def pack_tar(members: list[tuple[str, bytes]], archive_id: int) -> bytes:
    """Headers of one archive differ only in name, size, type and the sum over them, so the rest is written once."""
    info = tarfile.TarInfo()
    info.mode = MODES[archive_id // 2 % 4]
    info.uname = f"user{archive_id % 7}"
    info.gname = f"group{archive_id % 3}"
    info.mtime = BASE_TIME + archive_id
    blank = info.tobuf(tarfile.GNU_FORMAT)
    owned, marked = blank[100:124], blank[136:148]  # mode and ids; time
    rest = blank[157:]
    fixed = sum(owned) + sum(marked) + sum(rest) + 8 * 32
    out = []
    for name, data in members:
        folder = name.endswith("/")
        kind = tarfile.DIRTYPE if folder else tarfile.REGTYPE
        named = name.encode()
        if len(named) > tarfile.LENGTH_NAME:
            info.name, info.size, info.type = name, len(data), kind
            out.append(info.tobuf(tarfile.GNU_FORMAT))
        else:
            sized = b"%011o\0" % len(data)
            total = fixed + sum(named) + sum(sized) + kind[0]
            out += (named.ljust(100, b"\0"), owned, sized, marked, b"%06o\0 " % total, kind, rest)
        out += (data, bytes(-len(data) % tarfile.BLOCKSIZE))
    return b"".join((*out, bytes(2 * tarfile.BLOCKSIZE)))


def pack_document(archive_id: int, lang: str, lines: list[str], layout: str, planted: bool) -> bytes:
    files = []
    for i, line in enumerate(lines):
        header = PDF_HEADER if planted and i % 4 == 3 else b""
        files.append((entry_name(lang, i), header + line.encode()))
    members = [(f"{lang}/", b"")]
    if layout != "flat":
        deep = files[5::6]
        inner = files[2::6] + ([("deep.tar", pack_tar(deep, archive_id))] if deep else [])
        files = [f for i, f in enumerate(files) if i % 3 != 2]
        if inner:
            packed = pack_zip(inner)
            members.append(("inner.zip", packed[: len(packed) // 2] if layout == "broken" and archive_id % 4 == 1 else packed))
    members += files
    return pack_zip(members) if archive_id % 2 == 0 else pack_tar(members, archive_id)


def pack_batches(batches: Iterable[pa.RecordBatch], layout: str, planted: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, langs, lines = (batch.column(c) for c in ("archive_id", "lang", "lines"))
        for start in range(0, batch.num_rows, 256):
            part = range(start, min(start + 256, batch.num_rows))
            packed = [pack_document(ids[i].as_py(), langs[i].as_py(), lines[i].as_py(), layout, planted) for i in part]
            kept = batch.slice(start, len(packed)).drop_columns(["lines"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(packed, pa.binary())], names=[*kept.schema.names, "content"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])

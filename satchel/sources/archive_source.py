"""Archives as a table: ``spark.read.format("archive").load(folder)``, one row per archive and one per file inside.

The rows are those of ``operators.unpack`` before they are named and routed.  Archives are put together into partitions of
about ``partBytes`` by their sizes, or of less where that gives few partitions, before any is opened.  Options:

* ``glob``: which archives, by their file names; ``recursive``, ``budget``, as for ``unpack``
* ``emit``: ``all`` rows, ``parents`` or ``children``; with ``parents`` no file is held
* ``name``, ``minSize``, ``maxSize``: which files inside, by a pattern of their names and by their sizes; no others are held
* ``withData``: ``false`` for no ``data`` column and no bytes

These are options, not filters that Spark hands over: Spark 4.1 keeps a reader that was given filters and reads through it
again for a later query on the same frame that has none, which then misses rows.
"""

from __future__ import annotations

import fnmatch
import sys
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_type

from satchel.functions import archive_tasks, walker
from satchel.functions.columns import size_option

PARTS = 64
LEAST_BYTES = 4 * 2**20


class Chosen(NamedTuple):
    name: str
    least: int
    most: int

    def __call__(self, entry: walker.Entry) -> bool:
        return fnmatch.fnmatchcase(entry.name, self.name) and entry.size >= self.least and (self.most < 0 or entry.size <= self.most)


class Archives(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str, options: archive_tasks.UnpackOptions, chosen: Chosen, part_bytes: int, glob: str):
        self.folder, self.options, self.chosen, self.part_bytes, self.glob = folder, options, chosen, part_bytes, glob

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        filesystem, inner = fs.FileSystem.from_uri(archive_tasks.as_uri(self.folder))
        prefix = self.folder.rstrip("/").removesuffix(inner.rstrip("/"))
        listed = filesystem.get_file_info(fs.FileSelector(inner, recursive=True))
        named = [x for x in listed if x.type == fs.FileType.File and not x.base_name.startswith(("_", "."))]
        named = sorted((x for x in named if fnmatch.fnmatchcase(x.base_name, self.glob)), key=lambda x: x.path)
        # what one partition of the wanted size could hold may still be work for many cores
        room = min(self.part_bytes, max(sum(x.size for x in named) // PARTS, LEAST_BYTES))
        groups, held, size = [], [], 0
        for info in named:
            if held and size + info.size > room:
                groups.append(Archives(held))
                held, size = [], 0
            held.append(prefix + info.path)
            size += info.size
        return [*groups, Archives(held)]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        kept = pa.RecordBatch.from_arrays([pa.array(partition.paths, pa.string())], ["archive"])

        def produce(i: int) -> Iterator[tuple]:
            with archive_tasks.remote_source(partition.paths[i]) as source:
                yield from archive_tasks.archive_rows(source, self.options, self.chosen)

        yield from archive_tasks.bounded_batches(kept, produce, self.options.columns | archive_tasks.TALLY_COLUMNS)


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def _unpack(self) -> archive_tasks.UnpackOptions:
        emit = self.options.get("emit", "all")
        if emit not in ("all", "parents", "children"):
            raise ValueError("emit is one of all, parents and children")
        recursive, with_data = (self.options.get(*x).lower() == "true" for x in (("recursive", "false"), ("withData", "true")))
        return archive_tasks.UnpackOptions(recursive, size_option(self.options.get("budget", "-1")), True, True, emit, with_data)

    def schema(self) -> T.StructType:
        kinds = {"archive": pa.string()} | self._unpack().columns | archive_tasks.TALLY_COLUMNS
        return T.StructType([T.StructField(name, from_arrow_type(kind)) for name, kind in kinds.items()])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        given = self.options.get
        chosen = Chosen(given("name", "*"), size_option(given("minSize", "0 B")), size_option(given("maxSize", "-1")))
        return ArchiveReader(given("path"), self._unpack(), chosen, size_option(given("partBytes", "256 MB")), given("glob", "*"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArchiveSource)


cloudpickle.register_pickle_by_value(sys.modules[__name__])

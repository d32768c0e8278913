"""Where files come from and where outcomes go."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satchel.functions import archive_tasks, mime
from satchel.functions.magic import Rule
from satchel.session import bound_batches

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def _as_files(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.sha2("path", 256).alias("file_id"),
        F.substring_index("path", "/", -1).alias("filename"),
        F.col("path").alias("source_path"),
        F.col("modificationTime").alias("mtime"),
        *[c for c in ("length", "content") if c in raw.columns],
    )


def read_files(spark: SparkSession, path: str, glob: str | None = None, with_content: bool = True) -> DataFrame:
    """Whole files as rows.  Filters on ``length`` and ``mtime`` reach the scan, and bytes are read only if used.

    Spark's reader has the driver hold some 0.8 KB for each file.  Without ``with_content`` the rows are the same but for that
    column, and tasks list the folder when the query runs, each subfolder by one, so the driver holds nothing of it.  What
    Arrow cannot list, and a path with a pattern, is left to the driver all the same.
    """
    if not with_content and (root := _folder(spark, path)):
        return _as_files(_listed(spark, root, glob))
    reader = spark.read.format("binaryFile")
    read = _as_files((reader.option("pathGlobFilter", glob) if glob else reader).load(path))
    return read if with_content else read.drop("content")


def _folder(spark: SparkSession, path: str) -> str | None:
    """The path as Spark writes it, if it is a folder that Arrow reads too."""
    from pyarrow import fs

    if any(x in path for x in "{}[]*?\\"):
        return None
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = named.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(named).toString()
    try:
        filesystem, inner, prefix = archive_tasks.place_of(root)
        is_folder = filesystem.get_file_info(inner).type == fs.FileType.Directory
    except (OSError, ValueError, NotImplementedError):
        return None
    return root if is_folder and prefix + inner == root else None


def _listed(spark: SparkSession, root: str, glob: str | None) -> DataFrame:
    """Two passes, dealt out anew behind each: one over the folder itself, one over its subfolders."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(0, 1, 1, 1).select(F.lit(root).alias("path"), *[F.lit(None).cast("long").alias(c) for c in ("mtime_ms", "length")])
    for whole in (False, True):
        rows = rows.mapInArrow(partial(archive_tasks.list_batches, root=root, whole=whole), rows.schema).repartition(tasks, "path")
    if glob:
        pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
        rows = rows.filter(F.substring_index("path", "/", -1).rlike(rf"^(?s:{pattern})\z"))
    return rows.select("path", F.timestamp_millis("mtime_ms").alias("modificationTime"), "length")


def stream_files(spark: SparkSession, path: str, glob: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(BINARY_FILE_SCHEMA).format("binaryFile").option("maxFilesPerTrigger", files_per_trigger)
    return _as_files((reader.option("pathGlobFilter", glob) if glob else reader).load(path))


def table_files(table: DataFrame, id_col: Column, filename: Column, content: Column) -> DataFrame:
    """Rows of any table as files; text becomes its UTF-8 bytes."""
    data = F.encode(content, "UTF-8") if _is_text(table, content) else content
    return table.select(id_col.alias("file_id"), filename.alias("filename"), data.alias("content"))


def _is_text(table: DataFrame, content: Column) -> bool:
    return isinstance(table.select(content).schema.fields[0].dataType, T.StringType)


def write_files(rows: DataFrame, folder: str, folders: int = 0) -> None:
    """Every row's ``content`` as a file of its ``filename`` in ``folder``, which the executors must reach; null is empty.

    Names say no more than their last part; of several rows with one name the last one written stays.  With ``folders``
    files lie in that many subfolders by a hash of their names, so no folder grows long and many tasks can list them.
    """
    filesystem, inner, _ = archive_tasks.place_of(folder)
    filesystem.create_dir(inner)
    for name in archive_tasks.subfolders(folders):
        filesystem.create_dir(f"{inner}/{name}")
    bound_batches(rows.sparkSession)
    named = rows.select(F.substring_index("filename", "/", -1).alias("filename"), "content")
    written = named.mapInArrow(lambda batches: archive_tasks.write_batches(batches, folder, folders), "filename string")
    written.write.format("noop").mode("overwrite").save()


def one_file(spark: SparkSession, path: str) -> str:
    """The text of the one file that ``path`` names."""
    found = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{path} names {'several files' if found else 'no file'}, one is needed")
    return found[0][0]


def load_rules(spark: SparkSession, body: str | None = None, path: str | None = None) -> list[Rule] | None:
    """A user's type rules, given inline or as a file; None, the built-in table, when neither is given."""
    if body is not None and path is not None:
        raise ValueError("give only one of body and path")
    if path is not None:
        body = one_file(spark, path)
    return None if body is None else mime.parse_rules(body)


def split_routes(outcome: DataFrame, *routes: str) -> dict[str, DataFrame]:
    return {route: outcome.filter(F.col("route") == route) for route in routes}


def write_routes(outcome: DataFrame, path: str, mode: str = "append") -> None:
    """Every route into its own directory, in one pass over the outcome."""
    outcome.write.mode(mode).partitionBy("route").parquet(path)

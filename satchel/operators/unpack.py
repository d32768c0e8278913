"""Archive unpacking: one archive row becomes one parent row and one row per file inside.

The Python stage reads bytes only.  It is a ``mapInArrow`` over the archive rows, so it is narrow, runs in batch and in
streams alike, needs no key, and gives its output in bounded batches however much an archive expands to.  Everything
that describes, names or routes the rows is a column expression on top.

Departures from the original semantics, on purpose: one fragment id per archive, derived from its id; permissions from
the permission bits; real entry sizes count against the budget; times in UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from satchel import schema
from satchel.functions import archive_tasks, columns, magic, mime
from satchel.session import bound_batches


def _fields(kinds: dict) -> list[T.StructField]:
    return [T.StructField(name, from_arrow_type(kind)) for name, kind in kinds.items()]


_ADDED = archive_tasks.ENTRY_COLUMNS | archive_tasks.TALLY_COLUMNS
TALLY_FIELDS = _fields(archive_tasks.TALLY_COLUMNS)
TASKS_A_CORE = 16
TOGETHER_BYTES = 2**24  # of an archive, whose parts go to one task


def _options(
    recursive: bool, budget: str | int, fail_on_breach: bool, fail_on_sub_error: bool, emit: str, with_data: bool,
    chunk_bytes: str | int,
) -> archive_tasks.UnpackOptions:
    if emit not in ("all", "parents", "children"):
        raise ValueError("emit is one of all, parents and children")
    chunk = columns.size_option(chunk_bytes)
    if not 0 < chunk <= archive_tasks.walker.MAX_CELL_BYTES:
        raise ValueError("chunk_bytes must be at least one byte and fit a row")
    return archive_tasks.UnpackOptions(
        recursive, columns.size_option(budget), fail_on_breach, fail_on_sub_error, emit, with_data, chunk
    )


def unpack(
    archives: DataFrame,
    content: str = "content",
    id_col: str = "file_id",
    filename_col: str = "filename",
    *,
    recursive: bool = False,
    budget: str | int = "80 MB",
    fail_on_breach: bool = True,
    fail_on_sub_error: bool = True,
    fail_on_nothing: bool = True,
    non_archive_to_failure: bool = False,
    emit: str = "all",
    with_data: bool = True,
    chunk_bytes: str | int = archive_tasks.walker.MAX_CELL_BYTES,
) -> DataFrame:
    """Parents and children as rows of one frame; take them apart with ``parents`` and ``children``.

    What is not needed is best not asked for: the optimizer cannot see into the stage that reads the archives.  ``emit`` is
    ``all``, ``parents`` or ``children``; without ``with_data`` children have no ``content``.  Either way each archive is read
    to its end, so routes and errors are the same, but nothing is held or handed on.

    A file larger than ``chunk_bytes`` comes as several rows with one ``pos``, numbered by ``chunk_index`` from 0; the last
    has the digest of them all in ``chunks_sha256``.

    The columns of the input ride along on every row, so children inherit them, except the content of the archive and
    columns of a name this adds; the result can itself be unpacked again.
    Only the bytes of files whose type can be opened reach the Python stage, and in a session without a limit for them no
    more than 4 MB, or one row, at once.
    """
    options = _options(recursive, budget, fail_on_breach, fail_on_sub_error, emit, with_data, chunk_bytes)
    bound_batches(archives.sparkSession)
    typed = archives.withColumn("archive_mime_type", mime.clean(mime.detect(content)))
    openable = mime.is_archive_type(F.col("archive_mime_type"))
    carried = [c for c in typed.columns if c != content and c not in _ADDED]
    staged = typed.select(*carried, F.when(openable, F.col(content)).alias("_content"))
    out_schema = T.StructType(staged.drop("_content").schema.fields + _fields(options.columns) + TALLY_FIELDS)

    rows = staged.mapInArrow(lambda batches: archive_tasks.unpack_batches(batches, options), out_schema)
    return _routed(rows, id_col, filename_col, recursive, fail_on_nothing, non_archive_to_failure)


def unpack_large(
    archives: DataFrame,
    path_col: str = "source_path",
    id_col: str = "file_id",
    filename_col: str = "filename",
    *,
    recursive: bool = False,
    budget: str | int = -1,
    fail_on_breach: bool = True,
    fail_on_sub_error: bool = True,
    fail_on_nothing: bool = True,
    non_archive_to_failure: bool = False,
    part_bytes: str | int = "256 MB",
    tasks: int | None = None,
    emit: str = "all",
    with_data: bool = True,
    chunk_bytes: str | int = archive_tasks.walker.MAX_CELL_BYTES,
) -> DataFrame:
    """``unpack`` for archives of any size, read from where they lie instead of from a content column.

    A first pass walks each archive to its verdict and keeps nothing but where its parts begin: a place in the directory
    of a zip, the offset of a header in a tar.  An archive is then as many rows as it has parts of ``part_bytes``, spread
    over the cluster, and each part reads only its own files: one archive that makes up a third of the data is many tasks,
    which together read it once.  Inside a compressed tar, and with ``recursive``, there is no place to begin at: a part
    passes over the files before its own and ends with its last one.  The executors must reach the paths.

    The parts are dealt out to ``tasks`` tasks, by default as many as the session shuffles into; parts of fewer than 16 MB
    that lie side by side go to the same task, which reads them in one walk.  The number is given to
    Spark explicitly: the rows that name the parts are tiny, and runtime re-planning would merge them into one task.
    """
    tasks = tasks or int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    options = _options(recursive, budget, fail_on_breach, fail_on_sub_error, emit, with_data, chunk_bytes)
    carried = [c for c in archives.columns if c not in (path_col, "content") and c not in _ADDED]
    # a folder of many small files comes as a task for every few of them
    fewer = TASKS_A_CORE * archives.sparkSession.sparkContext.defaultParallelism
    staged = archives.select(*carried, F.col(path_col).alias("_path")).coalesce(fewer)
    part_size = columns.size_option(part_bytes)
    tallied_schema = T.StructType(staged.schema.fields + TALLY_FIELDS + _fields(archive_tasks.KIND_COLUMNS))
    tallied = staged.mapInArrow(lambda batches: archive_tasks.tally_batches(batches, options, part_size), tallied_schema)

    good = F.col("error_class").isNull() & (F.col("n_unpacked") > 0)
    computed = schema.with_computed(tallied, archive_mime_type=mime.clean(F.col("_kind")), _good=good).drop("_kind")
    cuts = F.when(F.col("_good"), F.col("_cuts")).otherwise(F.slice("_cuts", 1, 1))
    split = (
        computed.select("*", F.posexplode(cuts).alias("_part", "_cut"))
        .withColumn("_to", F.coalesce(F.get("_cuts", F.col("_part") + 1)["files"], "n_unpacked"))
        .drop("_cuts")
        .repartition(tasks, "_path", F.expr(f"_cut.bytes div {max(part_size, TOGETHER_BYTES)}L"))
        .sortWithinPartitions("_path", "_part")
    )
    out_fields = [f for f in split.schema.fields if f.name not in archive_tasks.PART_COLUMNS]
    rows = split.mapInArrow(
        lambda batches: archive_tasks.part_batches(batches, options), T.StructType(out_fields + _fields(options.columns))
    )
    return _routed(rows, id_col, filename_col, recursive, fail_on_nothing, non_archive_to_failure)


def _routed(
    rows: DataFrame, id_col: str, filename_col: str, recursive: bool, fail_on_nothing: bool, non_archive_to_failure: bool
) -> DataFrame:
    is_child = F.col("pos").isNotNull()
    unopenable = ~mime.is_archive_type(F.col("archive_mime_type"))
    not_archive = unopenable | F.col("error_class").eqNullSafe(schema.NOT_AN_ARCHIVE)
    nothing = F.col("n_unpacked") == 0
    failed = (
        F.when(mime.is_unreadable_archive_type(F.col("archive_mime_type")), schema.error(schema.UNSUPPORTED, "not a supported archive"))
        .when(not_archive, schema.error(schema.NOT_AN_ARCHIVE, "not an archive or not a supported archive"))
        .when(F.col("error_class").isNotNull(), schema.error(F.col("error_class"), F.col("error_message")))
        .when(nothing & F.lit(fail_on_nothing), schema.error(schema.NOTHING_UNPACKED, "no file came out"))
    )
    parent_route = (
        F.when(not_archive, schema.FAILURE if non_archive_to_failure else schema.ORIGINAL)
        .when(F.col("error").isNotNull(), schema.FAILURE)
        .otherwise(schema.ORIGINAL)
    )
    has_files = F.col("n_unpacked") > 0
    typed = recursive and "entry_kind" in rows.columns
    child_mime = mime.clean(F.col("entry_kind")) if typed else F.lit(magic.OCTET_STREAM)
    return (
        schema.with_computed(
            rows,
            error=F.when(~is_child, failed),
            mime_type=F.when(is_child, child_mime).otherwise(F.col("archive_mime_type")),
        )
        .withColumn("route", F.when(is_child, schema.SUCCESS).otherwise(parent_route))
        .withColumn("fragment_id", F.when(has_files, F.sha2(F.col(id_col).cast("string"), 256)))
        .withColumn("fragment_count", F.when(has_files, F.col("n_unpacked")))
        .withColumn("segment_original_filename", F.when(is_child, F.col(filename_col)))
        .drop("error_class", "error_message", "entry_kind")
    )


def parents(unpacked: DataFrame) -> DataFrame:
    """One row per input with its totals, error and route (``original`` or ``failure``)."""
    entry_only = [*archive_tasks.ENTRY_COLUMNS, "segment_original_filename", "archive_mime_type", "n_unpacked"]
    return unpacked.filter(F.col("pos").isNull()).drop(*entry_only)


def children(unpacked: DataFrame, id_col: str = "file_id", filename_col: str = "filename") -> DataFrame:
    """One row per unpacked file, or chunk of one, named and described by its place in the archive."""
    name, archive_filename = F.col("name"), F.col("segment_original_filename")
    described = {
        "parent_id": F.col(id_col),
        id_col: F.sha2(F.concat_ws("/", F.col(id_col).cast("string"), F.col("pos").cast("string")), 256),
        filename_col: columns.entry_filename(name),
        "path": columns.segment_path(name),
        "absolute_path": columns.absolute_path(archive_filename, name),
        "segment_path": columns.segment_path(name),
        "fragment_index": F.col("pos"),
        "entry_name": name,
        "permissions": columns.permission_string(F.col("mode")),
        "last_modified_time": columns.time_string(F.col("mtime_s")),
        "creation_time": columns.time_string(F.col("mtime_s")),
    }
    if "data" in unpacked.columns:
        described["content"] = F.col("data")
    kept = [c for c in unpacked.columns if c not in described and c not in _NOT_FOR_CHILDREN]
    return unpacked.filter(F.col("pos").isNotNull()).select(*kept, *[value.alias(c) for c, value in described.items()])


_NOT_FOR_CHILDREN = (
    "pos", "name", "data", "mode", "mtime_s", "archive_mime_type", "n_unpacked", "unpack_bytes", "threshold_breached",
    "sub_errors", "error",
)


def lineage(child_rows: DataFrame, id_col: str = "file_id") -> DataFrame:
    """Which file came out of which archive."""
    return child_rows.select("parent_id", F.col(id_col).alias("child_id"), "fragment_index")


def audit(outcome: DataFrame, operator: str, id_col: str = "file_id") -> DataFrame:
    """What an operator did to each record, read off its outcome: a fork, a change of content or of attributes."""
    if operator == "unpack":
        forked = (F.col("route") == schema.ORIGINAL) & (F.col("fragment_count") > 0)
        change = F.when(forked, "fork").otherwise("attributes modified")
    elif operator == "extract":
        change = F.when(F.col("route") == schema.SUCCESS, "content modified").otherwise("attributes modified")
    else:
        change = F.lit("attributes modified")
    return outcome.select(F.col(id_col), F.lit(operator).alias("op"), change.alias("change"), "route")

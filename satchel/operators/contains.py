"""Does an archive hold a file of one of these types, and which type comes first?

Narrow: the stage that reads the archives tells types as it reads, stops at the first match and hands over that type, so
there is no join and no shuffle, and of each file before the match no more is read than its type takes, or all of a small
one in a zip.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satchel import schema
from satchel.functions import archive_tasks, columns, mime
from satchel.session import bound_batches
from satchel.sources import files


def search_set(spark: SparkSession, body: str | None = None, path: str | None = None) -> list[str]:
    """The types to look for, from a JSON array given inline or in a file; null and blank items are dropped."""
    if (body is None) == (path is None):
        raise ValueError("give exactly one of body and path")
    if body is None:
        body = files.one_file(spark, path)
    try:
        items = json.loads(body)
    except ValueError as exc:
        raise ValueError('the search set is no JSON array of strings') from exc
    if not isinstance(items, list) or not all(item is None or isinstance(item, str) for item in items):
        raise ValueError('the search set is no JSON array of strings')
    return list(dict.fromkeys(item for item in items if item is not None and item.strip(columns.TRIMMED)))


def contains_type(
    archives: DataFrame,
    types: Iterable[str],
    content: str = "content",
    *,
    recursive: bool = False,
    fail_on_sub_error: bool = False,
    non_archive_to_failure: bool = True,
) -> DataFrame:
    """Adds ``archive_mime``, ``found``, ``found_mime``, ``route`` and ``error``; drops the archive bytes.

    ``found`` is NULL, not false, where no search took place.
    """
    options = archive_tasks.SearchOptions(recursive, fail_on_sub_error, frozenset(types))
    bound_batches(archives.sparkSession)
    typed = archives.withColumn("archive_mime", mime.clean(mime.detect(content)))
    openable = mime.is_archive_type(F.col("archive_mime"))
    carried = [c for c in typed.columns if c not in (content, "found_mime")]
    staged = typed.select(*carried, openable.alias("_open"), F.when(openable, F.col(content)).alias("_content"))
    out_schema = T.StructType(staged.drop("_content").schema.fields)
    for name in archive_tasks.SEARCH_COLUMNS:
        out_schema = out_schema.add(name, T.StringType())
    searched = staged.mapInArrow(lambda batches: archive_tasks.search_batches(batches, options), out_schema)

    not_archive = ~F.col("_open") | F.col("_error_class").eqNullSafe(schema.NOT_AN_ARCHIVE)
    broken = ~not_archive & F.col("_error_class").isNotNull()
    error = (
        F.when(mime.is_unreadable_archive_type(F.col("archive_mime")), schema.error(schema.UNSUPPORTED, "not a supported archive"))
        .when(not_archive, schema.error(schema.NOT_AN_ARCHIVE, "not an archive or not a supported archive"))
        .when(broken, schema.error(F.col("_error_class"), F.col("_error_message")))
    )
    # with nothing to look for, what is wrong inside an archive does no harm
    failed = not_archive | (broken & F.lit(bool(options.types)))
    out = schema.with_computed(searched, error=F.when(failed, error))
    return (
        out.withColumn("found", F.when(F.col("error").isNull(), F.col("found_mime").isNotNull()))
        .withColumn("archive_mime", F.when(F.col("error").isNull(), F.col("archive_mime")))
        .withColumn(
            "route",
            F.when(F.col("error").isNull() | (not_archive & F.lit(not non_archive_to_failure)), schema.SUCCESS)
            .otherwise(schema.FAILURE),
        )
        .drop("_open", "_error_class", "_error_message")
    )

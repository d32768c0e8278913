"""MIME identification of whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satchel import schema
from satchel.functions import mime
from satchel.functions.magic import Rule


def identify(
    files: DataFrame, content: str = "content", *, clean_only: bool = True, rules: Sequence[Rule] | None = None
) -> DataFrame:
    """Adds ``mime_type``, ``mime_extension`` and the constant route ``success``.

    The extension belongs to the full type, so it is looked up before parameters are dropped.
    """
    full = F.col("_full_type")
    return (
        schema.with_computed(files, _full_type=mime.detect(content, rules))
        .withColumn("mime_type", mime.clean(full) if clean_only else full)
        .withColumn("mime_extension", mime.extension(full, rules))
        .withColumn("route", F.lit(schema.SUCCESS))
        .drop("_full_type")
    )

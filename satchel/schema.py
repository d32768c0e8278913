"""Routes, error codes and the columns operators add."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCESS = "success"
FAILURE = "failure"
ORIGINAL = "original"
NOT_FOUND = "not-found"

NOT_AN_ARCHIVE = "NOT_AN_ARCHIVE"
SIZE_BUDGET = "SIZE_BUDGET"
NOTHING_UNPACKED = "NOTHING_UNPACKED"
ENCRYPTED = "ENCRYPTED"
UNSUPPORTED = "UNSUPPORTED"
TEXT_LIMIT = "TEXT_LIMIT"
BLANK_KEY = "BLANK_KEY"
CORRUPT = "CORRUPT"
UNREADABLE = "UNREADABLE"

ERROR_TYPE = "struct<class:string,message:string>"


def error(code: str | Column, message: str | Column) -> Column:
    def as_column(value: str | Column) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    return F.struct(as_column(code).alias("class"), as_column(message).alias("message"))


def no_error() -> Column:
    return F.lit(None).cast(ERROR_TYPE)


def with_computed(df: DataFrame, **computed: Column) -> DataFrame:
    """Adds columns that are worked out once per row, whatever is filtered on them later.

    A filter on a plain computed column is pushed below it with the whole expression copied into it, so costly
    expressions would run twice and nested ones would grow the plan without end.  Nothing is pushed below a generator,
    hence the values come out of a one-row ``inline``.
    """
    kept = [F.col(c) for c in df.columns if c not in computed]
    row = F.struct(*[value.alias(name) for name, value in computed.items()])
    return df.select(*kept, F.inline(F.array(row)))

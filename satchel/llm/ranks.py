"""Gapless numbers and running sums over a whole table, without one task that sees all of it.

Rows are dealt out by range, numbered inside their partition, and the partitions' counts, one row per partition and
group, are summed up and joined back.  The rows are written between the two steps, so that a task that runs again can
not number them in another way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satchel.llm.scratch import keep

PART, AT = "_part", "_at"
ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row's number in the lower 33 bits


def laid_out(df: DataFrame, *order: str) -> DataFrame:
    """Sorted over all partitions; ``_part`` and ``_at`` say where each row lies."""
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return keep(
        spread.select(
            "*",
            F.spark_partition_id().alias(PART),
            F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)).alias(AT),
        ),
        "laid-out",
    )


def before(*group: str):
    """The window of all earlier partitions of a group, on a table of one row per partition and group."""
    return Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def numbered(df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = ()) -> DataFrame:
    """``name``: how many rows of the same group come before this one.  Group columns hold no nulls."""
    laid = laid_out(df, *group, *order)
    counts = laid.groupBy(PART, *group).agg(F.min(AT).alias("_first"), F.count("*").alias("_n"))
    shift = F.coalesce(F.sum("_n").over(before(*group)), F.lit(0)) - F.col("_first")
    shifts = counts.select(PART, *group, shift.alias("_shift"))
    return laid.join(shifts, [PART, *group]).withColumn(name, F.col(AT) + F.col("_shift")).drop(PART, AT, "_shift")


def running(df: DataFrame, order: Sequence[str], group: Sequence[str], weight: Column, name: str) -> DataFrame:
    """``name``: the sum of ``weight`` over the rows of the same group that come before this one."""
    laid = laid_out(df.withColumn("_w", weight), *group, *order)
    sums = laid.groupBy(PART, *group).agg(F.sum("_w").alias("_sum"))
    base = sums.select(PART, *group, F.coalesce(F.sum("_sum").over(before(*group)), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(PART, *group).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    local = laid.withColumn("_local", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    joined = local.join(base, [PART, *group])
    return joined.withColumn(name, F.col("_local") + F.col("_base")).drop(PART, AT, "_w", "_local", "_base")

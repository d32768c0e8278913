"""Removing keys from a key/value table, with an outcome for every request.

A hot key must not end up as one big group in one task: requests are reduced to one winner per key by a partial
aggregate, and the winners find their requests again by the request id, which is unique and hence spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satchel import schema
from satchel.functions import columns
from satchel.session import shared_folder


def with_key(requests: DataFrame, key: str | Column) -> DataFrame:
    """Adds ``key`` from a SQL expression or column over each record."""
    return requests.withColumn("key", (F.expr(key) if isinstance(key, str) else key).cast("string"))


def route_deletes(requests: DataFrame, store: DataFrame, id_col: str = "request_id") -> DataFrame:
    """Adds ``route``, ``error`` and ``penalized``: the first request for a stored key removes it, later ones miss it.

    Requests count as made in the order of ``id_col``, which must be unique.
    """
    usable = requests.filter(~columns.is_blank(F.col("key")))
    winners = (
        usable.groupBy("key").agg(F.min(id_col).alias(id_col))
        .join(store.select("key"), "key", "left_semi")
        .select(id_col, F.lit(True).alias("_removed"))
    )
    blank = columns.is_blank(F.col("key"))
    return (
        requests.join(winners, id_col, "left")
        .withColumn("error", F.when(blank, schema.error(schema.BLANK_KEY, "no or blank key given")))
        .withColumn("route", F.when(blank, schema.FAILURE).when(F.col("_removed"), schema.SUCCESS).otherwise(schema.NOT_FOUND))
        .withColumn("penalized", F.col("route") == schema.FAILURE)
        .drop("_removed")
    )


def survivors(store: DataFrame, requests: DataFrame) -> DataFrame:
    """What is left of the store after all requests."""
    return store.join(requests.select("key").filter(~columns.is_blank(F.col("key"))).distinct(), "key", "left_anti")


def replay(
    log: DataFrame, key: str, ts: str, id_col: str, op: str, put: str, remove: str, store: DataFrame | None = None
) -> DataFrame:
    """The outcome of every remove in a log of puts and removes: ``id_col`` and ``route``.

    A remove succeeds when the operation before it on the same key was a put; keys of ``store`` (``key``) are there before
    the log begins.  The log is dealt out by ranges of key, time and id, so a key with a third of all operations lies in as
    many partitions as its share; the operation before is looked up inside a partition, and only a key's first one in it
    needs the last one of the key's partition before, carried over from one summary row per key and partition.  The
    dealt log is written to the shared folder first: ranges that were drawn anew could differ.

    Removes without a key fail and take no part in that.
    """
    spark, blank = log.sparkSession, columns.is_blank(F.col(key).cast("string"))
    failed = log.filter(blank & (F.col(op) == remove)).select(id_col, F.lit(schema.FAILURE).alias("route"))
    ops = log.filter(~blank & F.col(op).isin(put, remove)).select(
        F.col(key).alias("_key"), F.lit(False).alias("_begun"), F.col(ts).alias("_ts"), F.col(id_col), (F.col(op) == put).alias("_put")
    )
    if store is not None:
        kinds = {f.name: f.dataType for f in ops.schema.fields}
        kept = store.filter(~columns.is_blank(F.col("key").cast("string"))).select(F.col("key").cast(kinds["_key"]).alias("_key")).distinct()
        ops = ops.withColumn("_begun", F.lit(True)).unionByName(kept.select(
            "_key", F.lit(False).alias("_begun"), F.lit(None).cast(kinds["_ts"]).alias("_ts"),
            F.lit(None).cast(kinds[id_col]).alias(id_col), F.lit(True).alias("_put"),
        ))
    order = ["_key", "_begun", "_ts", id_col]
    folder = shared_folder(spark, "replay")
    ops.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).write.parquet(folder)
    dealt = spark.read.parquet(folder)
    by_part = Window.partitionBy("_key", "_part").orderBy(*order[1:])
    # both users of this shuffle the log alike, so it is exchanged once
    placed = dealt.withColumn("_before", F.lag("_put").over(by_part)).withColumn("_after", F.lead("_put").over(by_part))
    carried = placed.filter(F.col("_after").isNull()).select(
        "_key", "_part", F.lag("_put").over(Window.partitionBy("_key").orderBy("_part")).alias("_carried")
    )
    before = F.coalesce(F.col("_before"), F.col("_carried"), F.lit(False))
    answered = (
        placed.join(carried, ["_key", "_part"], "left")
        .filter(~F.col("_put"))
        .select(id_col, F.when(before, schema.SUCCESS).otherwise(schema.NOT_FOUND).alias("route"))
    )
    return answered.unionByName(failed)

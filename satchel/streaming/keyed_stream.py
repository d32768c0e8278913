"""Keyed removal on an unbounded log, and routed sinks for streams."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from satchel import schema
from satchel.functions import columns


class KeyStore(StatefulProcessor):
    """Holds for one key whether it is stored; answers each remove with the route it takes.

    Puts and removes of a key are taken in the order of time and id within a micro-batch; between micro-batches the log
    has to arrive in order.  A task holds the operations of one key and micro-batch, three small columns, so the source's
    limit per trigger bounds its memory however hot a key is.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._stored = handle.getValueState("stored", "stored boolean")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._stored.update((True,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        log = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "id"])
        before = log["is_put"].shift()
        stored = self._stored.get()[0] if self._stored.exists() else False
        before.iloc[0] = stored
        removes = ~log["is_put"].to_numpy(dtype=bool)
        found = before.to_numpy(dtype=bool)[removes]
        self._stored.update((bool(log["is_put"].iloc[-1]),))
        yield pd.DataFrame({"id": log["id"].to_numpy()[removes], "found": found})

    def close(self) -> None:
        pass


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def replay_stream(
    log: DataFrame, key: str, ts: str, id_col: str, op: str, put: str, remove: str, store: DataFrame | None = None
) -> DataFrame:
    """The outcome of every remove of a streaming log: ``id_col`` and ``route``; without a key it fails.

    Keys of ``store`` (a table with ``key``) are there before the log begins: they are the state that the query's first
    micro-batch starts from.  The session needs the RocksDB state store, see ``satchel.session``.
    """
    blank = columns.is_blank(F.col(key).cast("string"))
    failed = log.filter(blank & (F.col(op) == remove))
    ops = log.filter(~blank & F.col(op).isin(put, remove)).select(
        F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(id_col).alias("id"), (F.col(op) == put).alias("is_put")
    )
    begun = None
    if store is not None:
        kept = store.filter(~columns.is_blank(F.col("key").cast("string")))
        begun = kept.select(F.col("key").cast(ops.schema["key"].dataType).alias("key")).distinct().groupBy("key")
    answer = f"id {log.schema[id_col].dataType.simpleString()}, found boolean"
    answered = ops.groupBy("key").transformWithStateInPandas(KeyStore(), answer, "Append", "None", initialState=begun)
    routed = answered.select(F.col("id").alias(id_col), F.when(F.col("found"), schema.SUCCESS).otherwise(schema.NOT_FOUND).alias("route"))
    return routed.unionByName(failed.select(id_col, F.lit(schema.FAILURE).alias("route")))


def checkpoint_location(spark: SparkSession, name: str, location: str | None = None) -> str:
    """A query's checkpoint: as given, else below the folder all nodes share."""
    if location is not None:
        return location
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("give a checkpoint location or set spark.checkpoint.dir")
    return f"{shared.rstrip('/')}/{name}"


def write_routes_stream(
    outcome: DataFrame, path: str, name: str, checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Every route into its own directory, one pass per micro-batch.

    The query ends when it has taken what there is, or runs on with a micro-batch ``every`` so often.

    A micro-batch that is run again after a failure overwrites its own directory, so each row is written once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={batch_id}")

    writer = outcome.writeStream.queryName(name).foreachBatch(write)
    location = checkpoint_location(outcome.sparkSession, name, checkpoint)
    return writer.option("checkpointLocation", location).trigger(**({"processingTime": every} if every else {"availableNow": True})).start()

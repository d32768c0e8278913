"""Tables that cut lineage, in the folder the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="satchel-shared-")


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; an own folder only on one machine with nothing set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own_folder()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/satchel-{uuid.uuid4().hex}/{label}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: computed one time, and safe against lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

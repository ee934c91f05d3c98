"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows that dealt() gives a task, about.
DEALT = 100_000


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path under spark.checkpoint.dir; on one machine, a temporary folder where the session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="traitloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def keep(df: DataFrame, tag: str) -> DataFrame:
    """df written to the shared folder and read back: computed once, with no lineage that a lost executor could break."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str, rows: int = DEALT) -> DataFrame:
    """df, which is counted and so should have been written, dealt out by keys into as many tasks as it has `rows`. Windows over the
    keys then sort no more in a task however large df is, and the number of tasks is not coalesced."""
    return df.repartition(max(1, -(-df.count() // rows)), *keys)

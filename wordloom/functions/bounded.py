"""Tables that go to the driver or to every task: only below a stated size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir (a local one only in local mode); checkpoints go there too."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        where = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not where:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="wordloom-")
        context.setCheckpointDir(where)
    return context._jsc.sc().getCheckpointDir().get()


def settled(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The same as Parquet, which takes a fraction of a checkpoint's room."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_bounded(df: DataFrame, most: int) -> list[Row]:
    """All rows of df; an error if there are more than ``most``."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows: give a larger bound or use the joined form")
    return rows

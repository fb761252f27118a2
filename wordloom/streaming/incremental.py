"""Incremental counts: new files are counted once, and old counts only grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wordloom.functions.keys import words


def merged(old: DataFrame, new: DataFrame, key: str = "word") -> DataFrame:
    return old.select(key, "n").unionByName(new.select(key, "n")).groupBy(key).agg(F.sum("n").alias("n"))


def added_only(old: DataFrame, new: DataFrame, key: str = "word") -> DataFrame:
    """Old counts as they are, and new words."""
    return old.unionByName(new.join(old.select(key), key, "left_anti").select(*old.columns))


def count_words(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str):
    """A query over the files of source that writes each batch's word counts to target/batch=N: a batch that is done
    again overwrites itself, so counts are exact after any failure.  Read them with total()."""

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy("word").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source).select(F.explode(words(F.col("text"))).alias("word"))
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def total(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).groupBy("word").agg(F.sum("n").alias("n"))


def windowed_counts(events: DataFrame, time: str = "ts", size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """window start, event_type, n, with a watermark when events is a stream."""
    out = events.withWatermark(time, late).groupBy(F.window(time, size), "event_type").agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n")

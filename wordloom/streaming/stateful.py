"""Streams that remember: what came first stays, whatever comes later, over any number of restarts.

The state is the result itself: a batch asks which of its keys earlier batches have written, and writes the others to ``target/batch=<number>``.  A batch that is
done again after a failure reads only batches before it and overwrites its own, so results are exact without a state store.  All work
stays in the JVM: a batch's rows of a key are reduced by an aggregate before they are moved, and as long as a batch has at most ``SENT`` keys, they go to
where the known keys lie, so the result is scanned but not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.operators.fragments import first_of_equal

SENT = 1_000_000


def files(spark: SparkSession, path: str, schema: T.StructType, most: int | None = None) -> DataFrame:
    """A stream of the Parquet files that come under path; ``most`` files make a batch, oldest first."""
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    return (r.option("maxFilesPerTrigger", most) if most else r).parquet(path)


def known(spark: SparkSession, target: str, number: int, schema: T.StructType) -> DataFrame:
    """What the batches before ``number`` have written."""
    where = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    # the parts of a batch that failed may lie there: they are this batch's, or later
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).option("basePath", target).parquet(target).where(F.col("batch") < number).drop("batch")


def _new_ones(stream: DataFrame, reduce: Callable[[DataFrame], DataFrame], key: str, target: str, checkpoint: str, sent: int) -> None:
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        found = reduce(batch.where(F.col(key).isNotNull())).persist()  # asked twice; computed anew if an executor is lost
        try:
            old, keys = known(spark, target, number, found.schema).select(key), found.select(key)
            old = old.join(F.broadcast(keys) if keys.count() <= sent else keys, key, "left_semi")
            found.join(old, key, "left_anti").write.mode("overwrite").parquet(f"{target}/batch={number}")
        finally:
            found.unpersist()

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def first_wins(stream: DataFrame, key: str, order: list[str], target: str, checkpoint: str, sent: int = SENT) -> None:
    """Take in what is there: the first row of each key (of the first batch that has it, the least by ``order``) goes to target.

    Rows without a key go.  Call again for what has come since, or after a failure.
    """
    columns = stream.columns
    _new_ones(stream, lambda rows: first_of_equal(rows, key, [F.col(c) for c in order]).select(*columns), key, target, checkpoint, sent)


def added_once(stream: DataFrame, key: str, target: str, checkpoint: str, sent: int = SENT) -> None:
    """Take in what is there: key, n of the keys that no earlier batch had; known keys keep their counts."""
    _new_ones(stream.select(key), lambda rows: rows.groupBy(key).agg(F.count("*").alias("n")), key, target, checkpoint, sent)


def result(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("batch")

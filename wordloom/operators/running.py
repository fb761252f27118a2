"""Running totals over an order, without a task that holds a whole group.

Rows are range-partitioned by group and order, so a large group lies in many partitions.  Each partition adds up its own rows in order; its
groups' totals become offsets for the partitions after it.  A partition's end cuts at most one group, so there are fewer offsets
than partitions, and they are broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.functions.bounded import settled


def running_total(df: DataFrame, by: list[str], order: list[str], value: Column, name: str = "total", parts: int | None = None) -> DataFrame:
    """df with ``name`` (long): the sum of value over the rows of its group up to it; nulls count as 0, groups may be null.

    Rows of a group that are equal in ``order`` are added one after the other, in no fixed order.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = [F.col(c) for c in by]
    keyed = df.withColumns({"__value": F.coalesce(value.cast("long"), F.lit(0)), "__group": F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(by)]))})
    spread = keyed.repartitionByRange(parts, "__group", *order).sortWithinPartitions("__group", *order).withColumn("__part", F.spark_partition_id())
    spread = settled(spread)  # partitions and their order stay as they are
    schema = T.StructType([f for f in spread.schema.fields if f.name != "__value"] + [T.StructField(name, T.LongType())])

    def run(batches):
        last, carry = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            k, v = batch.column(batch.schema.get_field_index("__group")).to_pylist(), np.asarray(batch.column(batch.schema.get_field_index("__value")))
            begins = np.array([a != b for a, b in zip([last, *k], k)])
            total = np.cumsum(v)
            base = np.where(begins, total - v, 0)
            first = np.maximum.accumulate(np.where(begins, np.arange(len(v)), -1))
            total = total - np.where(first >= 0, base[first], 0) + np.where(first < 0, carry, 0)
            last, carry = k[-1], int(total[-1])
            kept = [c for c in batch.schema.names if c != "__value"]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(total, pa.int64())], names=[*kept, name])

    own = spread.mapInArrow(run, schema)
    totals = spread.groupBy("__group", "__part").agg(F.sum("__value").alias("s"))
    cut = totals.groupBy("__group").agg(F.count("*").alias("n")).where("n > 1").drop("n")  # fewer than partitions
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.join(F.broadcast(cut), "__group").withColumn("__before", F.sum("s").over(before)).where("__before IS NOT NULL").select("__group", "__part", "__before")
    out = own.join(F.broadcast(offsets), ["__group", "__part"], "left")
    return out.select(*[F.col(c) for c in df.columns], (F.col(name) + F.coalesce("__before", F.lit(0))).alias(name))


def until(df: DataFrame, budget: int, by: list[str], order: str, value: Column, groups: int = 100_000) -> DataFrame:
    """The rows of each group, in the order, up to and without the first that takes the sum of value (not negative) over the budget.

    Only group, order and value are moved; the last place of each group within the budget then decides, sent to where the rows
    are if there are at most ``groups`` of them.  Places are distinct in a group.
    """
    narrow = df.select(*by, order, F.greatest(F.coalesce(value.cast("long"), F.lit(0)), F.lit(0)).alias("_v"))
    ends = settled(running_total(narrow, by, [order], F.col("_v"), "_sum").where(F.col("_sum") <= budget).groupBy(*by).agg(F.max(order).alias("_end")))
    if ends.limit(groups + 1).count() <= groups:
        ends = F.broadcast(ends)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    return df.alias("a").join(ends.alias("b"), [*same, F.col(f"a.{order}") <= F.col("b._end")], "left_semi")


def inside(df: DataFrame, by: list[str], order: str, begins: Column, ends: Column) -> DataFrame:
    """The rows between one that begins and one that ends a block (one deep), without the former."""
    step = F.coalesce(begins, F.lit(False)).cast("int") - F.coalesce(ends, F.lit(False)).cast("int")
    return running_total(df, by, [order], step, "_depth").where((F.col("_depth") == 1) & ~F.coalesce(begins, F.lit(False))).drop("_depth")

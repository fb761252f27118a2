"""Order of single characters within a reading."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def main_readings(rows: DataFrame, lead: int = 100) -> DataFrame:
    """Rows (char, reading, weight) of each character's main reading: its top one, ``lead`` ahead of the next or alone."""
    w = Window.partitionBy("char").orderBy(F.desc("weight"), F.desc("reading"))
    df = rows.withColumn("_k", F.row_number().over(w)).withColumn("_next", F.lead("weight").over(w))
    return df.where((F.col("_k") == 1) & (F.col("_next").isNull() | (F.col("_next") <= F.col("weight") - lead))).drop("_k", "_next")


def redistributed(rows: DataFrame, use: DataFrame, lead: int = 100) -> DataFrame:
    """(reading, char, weight): among a reading's movers, the k-th largest weight goes to the k-th most used character.

    rows carries ord; ties in use go by present weight, then ord.  A reading with one mover stays.
    """
    movers = main_readings(rows, lead).join(use, "char").withColumn("m", F.count("*").over(Window.partitionBy("reading"))).where("m >= 2")
    by_use = Window.partitionBy("reading").orderBy(F.desc("rate"), F.desc("weight"), "ord")
    by_weight = Window.partitionBy("reading").orderBy(F.desc("weight"), "ord")
    place = movers.select("reading", "char", F.row_number().over(by_use).alias("k"))
    value = movers.select("reading", F.row_number().over(by_weight).alias("k"), F.col("weight").alias("moved"))
    new = place.join(value, ["reading", "k"]).select("reading", "char", "moved")
    return rows.join(new, ["reading", "char"], "left").select("reading", "char", F.coalesce("moved", "weight").alias("weight"), "ord")


def _settled(rows: DataFrame, asked: DataFrame, settle: Callable[[dict, list[dict]], dict], value: str, kind: T.DataType) -> DataFrame:
    """rows (reading, char, value) with each reading that is asked about settled by itself, in one row of its few characters; the others stay as they are."""
    have = rows.groupBy("reading").agg(F.collect_list(F.struct("char", value)).alias("have"))
    want = asked.groupBy("reading").agg(F.sort_array(F.collect_list(F.struct(*[c for c in asked.columns if c != "reading"]))).alias("want"))

    def run(batches):
        for batch in batches:
            out = []
            for reading, have, want in zip(*(batch.column(k).to_pylist() for k in range(3))):
                out += [(reading, c, v) for c, v in settle({x["char"]: x[value] for x in have}, want).items()]
            yield pa.record_batch([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], to_arrow_type(kind))], names=["reading", "char", value])

    schema = T.StructType([T.StructField("reading", T.StringType()), T.StructField("char", T.StringType()), T.StructField(value, kind)])
    moved = have.join(want, "reading").select("reading", "have", "want").mapInArrow(run, schema)
    return moved.unionByName(rows.join(want.select("reading"), "reading", "left_anti").select("reading", "char", F.col(value).cast(kind)))


def lifted(rows: DataFrame, samples: DataFrame, rounds: int = 100) -> DataFrame:
    """Estimates (reading, char, rate) raised until each sample (reading, char, max_rank) holds: a sample out of its rank goes just above
    the lowest of those within it.  A reading's characters are few, so each reading is settled by itself."""

    def settle(rate: dict[str, float], wanted: list[dict]) -> dict[str, float]:
        for _ in range(rounds):
            moved = False
            for w in wanted:
                c, most = w["char"], w["max_rank"]
                order = sorted(rate, key=lambda x: (-rate[x], x))
                if c in rate and order.index(c) >= most:
                    rate[c] = rate[order[int(most) - 1]] * (1 + 1e-9) + 1e-12
                    moved = True
            if not moved:
                break
        return rate

    return _settled(rows.select("reading", "char", "rate"), samples.select("reading", "char", "max_rank"), settle, "rate", T.DoubleType())


def led(rows: DataFrame, forms: DataFrame) -> DataFrame:
    """(reading, char, weight) with the forms that share a character (reading, char, leader, estimate) in order of estimate behind their leader.

    The leader takes the group's top weight; every other form is put below it where its estimate belongs
    and weighs halfway between its new neighbours.
    """

    def settle(weight: dict[str, int], forms: list[dict]) -> dict[str, int]:
        for leader in sorted({f["leader"] for f in forms}):
            estimate = {f["char"]: f["estimate"] for f in forms if f["leader"] == leader and f["char"] in weight}
            if leader not in weight or len(estimate) < 2:
                continue
            weight[leader] = max(weight[c] for c in estimate)
            above = leader
            for c in sorted((c for c in estimate if c != leader), key=lambda c: (-float(estimate[c]), c)):
                lower = [w for x, w in weight.items() if w < weight[above] and x not in estimate]
                if weight[c] >= weight[above]:
                    weight[c] = round((weight[above] + (max(lower) if lower else 0)) / 2)
                above = c
        return weight

    return _settled(rows.select("reading", "char", F.col("weight").cast("long").alias("weight")), forms.select("reading", "leader", "char", "estimate"), settle, "weight", T.LongType())


def raised_over(rows: DataFrame, order: DataFrame) -> DataFrame:
    """(reading, char, weight) with each audited pair (reading, char, other, margin) in order: char at least margin above other."""
    least = order.join(rows.select("reading", F.col("char").alias("other"), F.col("weight").alias("_w")), ["reading", "other"]).groupBy("reading", "char").agg(F.max(F.col("_w") + F.col("margin")).alias("_least"))
    return rows.join(least, ["reading", "char"], "left").withColumn("weight", F.greatest("weight", "_least")).drop("_least")

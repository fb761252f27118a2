"""Corpus preparation: fragments of bounded length, first of equal ones, budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.keys import UnitProfile, repetitive, trimmed


def chunks(docs: DataFrame, profile: UnitProfile, keep: list[str], text: str = "text") -> DataFrame:
    """keep, sentence, run, part, chunk: runs of units within sentences, in overlapping pieces; repetitive ones go."""
    p = profile
    df = docs.select(*keep, F.posexplode(F.split(text, p.sentence_split)).alias("sentence", "s"))
    df = df.select(*keep, "sentence", F.posexplode(F.regexp_extract_all(trimmed(F.col("s")), F.lit(f"({p.run})"), F.lit(1))).alias("run", "r"))
    df = df.where(F.length("r") >= p.min_units)
    step = max(1, p.max_units - p.overlap)
    last = F.when(F.length("r") <= p.max_units, 0).otherwise(F.length("r") - p.min_units)
    df = df.select(*keep, "sentence", "run", "r", F.posexplode(F.sequence(F.lit(0), last, F.lit(step))).alias("part", "at"))
    df = df.select(*keep, "sentence", "run", "part", F.substring("r", F.col("at") + 1, F.lit(p.max_units)).alias("chunk"))
    return df.where(~repetitive(F.col("chunk")))


def first_of_equal(rows: DataFrame, text: str, order: list) -> DataFrame:
    """The first row of each text, with the number of rows it stands for.

    An aggregate, not a window: a text that a third of all rows share is reduced before the shuffle.
    """
    others = [c for c in rows.columns if c != text]
    return rows.groupBy(text).agg(F.min(F.struct(*order, *[F.col(c).alias(f"_{c}") for c in others])).alias("_m"), F.count("*").alias("copies")).select(text, *[F.col(f"_m._{c}").alias(c) for c in others], "copies")


def first_rows(rows: DataFrame, n: int, by: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def runs(docs: DataFrame, profile: UnitProfile, keep: list[str], text: str = "text") -> DataFrame:
    """keep, sentence, run, r, mixed, long: the runs of units that chunks() cuts; mixed ones are saved from a sentence that holds other things too, long ones are cut."""
    p = profile
    df = docs.select(*keep, F.posexplode(F.split(text, p.sentence_split)).alias("sentence", "s")).withColumn("s", trimmed(F.col("s")))
    df = df.select(*keep, "sentence", "s", F.posexplode(F.regexp_extract_all(F.col("s"), F.lit(f"({p.run})"), F.lit(1))).alias("run", "r")).where(F.length("r") >= p.min_units)
    return df.select(*keep, "sentence", "run", "r", (F.col("r") != F.col("s")).alias("mixed"), (F.length("r") > p.max_units).alias("long"))


def stream_counters(docs: DataFrame, profile: UnitProfile, text: str = "text") -> DataFrame:
    """One row: runs, salvaged_mixed_fragments and split_long_runs of a sentence corpus, and the units in them."""
    r = runs(docs, profile, [], text)
    number = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    return r.agg(F.count("*").alias("runs"), number("mixed").alias("salvaged_mixed_fragments"), number("long").alias("split_long_runs"), F.coalesce(F.sum(F.length("r").cast("long")), F.lit(0)).alias("units"))

"""Rescoring of lexicons by outside signals.

Which stages there are is known from the counters that such builds report; the weights are this library's own [design].
All are joins and column expressions; a signal that is missing changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def burst(views: DataFrame, ratio: float = 4.0, least_days: int = 3) -> DataFrame:
    """text, days, persistence, burst of views (text, day, n): on how many days a title was seen, the share of its views off its best day, and
    whether its best day has ``ratio`` times the mean of the others."""
    out = views.groupBy("text").agg(F.count_distinct("day").alias("days"), F.sum("n").alias("total"), F.max("n").alias("top"))
    others = (F.col("total") - F.col("top")) / F.greatest(F.lit(1), F.col("days") - 1)
    return out.select("text", "days", F.round(1 - F.col("top") / F.col("total"), 6).alias("persistence"), ((F.col("days") >= least_days) & (F.col("top") > ratio * others)).alias("burst"))


def rescored(lexicon: DataFrame, signals: DataFrame, step: int = 10, most: int = 60) -> DataFrame:
    """lexicon (reading, text, weight) raised by ``step`` for each power of two of hits (text, hits), by ``most`` at most."""
    s = signals.groupBy("text").agg(F.max("hits").alias("_hits"))
    up = F.least(F.lit(most), (step * F.floor(F.log2(F.lit(1) + F.col("_hits")))).cast("int"))
    return lexicon.join(s, "text", "left").select("reading", "text", (F.col("weight") + F.coalesce(up, F.lit(0))).cast("long").alias("weight"))


def damped_homophones(lexicon: DataFrame, keep: int = 3, percent: int = 80) -> DataFrame:
    """Entries beyond the first ``keep`` of a reading weigh ``percent`` of what they did, but at least 1."""
    w = Window.partitionBy("reading").orderBy(F.desc("weight"), "text")
    low = F.greatest(F.lit(1), F.floor(F.col("weight") * percent / 100))
    return lexicon.select("reading", "text", F.when(F.row_number().over(w) > keep, low).otherwise(F.col("weight")).cast("long").alias("weight"))


def damped_readings(lexicon: DataFrame, percent: int = 50) -> DataFrame:
    """Readings of a text other than its weightiest (first by name among equals) weigh ``percent``."""
    w = Window.partitionBy("text").orderBy(F.desc("weight"), "reading")
    return lexicon.select("reading", "text", F.when(F.row_number().over(w) > 1, F.floor(F.col("weight") * percent / 100)).otherwise(F.col("weight")).cast("long").alias("weight"))


def pruned_tail(lexicon: DataFrame, least: int, protected: DataFrame, most_units: int = 2) -> DataFrame:
    """Without entries of more than ``most_units`` units below a weight, unless their text is protected."""
    p = protected.select("text").distinct().withColumn("_kept", F.lit(True))
    return lexicon.join(p, "text", "left").where((F.length("text") <= most_units) | (F.col("weight") >= least) | F.col("_kept").isNotNull()).drop("_kept").select("reading", "text", "weight")


def capped_extensions(lexicon: DataFrame, units: int = 3) -> DataFrame:
    """An entry that extends another text by up to ``units`` units weighs at most one less than it (the prefix keeps its place)."""
    base = lexicon.groupBy("text").agg(F.max("weight").alias("_w"))
    cut = F.explode(F.transform(F.sequence(F.greatest(F.lit(1), F.length("text") - units), F.length("text") - 1), lambda k: F.substring("text", F.lit(1), k))).alias("_prefix")
    longer = lexicon.where(F.length("text") > 1).select("reading", "text", cut)
    limit = longer.join(base.withColumnRenamed("text", "_prefix"), "_prefix").groupBy("reading", "text").agg((F.min("_w") - 1).alias("_limit"))
    return lexicon.join(limit, ["reading", "text"], "left").select("reading", "text", F.greatest(F.lit(0), F.least("weight", F.coalesce("_limit", "weight"))).cast("long").alias("weight"))


def titles(df: DataFrame, title: Column, shape: str, barred: tuple[str, ...] = ()) -> DataFrame:
    """Rows with the first reason to leave a title out: namespace, bracketed, list, shape, or none (empty)."""
    why = F.when(title.contains(":"), "namespace").when(title.rlike(r"[()]"), "bracketed")
    for b in barred:
        why = why.when(title.startswith(b), "list")
    return df.withColumn("reason", why.when(~title.rlike(shape), "shape").otherwise(""))


def place_aliases(places: DataFrame, ends: tuple[str, ...]) -> DataFrame:
    """text, alias of places (text): a name without the end that tells its kind, where two units or more are left."""
    alias = F.regexp_replace("text", f"({'|'.join(ends)})$", "")
    return places.select("text", alias.alias("alias")).where((F.col("alias") != F.col("text")) & (F.length("alias") >= 2)).distinct()


def suspicious(lexicon: DataFrame, known: DataFrame, high: int = 200) -> DataFrame:
    """Entries to look at, with a reason: weighty but in no other source, or a single unit more than a weightier entry of the same reading."""
    k = known.select("text").distinct().withColumn("_known", F.lit(True))
    top = F.first("text").over(Window.partitionBy("reading").orderBy(F.desc("weight"), "text"))
    rows = lexicon.withColumn("_top", top).join(k, "text", "left")
    why = F.when((F.col("weight") >= high) & F.col("_known").isNull(), "unsupported").when((F.col("text") != F.col("_top")) & F.col("text").startswith(F.col("_top")), "extends_top")
    return rows.select("reading", "text", "weight", why.alias("reason")).where("reason IS NOT NULL")

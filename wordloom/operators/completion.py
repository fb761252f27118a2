"""Prefix lookups of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefix_top(lexicon: DataFrame, k: int = 6, least: int = 1, most: int = 12, specialist: DataFrame | None = None, bound: str | None = None) -> DataFrame:
    """prefix, reading, text, weight, rank: the best k entries whose reading starts with each proper prefix.

    Texts of ``specialist`` take no place.  ``bound`` is a final syllable that only belongs to what is before it (as r does): an
    entry that is another entry with it at the end of its reading and one unit more takes no place either.
    """
    if specialist is not None:
        lexicon = lexicon.join(specialist.select("text").distinct(), "text", "left_anti")
    if bound:
        base = lexicon.select(F.concat("reading", F.lit(bound)).alias("reading"), F.col("text").alias("_base")).distinct()
        tail = lexicon.where(F.col("reading").endswith(bound)).join(base, "reading").where(F.expr("substring(text, 1, length(text) - 1) = _base"))
        lexicon = lexicon.join(tail.select("reading", "text").distinct(), ["reading", "text"], "left_anti")
    cut = F.sequence(F.lit(least), F.least(F.length("reading") - 1, F.lit(most)))
    df = lexicon.where(F.length("reading") > least).withColumn("prefix", F.explode(F.transform(cut, lambda i: F.substring("reading", F.lit(1), i))))
    w = Window.partitionBy("prefix").orderBy(F.desc("weight"), "reading", "text")
    return df.select("prefix", "reading", "text", "weight", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)


def syllable_prefix_top(lexicon: DataFrame, k: int = 6) -> DataFrame:
    """The same at syllable marks: prefixes are whole syllables."""
    df = lexicon.withColumn("s", F.split("reading", "'")).where(F.size("s") > 1)
    df = df.withColumn("prefix", F.explode(F.transform(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.concat_ws("", F.slice("s", F.lit(1), i)))))
    w = Window.partitionBy("prefix").orderBy(F.desc("weight"), "reading", "text")
    return df.select("prefix", "reading", "text", "weight", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)


def transition_completion(pairs: DataFrame, lexicon: DataFrame, least_sources: int = 5, k: int = 6) -> DataFrame:
    """prefix, reading, text, path, evidence: pairs (left, right, left_reading, right_reading, evidence, sources) offered
    once the left word and part of the right one are typed; pairs that are lexicon texts or whose full reading is an entry's go."""
    p = pairs.where(F.col("sources") >= least_sources).withColumn("reading", F.concat("left_reading", "right_reading")).withColumn("text", F.concat("left", "right"))
    p = revalidated(p, lexicon)
    p = p.where(F.length("right_reading") > 1).withColumn("prefix", F.explode(F.transform(F.sequence(F.lit(1), F.length("right_reading") - 1), lambda i: F.concat("left_reading", F.substring("right_reading", F.lit(1), i)))))
    w = Window.partitionBy("prefix").orderBy(F.desc("evidence"), "text", "left")
    p = p.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return p.select("prefix", "reading", "text", F.concat_ws("|", "left", "right").alias("path"), "evidence", "rank")


def revalidated(pairs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Pairs whose words have those readings in the lexicon, and whose whole is not an entry itself."""
    known = lexicon.select("reading", "text")  # equal rows don't matter to these joins
    out = pairs.join(known, ["reading", "text"], "left_anti")
    for side in ("left", "right"):
        k = known.select(F.col("reading").alias(f"{side}_reading"), F.col("text").alias(side))
        out = out.join(k, [f"{side}_reading", side], "left_semi")
    return out

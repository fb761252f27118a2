"""Curated rows: modes, overrides, exclusions, restores.  Every operator gives the same result when applied again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("exact_zero", "exact_rank", "no_contains", "exact_rank_no_contains", "exact_rank_exact_only")
FORCE_ZERO, KEEP_OR_ONE = -2.0, -1.99


def curated(rows: DataFrame) -> DataFrame:
    """Curated rows (sc, tc, score, reading, mode) with the weight they force, scope, and flags."""
    mode = F.coalesce("mode", F.lit(""))
    rank = mode.startswith("exact_rank")
    return rows.select(
        "sc", "tc", "reading", F.col("score"), mode.alias("mode"),
        F.when(mode == "exact_zero", 0).when(rank, F.bround(F.col("score") * 1000)).cast("int").alias("forced"),
        F.when(mode.endswith("no_contains"), "no_contains").alias("scope"),
        (rank | (mode == "exact_zero")).alias("post_rank"),
        (mode == "exact_rank_exact_only").alias("exact_only"),
    )


def force(lexicon: DataFrame, rows: DataFrame) -> DataFrame:
    """(reading, text, weight) with the rows' (reading, text, score) weights: a marker below zero keeps or zeroes, other scores override."""
    r = rows.groupBy("reading", "text").agg(F.max("score").alias("score"))
    new = F.when(F.col("score").isNull(), F.col("weight")).when(F.col("score") == FORCE_ZERO, 0).when(F.col("score") == KEEP_OR_ONE, F.coalesce("weight", F.lit(1))).otherwise(F.bround(F.col("score") * 1000))
    return lexicon.join(r, ["reading", "text"], "full").select("reading", "text", new.cast("int").alias("weight"))


def excluded(lexicon: DataFrame, terms: DataFrame) -> DataFrame:
    """The lexicon without the terms' texts, whatever their reading; single characters are never excluded."""
    return lexicon.join(terms.where(F.length("text") >= 2).select("text").distinct(), "text", "left_anti")


def restored(current: DataFrame, previous: DataFrame, terms: DataFrame) -> DataFrame:
    """Current, and the previous rows whose text is missing now and not excluded."""
    missing = previous.join(current.select("text").distinct(), "text", "left_anti")
    return current.unionByName(excluded(missing, terms).select(*current.columns))


def kept_single(new: DataFrame, old: DataFrame) -> DataFrame:
    """Single characters in both keep the old weight; all else is as in new."""
    o = old.where(F.length("text") == 1).select("reading", "text", F.col("weight").alias("_old"))
    return new.join(o, ["reading", "text"], "left").select("reading", "text", F.coalesce("_old", "weight").alias("weight"))


def checked(rows: DataFrame) -> DataFrame:
    """Specialist rows (sc, tc, usage, reading), failing the job on a bad one before anything is changed."""
    bad = F.when(~F.col("usage").between(0, 0.5), "usage").when(~F.col("reading").rlike("^[a-z]+(?:'[a-z]+)*$"), "reading").when((F.coalesce("sc", F.lit("")) == "") | (F.coalesce("tc", F.lit("")) == ""), "empty")
    return rows.where(F.when(bad.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad row: "), bad)).cast("boolean")))


def overridden(lexicon: DataFrame, overrides: DataFrame) -> DataFrame:
    """Readings replaced by word (text, reading): words move to the new reading; single characters gain it and keep their old ones."""
    o = overrides.select("text", F.col("reading").alias("_new")).distinct()
    hit = lexicon.join(o, "text", "left")
    moved = hit.select(F.coalesce("_new", "reading").alias("reading"), "text", "weight")
    kept = hit.where(F.col("_new").isNotNull() & (F.length("text") == 1)).select("reading", "text", "weight")
    return moved.unionByName(kept).groupBy("reading", "text").agg(F.max("weight").alias("weight"))


def aliased(lexicon: DataFrame, aliases: DataFrame, cap: int) -> DataFrame:
    """Additional readings (text, reading, from_reading): weight of the source reading, capped; never over an entry that is there."""
    src = lexicon.select("text", F.col("reading").alias("from_reading"), "weight").where("weight > 0")
    new = aliases.join(src, ["text", "from_reading"]).groupBy("reading", "text").agg(F.max(F.least("weight", F.lit(cap))).alias("weight"))
    new = new.join(lexicon.select("reading", "text"), ["reading", "text"], "left_anti")
    return lexicon.select("reading", "text", "weight").unionByName(new.select("reading", "text", "weight"))


def capped(lexicon: DataFrame, terms: DataFrame, cap: int = 80) -> DataFrame:
    t = terms.select("text").distinct().withColumn("_cap", F.lit(cap))
    return lexicon.join(t, "text", "left").withColumn("weight", F.coalesce(F.least("weight", "_cap"), "weight")).drop("_cap")


def single_reading_overrides(rows: DataFrame) -> DataFrame:
    """text, reading for texts with one explicit reading only."""
    return rows.groupBy("text").agg(F.count_distinct("reading").alias("k"), F.min("reading").alias("reading")).where("k = 1").select("text", "reading")


def category_frequency(rows: DataFrame, least: int = 2) -> DataFrame:
    """text, frequency from (text, category, df): largest in each category, summed; a single category is no sign of general use."""
    one = rows.groupBy("text", "category").agg(F.max("df").alias("df"))
    return one.groupBy("text").agg(F.sum("df").alias("frequency"), F.map_from_entries(F.collect_list(F.struct("category", "df"))).alias("by_category"), F.count("*").alias("k")).where(F.col("k") >= least).drop("k")


def specialist_prior(terms: DataFrame, familiar: DataFrame) -> DataFrame:
    """text, prior: the fixed prior of specialist terms, or one that follows editorial familiarity (0 to 1)."""
    f = familiar.select("text", "familiarity")
    pop = F.bround(158 + 25 * F.col("familiarity")).cast("int")
    zero = F.lit(0)
    common = F.array(pop, zero, zero, F.lit(1), F.lit(150), zero, zero)
    return terms.join(f, "text", "left").select("text", F.when(F.col("familiarity").isNull(), F.array(*[F.lit(x) for x in (1, 0, 0, 1, 150, 4, 0)])).otherwise(common).alias("prior"))


def popularity_prior(signals: DataFrame) -> DataFrame:
    """text, popularity, hits, risk, layer, path_score from joined signals.

    The formula is this library's own: usage and corpus frequency on a log scale, raised by days in the hot lists, lowered
    for cold terms of a vertical layer; the lexicon's weight takes no part.
    """
    base = 60 * F.log10(1 + F.coalesce("corpus", F.lit(0))) + 300 * F.coalesce("usage", F.lit(0))
    hot, cold = F.coalesce("hot", F.lit(False)), F.coalesce("low", F.lit(False)) & F.col("layer").isNotNull()
    pop = F.when(hot, F.greatest(F.lit(700), base)).when(cold, F.least(F.lit(199), base)).otherwise(base)
    return signals.select("text", F.least(F.lit(1000), F.bround(pop)).cast("int").alias("popularity"), F.coalesce("hits", F.lit(0)).cast("int").alias("hits"), F.when(cold, 260).otherwise(100).alias("risk"), F.coalesce("layer", F.lit(0)).cast("int").alias("layer"), F.coalesce("path_score", F.lit(0)).cast("int").alias("path_score"))

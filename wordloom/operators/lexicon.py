"""Lexicons: merging, buckets of equal reading, lookups, checks against samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenation with precedence: column prec tells the place of the frame a row comes from."""
    return reduce(DataFrame.unionByName, [f.withColumn("prec", F.lit(k)) for k, f in enumerate(frames)])


def max_weight(*lexicons: DataFrame) -> DataFrame:
    """(reading, text, weight): one row each, with the largest weight."""
    rows = reduce(DataFrame.unionByName, [x.select("reading", "text", "weight") for x in lexicons])
    return rows.groupBy("reading", "text").agg(F.max("weight").alias("weight"))


def ranked(lexicon: DataFrame, key: str = "reading") -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc("weight"), "text")
    return lexicon.withColumn("rank", F.row_number().over(w))


def bucket_top(lexicon: DataFrame, k: int, key: str = "reading") -> DataFrame:
    return ranked(lexicon, key).where(F.col("rank") <= k)


def lookup(words: DataFrame, counts: DataFrame, on: Column | str = "text", default: int | None = None) -> DataFrame:
    """Words with their count: inner, or outer where a default is given."""
    key = F.col(on) if isinstance(on, str) else on
    c = counts.select(F.col("text").alias("_word"), F.col("n").alias("_n"))
    out = words.join(c, key == F.col("_word"), "inner" if default is None else "left").drop("_word")
    out = out.withColumn("n", F.col("_n") if default is None else F.coalesce("_n", F.lit(default))).drop("_n")
    return out.where("n > 0") if default is None else out


def unknown(words: DataFrame, known: DataFrame, on: str = "text") -> DataFrame:
    return words.join(known.select(on).distinct(), on, "left_anti")


def flagged(rows: DataFrame, keys: DataFrame, on: list[str], name: str) -> DataFrame:
    """Rows with a boolean: whether their key is among the keys."""
    return rows.join(keys.select(*on).distinct().withColumn(name, F.lit(True)), on, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def best(rows: DataFrame, key: list[str], score: list, ties: list) -> DataFrame:
    """One row for each key: highest score, then first by ties."""
    w = Window.partitionBy(*key).orderBy(*[F.desc(s) for s in score], *ties)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def regressions(lexicon: DataFrame, samples: DataFrame, preview: int = 5) -> DataFrame:
    """reading, text, problem, rank, shown for each sample (reading, text, forbidden, max_rank) that fails."""
    r = ranked(lexicon)
    shown = r.where(F.col("rank") <= preview).groupBy("reading").agg(F.expr("listagg(text, ', ') WITHIN GROUP (ORDER BY rank)").alias("shown"))
    out = samples.join(r.select("reading", "text", "rank"), ["reading", "text"], "left").join(shown, "reading", "left")
    problem = (
        F.when(F.col("forbidden") & F.col("rank").isNotNull(), "forbidden_present")
        .when(F.col("forbidden"), None)
        .when(F.col("shown").isNull(), "no_candidates")
        .when(F.col("rank").isNull(), "missing")
        .when(F.col("rank") > F.col("max_rank"), "rank_exceeded")
    )
    return out.withColumn("problem", problem).where("problem IS NOT NULL").select("reading", "text", "problem", "rank", "shown")


def add_only(lexicon: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows whose key the lexicon lacks, appended."""
    new = rows.join(lexicon.select("reading", "text"), ["reading", "text"], "left_anti")
    return lexicon.unionByName(new.select(*lexicon.columns))


def entry_index(lexicon: DataFrame) -> DataFrame:
    """text, entries: for each text its (reading, weight, rank within the reading, top weight of the reading), the weightiest first."""
    by_reading = Window.partitionBy("reading")
    rows = ranked(lexicon).withColumn("top", F.max("weight").over(by_reading))
    entry = F.struct((-F.col("weight")).alias("o"), "reading", "weight", "rank", "top")
    entries = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["reading"].alias("reading"), e["weight"].alias("weight"), e["rank"].alias("rank"), e["top"].alias("top")))
    return rows.groupBy("text").agg(entries.alias("entries"))


def only_characters(a: DataFrame, b: DataFrame) -> DataFrame:
    """char: the characters of texts of a that no text of b has."""
    chars = lambda df: df.select(F.explode(F.split("text", "")).alias("char")).where("char <> ''").distinct()
    return chars(a).join(chars(b), "char", "left_anti")

"""Counts and rates of words and characters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.keys import words


def tokens(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep, pos, word."""
    return docs.select(*keep, F.posexplode(words(F.col(text))).alias("pos", "word"))


def one_row_each(docs: DataFrame, source: str) -> bool:
    """Whether no source but null has two rows; only that column is read."""
    return docs.where(F.col(source).isNotNull()).groupBy(source).agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def sorted_marks(docs: DataFrame, keep: list[str], items: str, key: str | None = None) -> DataFrame:
    """keep, item, first: the items of each row's array, in order; the first of equal ones (structs: of an equal ``key``, their first field) in a row is marked."""
    df = docs.select(*keep, F.sort_array(items).alias("_s"))
    at = F.when(F.size("_s") > 0, F.sequence(F.lit(0), F.size("_s") - 1))
    value = lambda i: F.get("_s", i)[key] if key else F.get("_s", i)
    one = lambda i: F.struct(F.get("_s", i).alias("item"), ((i == 0) | (value(i) != value(i - 1))).alias("first"))
    return df.select(*keep, F.inline(F.transform(at, one)))


def char_counts(docs: DataFrame, pattern: str = r"\p{L}", text: str = "text") -> DataFrame:
    """char, n of the characters that match: counted by text line first, so a line's letters are one row each."""
    chars = docs.select(F.explode(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))).alias("char"))
    return chars.groupBy("char").agg(F.count("*").alias("n"))


def inside_counts(word_counts: DataFrame) -> DataFrame:
    """char, inside: occurrences within words of two characters or more (text, n)."""
    long = word_counts.where(F.length("text") >= 2)
    return long.select(F.explode(F.split("text", "")).alias("char"), "n").where("char <> ''").groupBy("char").agg(F.sum("n").alias("inside"))


def standalone(chars: DataFrame, word_counts: DataFrame) -> DataFrame:
    """char, n, alone: occurrences that no word accounts for."""
    inside = inside_counts(word_counts)
    return chars.join(inside, "char", "left").select("char", "n", F.greatest(F.lit(0), F.col("n") - F.coalesce("inside", F.lit(0))).cast("long").alias("alone"))


def use_rate(rows: DataFrame, total: float, chat: DataFrame | None = None, chat_total: float = 1.0, chat_weight: float = 3.0) -> DataFrame:
    """char, rate: geometric mean of all and standalone uses per 10**8 characters, plus weighted chat uses."""
    rate = F.sqrt(F.col("n") * F.col("alone")) / F.lit(total) * 1e8
    if chat is None:
        return rows.select("char", rate.alias("rate"))
    c = chat.select(F.col("text").alias("char"), F.col("n").alias("chat"))
    return rows.join(c, "char", "left").select("char", (rate + F.coalesce("chat", F.lit(0)) / chat_total * 1e8 * chat_weight).alias("rate"))


def form_shares(rows: DataFrame) -> DataFrame:
    """(simplified, traditional, inside, alone) with each form's share of use; groups without use go."""
    use = F.sqrt((F.col("inside") + F.col("alone")) * F.col("alone"))
    total = F.sum("use").over(Window.partitionBy("simplified"))
    return rows.withColumn("use", use).withColumn("total", total).where("total > 0").withColumn("share", F.col("use") / F.col("total")).drop("use", "total")


def covered_positions(tokens: DataFrame, lexicon: DataFrame, least: int = 2, most: int = 8) -> DataFrame:
    """keep, pos, char, covered: whether a position of word lies in a lexicon word of bounded length.

    Spans are met by equality, never by range; each row of tokens (word) gives its distinct spans.
    """
    known = lexicon.select(F.col("text").alias("span")).distinct()
    w = tokens.select("word").distinct()
    spans = w.select("word", F.posexplode(F.split("word", "")).alias("start", "c")).where("c <> ''")
    spans = spans.select("word", "start", F.explode(F.sequence(F.lit(least), F.lit(most))).alias("len")).where(F.col("start") + F.col("len") <= F.length("word"))
    hits = spans.withColumn("span", F.substring("word", F.col("start") + 1, F.col("len"))).join(known, "span", "left_semi")
    cover = hits.select("word", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("at")).distinct().withColumn("covered", F.lit(True))
    chars = w.select("word", F.posexplode(F.split("word", "")).alias("at", "char")).where("char <> ''")
    return chars.join(cover, ["word", "at"], "left").withColumn("covered", F.coalesce("covered", F.lit(False)))


def form_counts(positions: DataFrame) -> DataFrame:
    """char, form, inside, alone from positions (char, form, covered, n)."""
    return positions.groupBy("char", "form").agg(F.sum(F.when(F.col("covered"), F.col("n")).otherwise(0)).alias("inside"), F.sum(F.when(F.col("covered"), 0).otherwise(F.col("n"))).alias("alone"))

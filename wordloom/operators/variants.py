"""Spelling variants: conversion, twins, scores merged over variants."""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.functions.bounded import read_bounded


def merged_twins(rows: DataFrame, key: list[str], convert: dict[str, Column], better: Column) -> DataFrame:
    """Rows with columns converted; of rows that then share the key, the better one (unchanged first among equals)."""
    before = {c: F.col(c) for c in convert}
    changed = None
    for c, new in convert.items():
        d = ~new.eqNullSafe(before[c])
        changed = d if changed is None else changed | d
    out = rows.withColumn("_same", ~changed).withColumns(convert)
    others = [c for c in rows.columns if c not in key]
    return out.groupBy(*key).agg(F.max(F.struct(better.alias("_b"), F.col("_same"), *others)).alias("_m")).select(*key, *[F.col(f"_m.{c}") for c in others])


def log_sum_exp(grams: DataFrame, key: str = "gram") -> DataFrame:
    """key, score, backoff of rows (key, ord, score, backoff) in 1000 * ln p: folded in order, rounding at each step; the
    backoff follows the more probable of total and row."""
    rows = F.array_sort(F.collect_list(F.struct("ord", "score", "backoff")))

    def add(total: Column, row: Column) -> Column:
        top, low = F.greatest(total["score"], row["score"]), F.least(total["score"], row["score"])
        s = F.bround(top + 1000 * F.log1p(F.exp((low - top) / 1000.0))).cast("int")
        return F.struct(s.alias("score"), F.when(row["score"] > total["score"], row["backoff"]).otherwise(total["backoff"]).alias("backoff"))

    first = F.struct(rows[0]["score"].cast("int").alias("score"), rows[0]["backoff"].alias("backoff"))
    return grams.groupBy(key).agg(F.aggregate(F.slice(rows, 2, 1 << 30), first, add).alias("m")).select(key, "m.score", "m.backoff")


def raised_twins(lexicon: DataFrame, variants: DataFrame, low: int = 1) -> DataFrame:
    """(reading, text, weight): a variant spelling (variant, target) gives its weight to the target, made if missing, and falls to ``low``."""
    given = lexicon.join(variants, F.col("text") == F.col("variant")).groupBy("reading", "target").agg(F.max("weight").alias("given"))
    base = lexicon.join(variants.select(F.col("variant").alias("text"), F.lit(True).alias("is_variant")), "text", "left")
    base = base.select("reading", "text", F.when(F.col("is_variant"), F.least(F.lit(low), F.col("weight"))).otherwise(F.col("weight")).alias("weight"))
    return base.join(given.withColumnRenamed("target", "text"), ["reading", "text"], "full").select("reading", "text", F.greatest("weight", "given").alias("weight"))


def backfilled(target: DataFrame, source: DataFrame, converted: Column) -> DataFrame:
    """Target entries and those of source in the target's spelling; an entry that is there keeps its larger weight."""
    s = source.select("reading", converted.alias("text"), "weight").groupBy("reading", "text").agg(F.max("weight").alias("from_source"))
    return target.join(s, ["reading", "text"], "full").select("reading", "text", F.greatest("weight", "from_source").alias("weight"), F.col("weight").isNotNull().alias("twin"))


def char_pairs(words: DataFrame) -> DataFrame:
    """a, b, n: characters that differ at the same place of aligned spellings (left, right) of one length."""
    same = words.where(F.length("left") == F.length("right"))
    pairs = same.select(F.explode(F.arrays_zip(F.split("left", ""), F.split("right", ""))).alias("p")).select(F.col("p")["0"].alias("a"), F.col("p")["1"].alias("b"))
    return pairs.where("a <> b").groupBy("a", "b").agg(F.count("*").alias("n"))


def same_word(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Words (left, right) all of whose differing characters are known pairs (a, b)."""
    cells = words.where(F.length("left") == F.length("right")).select("left", "right", F.explode(F.arrays_zip(F.split("left", ""), F.split("right", ""))).alias("p"))
    cells = cells.select("left", "right", F.col("p")["0"].alias("a"), F.col("p")["1"].alias("b")).where("a <> b")
    wrong = cells.join(pairs.select("a", "b"), ["a", "b"], "left_anti").select("left", "right").distinct()
    return words.where(F.length("left") == F.length("right")).join(wrong, ["left", "right"], "left_anti")


def corrected_map(pairs: DataFrame, fixes: DataFrame) -> DataFrame:
    """(from, to) with fixes (from, to) applied: a fix replaces the target, or removes the row if its own is null."""
    f = fixes.select("from", F.col("to").alias("_to"), F.lit(True).alias("_fix"))
    return pairs.join(f, "from", "left").withColumn("to", F.when(F.col("_fix"), F.col("_to")).otherwise(F.col("to"))).where("to IS NOT NULL").select("from", "to")


def repaired(rows: DataFrame, a: str, b: str, converted: Column) -> DataFrame:
    """Column b set to the conversion of a where it only repeats a and the conversion differs; flagged."""
    fix = (F.col(b) == F.col(a)) & (converted != F.col(a))
    return rows.withColumn("repaired", fix).withColumn(b, F.when(fix, converted).otherwise(F.col(b)))


def same_length(rows: DataFrame, text: str, converted: Column) -> DataFrame:
    """Rows whose conversion (column converted) has as many characters, so that positions correspond; the others go."""
    return rows.withColumn("converted", converted).where(F.length("converted") == F.length(text))


def phrase_converter(phrases: dict[str, str], chars: dict[str, str]) -> Callable:
    """A vectorised column function: the longest phrase at each place wins, then characters one by one."""
    most = max(map(len, phrases), default=1)

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        out, i = [], 0
        while i < len(t):
            for n in range(min(most, len(t) - i), 1, -1):
                if (p := phrases.get(t[i : i + n])) is not None:
                    out.append(p)
                    i += n
                    break
            else:
                out.append(chars.get(t[i], t[i]))
                i += 1
        return "".join(out)

    @F.pandas_udf("string")
    def convert(s: pd.Series) -> pd.Series:
        return s.map(one)

    return convert


def phrase_first(rows: DataFrame, column: str, phrases: DataFrame, chars: dict[str, str], most: int = 500_000) -> DataFrame:
    """rows with converted and spans (at, length, target): from the left the longest phrase (form, target) at each place, else the character's own form.

    The phrases, at most ``most`` of one target each, travel as an automaton's words; texts are matched in Arrow batches, in one pass however many phrases
    there are.  Spans tell the places that a phrase decided, in order, for readings that go with it.  A null text stays null, without spans.
    """
    found = {r.form: r.target for r in read_bounded(phrases.where("form <> ''").groupBy("form").agg(F.min("target").alias("target")), most)}
    shared = rows.sparkSession.sparkContext.broadcast((found, {ord(k): v for k, v in chars.items()}))
    place = rows.columns.index(column)
    schema = T.StructType([*rows.schema.fields, T.StructField("converted", T.StringType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("target", T.StringType())])))])

    def run(batches):
        words, single = shared.value
        machine = ahocorasick.Automaton()
        for w, target in words.items():
            machine.add_word(w, (len(w), target))
        machine.make_automaton()
        for batch in batches:
            texts, spans = [], []
            for t in batch.column(place).to_pylist():
                longest: dict[int, tuple[int, str]] = {}  # of each place where a phrase begins
                for last, found in machine.iter(t) if t and words else ():
                    at = last - found[0] + 1
                    longest[at] = max(longest.get(at, found), found)
                out, own, end = [], [], 0
                for at in sorted(longest):
                    if at >= end:
                        n, target = longest[at]
                        out += [t[end:at].translate(single), target]
                        own.append({"at": at, "length": n, "target": target})
                        end = at + n
                texts.append(None if t is None else "".join(out) + t[end:].translate(single))
                spans.append(own)
            kind = pa.list_(pa.struct([("at", pa.int32()), ("length", pa.int32()), ("target", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(spans, kind)], names=[*batch.schema.names, "converted", "spans"])

    return rows.mapInArrow(run, schema)

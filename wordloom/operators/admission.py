"""Admission of candidate terms: the first reason that applies decides."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    """Word lists are data: they are given, not part of the library."""

    shape: str = r"^[\x{4e00}-\x{9fff}]{3,10}$"
    dropped: tuple[str, ...] = ()
    errors: tuple[str, ...] = ()
    fragment_starts: tuple[str, ...] = ()
    fragment_ends: tuple[str, ...] = ()
    organisation_ends: tuple[str, ...] = ()
    organisation_kept: tuple[str, ...] = ()
    markers: dict[str, tuple[str, ...]] = field(default_factory=dict)  # category -> one of these must occur
    barred_ends: dict[str, tuple[str, ...]] = field(default_factory=dict)  # category -> none of these at the end
    barred: dict[str, tuple[str, ...]] = field(default_factory=dict)  # category -> none of these anywhere
    required_ends: dict[str, tuple[str, ...]] = field(default_factory=dict)


def _any(tests) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def reason(text: Column, category: Column, r: Rules) -> Column:
    """Why a term is rejected, or the empty string."""
    starts, ends, has = (lambda xs: _any(text.startswith(x) for x in xs)), (lambda xs: _any(text.endswith(x) for x in xs)), (lambda xs: _any(text.contains(x) for x in xs))
    c = F.when(~text.rlike(r.shape), "length_or_script").when(text.isin(*r.dropped), "lexical_exclusion").when(text.isin(*r.errors), "source_error")
    c = c.when(starts(r.fragment_starts) | ends(r.fragment_ends), "fragment").when(ends(r.organisation_ends) & ~text.isin(*r.organisation_kept), "organization_label")
    for cat, xs in r.markers.items():
        c = c.when((category == cat) & ~has(xs), f"{cat}_domain_mismatch")
    for cat, xs in r.barred_ends.items():
        c = c.when((category == cat) & ends(xs), "publication_title")
    for cat, xs in r.barred.items():
        c = c.when((category == cat) & has(xs), "fiction_label")
    for cat, xs in r.required_ends.items():
        c = c.when((category == cat) & ~ends(xs), f"{cat}_domain_mismatch")
    return c.otherwise("")


def reading_reason(terms: DataFrame, char_readings: DataFrame, boundary_ok: Column) -> DataFrame:
    """Terms (text, converted, syllables) with a reason: lengths that differ, a character without that reading, an ambiguous boundary."""
    cells = terms.select("text", F.explode(F.arrays_zip(F.split("text", ""), "syllables")).alias("p")).select("text", F.col("p")["0"].alias("char"), F.col("p")["syllables"].alias("reading"))
    bad = cells.join(char_readings.select("char", "reading"), ["char", "reading"], "left_anti").select("text").distinct().withColumn("_bad", F.lit(True))
    why = F.when((F.length("converted") != F.length("text")) | (F.size("syllables") != F.length("text")), "script_or_reading_length").when(F.col("_bad"), "unverified_character_reading").when(~boundary_ok, "ambiguous_boundary").otherwise("")
    return terms.join(bad, "text", "left").withColumn("reason", why).drop("_bad")


def reason_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category", F.when(F.col("reason") == "", "admitted").otherwise(F.col("reason")).alias("reason")).agg(F.count("*").alias("n"))


def triples(df: DataFrame, subject: str, predicates: list[str]) -> DataFrame:
    """s, p, o: a table as subject, predicate, object."""
    pairs = F.array(*[F.struct(F.lit(c).alias("p"), F.col(c).cast("string").alias("o")) for c in predicates])
    return df.select(F.col(subject).cast("string").alias("s"), F.explode(pairs).alias("x")).select("s", "x.p", "x.o").where("o IS NOT NULL")


def matched(facts: DataFrame, pattern: list[tuple[str, str, str]]) -> DataFrame:
    """The bindings of a basic graph pattern: names that start with ? are variables, joined where they recur."""
    out = None
    for s, p, o in pattern:
        t = facts.where(F.col("p") == p)
        for name, c in ((s, "s"), (o, "o")):
            if not name.startswith("?"):
                t = t.where(F.col(c) == name)
        names = {n[1:]: F.col(c) for n, c in ((s, "s"), (o, "o")) if n.startswith("?")}
        t = t.select(*[c.alias(n) for n, c in names.items()]).distinct()
        out = t if out is None else out.join(t, sorted(set(out.columns) & set(names)))
    return out.distinct()

"""Constraints on published tables: each check returns its violations, one row each with the name of the rule."""

from __future__ import annotations

from fnmatch import fnmatch, translate
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

READING = "^[a-z]+(?:'[a-z]+)*$"


def violations(df: DataFrame, rules: dict[str, Column], unique: list | None = None, at_most: dict[str, tuple[list, int]] | None = None) -> DataFrame:
    """Rows of df that break a rule (a rule that is null counts as broken), repeat a key, or are beyond a group's size."""
    df = df.withColumn("_broken", F.filter(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]), lambda x: x.isNotNull()) if rules else F.array().cast("array<string>"))
    extra = []
    if unique:
        extra.append(F.when(F.count("*").over(Window.partitionBy(*unique)) > 1, F.lit("not_unique")))
    for name, (key, most) in (at_most or {}).items():
        extra.append(F.when(F.count("*").over(Window.partitionBy(*key)) > most, F.lit(name)))
    if extra:
        df = df.withColumn("_broken", F.concat("_broken", F.filter(F.array(*extra), lambda x: x.isNotNull())))
    return df.withColumn("rule", F.explode("_broken")).drop("_broken")


def dictionary(df: DataFrame) -> DataFrame:
    return violations(df, {"reading": F.col("reading").rlike(READING), "text": F.length("text") > 0, "weight": F.expr("try_cast(weight AS BIGINT)").isNotNull(), "scope": F.col("scope").isNull() | F.col("scope").isin("", "no_contains")})


def transition_completion(df: DataFrame, most: int = 6) -> DataFrame:
    """prefix, reading, text, path, evidence."""
    plain = F.replace("reading", F.lit("'"), F.lit(""))
    rules = {"prefix": plain.startswith(F.col("prefix")) & (F.length("prefix") < F.length(plain)), "path": F.replace("path", F.lit("|"), F.lit("")) == F.col("text"), "evidence": F.col("evidence") > 0}
    return violations(df, rules, ["prefix", "reading", "path"], {"rows": (["prefix"], most)})


def long_completion(df: DataFrame) -> DataFrame:
    """anchor, suffix, syllables, evidence, sources, visible."""
    rules = {"anchor": F.size("anchor").between(1, 3), "suffix": F.size("suffix").between(1, 3), "syllables": F.size("syllables").between(1, 6), "counts": (F.col("evidence") > 0) & (F.col("sources") >= 0)}
    out = violations(df.withColumn("_text", F.concat_ws("", "suffix")), rules, ["anchor", "syllables", "_text"], {"recall_rows": (["anchor"], 24)}).drop("_text")
    shown = violations(df.where("visible"), {}, None, {"visible_rows": (["anchor"], 8)})
    return out.unionByName(shown)


def competition(df: DataFrame) -> DataFrame:
    """width, context, prefix, reading, text, evidence, occurrences, sources."""
    rules = {"width": F.col("width").between(0, 4), "context": (F.col("width") == 0) == (F.col("context") == ""), "counts": (F.col("evidence") > 0) & (F.col("occurrences") > 0), "sources": F.col("sources").between(1, 16)}
    return violations(df, rules, ["width", "context", "prefix", "reading", "text"])


def pair_audit(df: DataFrame) -> DataFrame:
    """width, context, prefix, baseline, challenger, keep, switch, decision, confidence."""
    rules = {"decision": F.col("decision").isin(-1, 0, 1), "confidence": F.col("confidence").between(0, 1000), "events": F.col("keep") + F.col("switch") > 0}
    return violations(df, rules, ["width", "context", "prefix", "baseline", "challenger"])


def short_promotion(df: DataFrame) -> DataFrame:
    """prefix, baseline, promoted, candidates (array of struct word, weight)."""
    words = F.transform("candidates", lambda c: c["word"])
    rules = {"size": F.size(words).between(2, 3), "baseline_first": words[0] == F.col("baseline"), "promoted_once": F.size(F.filter(words, lambda w: w == F.col("promoted"))) == 1, "distinct": F.size(F.array_distinct(words)) == F.size(words)}
    return violations(df, rules, ["prefix"])


def overrides(lines: DataFrame) -> DataFrame:
    return violations(lines, {"format": F.col("line").rlike("^[^\t]+\t[a-z]+(?:'[a-z]+)*$")})


def order_kept(rows: DataFrame, order: DataFrame) -> DataFrame:
    """Audited pairs (reading, char, other) whose order is broken: a sink must find none."""
    a = rows.select("reading", "char", F.col("weight").alias("wa"))
    b = rows.select("reading", F.col("char").alias("other"), F.col("weight").alias("wb"))
    return order.join(a, ["reading", "char"]).join(b, ["reading", "other"]).where("wa <= wb")


def licences(manifest: list[dict], profile: str, barred: tuple[str, ...] = ("gpl", "sa", "sharealike", "nc")) -> list[str]:
    """Sources of a permissive profile whose licence has a barred token (manifests are small and read by the driver)."""
    tokens = lambda s: set(s.get("license", "").lower().replace("-", " ").replace(".", " ").split())
    return [s["id"] for s in manifest if profile == "permissive" and tokens(s) & set(barred)]


def all_of(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.groupBy("rule").agg(F.count("*").alias("n")) for f in frames])


def files(names: list[str], required: list[str], barred: list[str]) -> list[tuple[str, str]]:
    """(rule, name): required files that are missing, and files that match a barred pattern (as of fnmatch) and must not be published."""
    gone = [("missing", r) for r in required if r not in set(names)]
    return gone + sorted(("forbidden", n) for n in names if any(fnmatch(n, p) or fnmatch(n.rsplit("/", 1)[-1], p) for p in barred))


def barred_sources(manifest: DataFrame, barred: tuple[str, ...] = ("gpl", "sa", "sharealike", "nc")) -> DataFrame:
    """Rows of a manifest (license and other columns) whose licence has a barred token; as licences(), for manifests of any size."""
    tokens = F.split(F.translate(F.lower(F.coalesce("license", F.lit(""))), "-.", "  "), r"\s+")
    return manifest.where(F.arrays_overlap(tokens, F.array(*[F.lit(b) for b in barred])))


def published(names: DataFrame, required: DataFrame, barred: list[str]) -> DataFrame:
    """rule, name: as files(), for names and required ones (column name) of any number."""
    plain = F.element_at(F.split("name", "/"), -1)
    bad = reduce(lambda a, b: a | b, [F.col("name").rlike(f"^{translate(p)}") | plain.rlike(f"^{translate(p)}") for p in barred])
    gone = required.join(names, "name", "left_anti").select(F.lit("missing").alias("rule"), "name")
    return gone.unionByName(names.where(bad).select(F.lit("forbidden").alias("rule"), "name"))

"""Sinks.  Parquet is the canonical form; text forms are for exchange."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def sorted_table(df: DataFrame, path: str, columns: list[str], order: list, header: list[str] = ()) -> None:
    """A tab-separated table in global order, after # comment lines in a file of its own that sorts first."""
    rows = df.orderBy(*order).select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))
    rows.write.mode("overwrite").text(path)
    if header:
        df.sparkSession.createDataFrame([(f"# {h}",) for h in header], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.header")


def index_rows(df: DataFrame) -> DataFrame:
    """The seven text columns of a completion index (anchor, suffix, syllables, evidence, sources, visible)."""
    return df.select(F.concat_ws("|", "anchor").alias("anchor"), F.concat_ws("'", "syllables").alias("reading"), F.concat_ws("", "suffix").alias("text"), F.concat_ws("|", "suffix").alias("path"), "evidence", "sources", F.col("visible").cast("int").alias("visible"))


def json_fragments(df: DataFrame, path: str) -> None:
    df.select("source", "text").write.mode("overwrite").json(path)


def changed(old: DataFrame, new: DataFrame) -> bool:
    """Whether the two tables differ as multisets: publish only then."""
    return not (old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty())


def keep_order(previous: DataFrame, current: DataFrame, excluded: DataFrame, unscoped: DataFrame | None = None) -> DataFrame:
    """Rows of current (reading, text, weight) in the previous order (ord), new ones after; excluded texts go.

    Texts of ``unscoped`` get the scope no_contains.  Order the result by (place, reading, text).
    """
    out = current.join(excluded.select("text").distinct(), "text", "left_anti")
    out = out.join(previous.select("reading", "text", F.col("ord").alias("place")), ["reading", "text"], "left")
    if unscoped is not None:
        out = out.join(unscoped.select("text").distinct().withColumn("scope", F.lit("no_contains")), "text", "left")
    return out.withColumn("place", F.coalesce("place", F.lit((1 << 62) * 1)))


def observed(df: DataFrame, write, **counters) -> dict:
    """Counters (column aggregates) of a table, taken while ``write(df)`` runs: the table is read once."""
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in counters.items()]))
    return seen.get


def review_queue(rows: DataFrame) -> DataFrame:
    """Rejected rows with their reason, for people to look at; nothing reads them back."""
    return rows.where(F.col("reason") != "")


def report(counters: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(counters, f, ensure_ascii=False, indent=2, sort_keys=True)


def refreshed(markdown: str, label: str, value: str) -> str:
    """A document with the one table row of that label set to value."""
    out, n = re.subn(rf"(?m)^(\|\s*{re.escape(label)}\s*\|)[^|\n]*\|", rf"\g<1> {value} |", markdown)
    if n != 1:
        raise ValueError(f"{label}: {n} rows, not one")
    return out

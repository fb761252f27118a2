"""Priors of word paths by what is typed: whole paths, and beginnings that lead to several.

Every path (words, their readings, evidence) is a way through a trie of words.  A node's evidence is that of all paths through it.  A node is offered for its
reading if it ends a path (full), or if at least ``branches`` paths go on from it (prefix).  Nodes of one reading compete: the ``most`` of most evidence
stay, each with its share of the reading's whole evidence as prior, in thousandths, at least 1.  The weights are this library's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def path_nodes(paths: DataFrame) -> DataFrame:
    """reading, path (words), full, through (number of paths that go on), evidence of each node; paths: words, syl (of each word), evidence."""
    at = F.explode(F.sequence(F.lit(1), F.size("words"))).alias("a")
    nodes = paths.select("words", "syl", "evidence", at).select(
        F.concat_ws("", F.flatten(F.slice("syl", F.lit(1), F.col("a")))).alias("reading"),
        F.slice("words", F.lit(1), F.col("a")).alias("path"),
        (F.col("a") == F.size("words")).alias("ends"),
        "evidence",
    )
    return nodes.groupBy("reading", "path").agg(F.max("ends").alias("full"), F.sum((~F.col("ends")).cast("int")).alias("through"), F.sum("evidence").alias("evidence"))


def query_path_priors(paths: DataFrame, branches: int = 2, most: int = 8) -> DataFrame:
    """reading, path, kind (full or prefix), rank, prior."""
    nodes = path_nodes(paths).where((F.col("reading") != "") & (F.col("full") | (F.col("through") >= branches)))
    # a reading's total is an aggregate beside the ranks: the window ends once ``most`` rows of a reading are seen
    totals = nodes.groupBy("reading").agg(F.sum("evidence").alias("total"))
    ranked = nodes.withColumn("rank", F.row_number().over(Window.partitionBy("reading").orderBy(F.desc("evidence"), "path"))).where(F.col("rank") <= most)
    prior = F.greatest(F.lit(1), F.round(1000 * F.col("evidence") / F.col("total"))).cast("int")
    return ranked.join(totals, "reading").select("reading", "path", F.when(F.col("full"), "full").otherwise("prefix").alias("kind"), "rank", prior.alias("prior"))

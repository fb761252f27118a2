"""A training-corpus pipeline: score, drop shared lines, near copies and repeated passages, and pack.

Each stage takes what its predecessor wrote and returns documents (the last: pieces of sequences).
Columns other than doc_id and text pass through as they are, save n_chars, which follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import jaccard, lines, packing, quality, substrings
from wordloom.llm.common import id_and_text, new_seed, read_table, saved, scratch

#: Quality is learned, not computed: SQL can't express the rows of run().
ORACLE_SQL = None


def _bundled(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns in one, which no operator looks into; texts move once."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))


def _unbundled(df: DataFrame, like: DataFrame, text) -> DataFrame:
    own = {"text": text, "n_chars": F.length(text).cast("long")}
    return df.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in like.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold stay; null and empty texts have the prior as their score."""
    model = quality.fit(id_and_text(docs), quality.labelled(spark, sf_dir))
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # nothing is shuffled here
    scored = quality.quality_scores(whole, model, carry=["row"])
    return scored.where(F.col("score") >= quality.THRESHOLD).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one."""
    return _unbundled(lines.line_dedup(_bundled(docs), carry=["row"]), docs, F.col("text"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, of those that share it the first by text; rows without an id all do, and texts without words."""
    seed = new_seed()
    own, named = jaccard.grouped(docs, seed=seed)
    found = own.join(named, ["size", "h1", "h2"], "left").where(F.col("doc_id") != jaccard.NO_ID)
    least = F.col("doc_id") == F.coalesce("component_id", "doc_id")
    stays = saved(found.groupBy(F.col("doc_id").alias("kept_id")).agg(F.count("*").alias("n"), F.max(least).alias("least")).where("least").drop("least"))
    alone, shared = stays.where("n = 1"), stays.where("n > 1")
    no_id = docs["doc_id"].isNull() | (docs["doc_id"] == jaccard.NO_ID)
    # bound to their frames: docs may have a column kept_id too
    out = docs.where(no_id).unionByName(docs.join(alone, docs["doc_id"] == alone["kept_id"], "left_semi"))
    if shared.isEmpty():
        return out
    whole = docs.join(shared, docs["doc_id"] == shared["kept_id"], "left_semi").select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = jaccard.with_class(whole, seed=seed).join(named, ["size", "h1", "h2"], "left")
    first = rows.where(F.col("row.doc_id") == F.col("component_id")).groupBy("c").agg(F.min_by("row", "text").alias("row"))
    return out.unionByName(first.select("row.*")).unionByName(rows.where("size = 0").select("row.*"))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has too go; texts that lose nothing stay as they are."""
    return _unbundled(substrings.substring_dedup(_bundled(docs), carry=["row"], untouched=True), docs, F.col("text"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_copies", near_copy_stage), ("passages", passage_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each but the last is written to the shared folder and read again, and goes once the next one is written."""
    import uuid

    docs, where = read_table(spark, sf_dir, "documents"), f"{scratch(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
        if before:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        before = f"{where}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)

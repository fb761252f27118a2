"""Scans.  Every scan that later depends on file order carries an explicit ``ord``."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.functions.keys import compact_key, exact_key, lookup_key, record_text, trimmed
from wordloom.operators import running

HOLDOUTS = ("dev.jsonl", "test.jsonl", "validation.jsonl")
SMALL_BYTES, DEALT_BYTES = 1 << 20, 256 << 20


def columnar(spark: SparkSession, path: str, most: int = DEALT_BYTES, ordered: bool = False) -> DataFrame:
    """A Parquet table.  One of fewer files than the session has cores, and of less than ``most`` bytes in all, is dealt over them: in no
    order, or in ranges that keep the order in which it is read.

    Such a table is often one row group, which no more than one task can read; any other is read as it lies, without a shuffle.
    The bound doesn't grow with the cluster: no read moves more than that.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if SMALL_BYTES <= size < most and len(df.inputFiles()) < cores:
        if not ordered:
            return df.repartition(cores)
        place = "__place"
        return df.withColumn(place, F.monotonically_increasing_id()).repartitionByRange(cores, place).sortWithinPartitions(place).drop(place)
    return df


def lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """file, ord, line of all text files under path, without a byte order mark; ord rises within a file."""
    r = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    df = r.text(path)
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), F.regexp_replace(F.make_valid_utf8("value"), "^﻿", "").alias("line")).select("file", F.struct("block", "seq").alias("ord"), "line")


def _fields(df: DataFrame) -> DataFrame:
    return df.withColumn("f", F.split("line", "\t", -1)).withColumn("n", F.size("f"))


def _field(k: int) -> Column:
    return trimmed(F.try_element_at("f", F.lit(k + 1)))


def dictionary_strict(spark: SparkSession, path: str) -> DataFrame:
    """key, reading, text, weight, scope, ord; any malformed row fails the job with its file and line."""
    df = _fields(lines(spark, path).where(trimmed(F.col("line")) != ""))
    weight = F.try_to_number(_field(2), F.lit("S99999999999")).cast("long")
    error = (
        F.when(~F.col("n").isin(3, 4), "invalid column count")
        .when((F.col("n") == 4) & (_field(3) != "no_contains"), "invalid scope")
        .when(weight.isNull(), "invalid weight")
        .when((compact_key(_field(0)) == "") | (_field(1) == ""), "empty reading or text")
    )
    checked = F.when(error.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat("file", F.lit(": "), error, F.lit(": "), F.col("line"))).cast("boolean"))
    return df.where(checked).select(lookup_key(_field(0)).alias("key"), exact_key(_field(0)).alias("reading"), _field(1).alias("text"), weight.alias("weight"), _field(3).alias("scope"), "ord")


def dictionary_lenient(spark: SparkSession, path: str, readings: int = 8) -> DataFrame:
    """text, syllables, ord: rows that don't parse are left out; the first ``readings`` readings of a text stay."""
    df = _fields(lines(spark, path))
    syllables = F.filter(F.transform(F.split(F.lower(_field(0)), "'"), lambda s: F.trim(s)), lambda s: s != "")
    df = df.select(_field(1).alias("text"), syllables.alias("syllables"), F.expr("try_cast(trim(try_element_at(f, 3)) AS BIGINT)").alias("weight"), "n", "ord")
    df = df.where((F.col("n") >= 3) & (F.col("weight") > 0) & (F.size("syllables") == F.length("text")))
    df = df.groupBy("text", "syllables").agg(F.min("ord").alias("ord"))
    rank = F.row_number().over(Window.partitionBy("text").orderBy("ord"))
    return df.withColumn("rank", rank).where(F.col("rank") <= readings)


def counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """text, n of a count table with # comments; path may be a list."""
    return spark.read.csv(path, sep="\t", comment="#", schema="text STRING, n BIGINT", quote="")


def counts_with_total(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """A count table whose first line holds the total."""
    df = _fields(lines(spark, path))
    # the line at the very start of the first file: a minimum, not a sort
    first = df.agg(F.min_by("line", F.struct("file", "ord")).alias("line")).first().line
    total = int(first.split("\t")[1])
    return df.where((F.col("n") >= 2) & ~F.col("line").startswith("#")).select(_field(0).alias("text"), F.expr("try_cast(f[1] AS BIGINT)").alias("n")).where("n IS NOT NULL"), total


def word_set(df: DataFrame, least: int = 2, most: int | None = None) -> DataFrame:
    ok = F.length("text") >= least
    return df.where(ok & (F.length("text") <= most) if most else ok).select("text").distinct()


def text_corpus(spark: SparkSession, path: str) -> DataFrame:
    """source (file below path), domain (its first folder, or novel), ord, text."""
    df = lines(spark, path, "*.txt")
    root = path.rstrip("/").split("/")[-1]
    below = F.regexp_extract("file", f".*?/{root}/(.*)$", 1)
    return df.select(below.alias("source"), F.when(below.contains("/"), F.substring_index(below, "/", 1)).otherwise("novel").alias("domain"), "ord", F.col("line").alias("text"))


def json_corpus(spark: SparkSession, path: str) -> DataFrame:
    """source, domain, ord, text of JSON lines (plain or zstandard); held-out files are left out, bad records too."""
    df = lines(spark, path).where(F.col("file").rlike(r"\.jsonl?(\.zst|\.gz)?$"))
    name = F.element_at(F.split("file", "/"), -1)
    df = df.where(~F.regexp_replace(name, r"\.(zst|gz)$", "").isin(*HOLDOUTS))
    r = F.from_json("line", "source STRING, dataset STRING, id STRING, doc_id STRING, doc_hash STRING")
    record = F.concat_ws(":", "file", F.coalesce(r["source"], r["dataset"]), F.coalesce(r["id"], r["doc_id"], r["doc_hash"], F.col("ord")["seq"].cast("string")))
    return df.select(record.alias("source"), F.regexp_replace(name, r"\.jsonl?(\..*)?$", "").alias("domain"), "ord", F.explode(record_text(F.col("line"))).alias("text"))


def held_out(spark: SparkSession, path: str) -> DataFrame:
    """file of the held-out files that json_corpus leaves out, counted without being read."""
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.(zst|gz)$", "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.where(name.isin(*HOLDOUTS)).select(F.col("path").alias("file"))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """source, id, text of JSON lines, plain or compressed: text or else content; source or dataset or else the file; id, doc_id, doc_hash or else the row's place."""
    df = lines(spark, path).where(F.col("file").rlike(r"\.jsonl?(\.zst|\.gz)?$"))
    r = F.from_json("line", "text STRING, content STRING, source STRING, dataset STRING, id STRING, doc_id STRING, doc_hash STRING")
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.jsonl?(\..*)?$", "")
    place = F.concat_ws(":", F.col("ord")["block"].cast("string"), F.col("ord")["seq"].cast("string"))
    out = df.select(F.coalesce(r["source"], r["dataset"], name).alias("source"), F.coalesce(r["id"], r["doc_id"], r["doc_hash"], place).alias("id"), F.coalesce(r["text"], r["content"]).alias("text"))
    return out.where(F.col("text") != "")


def archives(spark: SparkSession, path: str) -> DataFrame:
    """path, content of whole files; an archive is read in one piece, so each must be under 2 GB."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def zip_members(files: DataFrame, suffix: str = ".txt", chunk: int = 16 << 20) -> DataFrame:
    """source (archive!member), part, text of archives (path, content): members decoded piece by piece."""

    def run(batches):
        import codecs

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in sorted(n for n in z.namelist() if n.endswith(suffix)):
                        decode, k = codecs.getincrementaldecoder("utf-8-sig")("replace").decode, 0
                        with z.open(member) as f:
                            while raw := f.read(chunk):
                                yield pa.record_batch([pa.array([f"{name}!{member}"]), pa.array([k], pa.int64()), pa.array([decode(raw)])], names=["source", "part", "text"])
                                k += 1

    return files.select("path", "content").mapInArrow(run, "source string, part long, text string")


def pinned(files: DataFrame, sha256: str, suffix: str | None = None) -> DataFrame:
    """text, n from lines ``text  number`` of a file (path, content) whose digest must be the one given; with ``suffix``, of the zip members so named."""
    right = F.when(F.sha2("content", 256) == sha256, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("wrong digest: "), "path")).cast("boolean"))
    files = files.where(right)
    if suffix:
        parts = zip_members(files, suffix).groupBy("source").agg(F.expr("listagg(text, '') WITHIN GROUP (ORDER BY part)").alias("whole"))
    else:
        parts = files.select(F.decode("content", "utf-8").alias("whole"))
    parsed = parts.select(F.explode(F.split("whole", r"\r?\n")).alias("line"))
    return parsed.select(F.regexp_extract("line", r"^(.+?)\s+(\d+)\s*$", 1).alias("text"), F.expr(r"try_cast(regexp_extract(line, '^(.+?)\\s+(\\d+)\\s*$', 2) AS BIGINT)").alias("n")).where("n IS NOT NULL")


def cedict(spark: SparkSession, path: str) -> DataFrame:
    """traditional, simplified, reading, gloss of a CC-CEDICT file, plain or gzip; # lines and lines of another shape are left out."""
    form = r"^(\S+) (\S+) \[([^\]]*)\] /(.*)/\s*$"
    df = lines(spark, path).where(~F.col("line").startswith("#") & F.col("line").rlike(form))
    return df.select(*[F.regexp_extract("line", form, k).alias(c) for k, c in enumerate(("traditional", "simplified", "reading", "gloss"), 1)])


def cached(path: str, parameters: dict, fetch: Callable[[dict], list]) -> list:
    """What a remote service answers (JSON values), from the cache file if that was written for the same parameters; else fetched and kept.

    The answers are pages that a driver can hold; bindings() makes rows of them.
    """
    try:
        with open(path, encoding="utf-8") as f:
            kept = json.load(f)
    except (FileNotFoundError, json.JSONDecodeError):
        kept = {}
    if kept.get("parameters") != parameters:
        kept = {"parameters": parameters, "pages": fetch(parameters)}
        with open(path, "w", encoding="utf-8") as f:
            json.dump(kept, f, ensure_ascii=False)
    return kept["pages"]


def bindings(pages: DataFrame, names: list[str], numbers: list[str] = ()) -> DataFrame:
    """Rows of query answers (column page, JSON: results.bindings[].name.value); what is no whole number counts as 0."""
    cell = "STRUCT<value: STRING>"
    shape = f"results STRUCT<bindings: ARRAY<STRUCT<{', '.join(f'`{c}`: {cell}' for c in (*names, *numbers))}>>>"
    rows = pages.select(F.explode(F.from_json("page", shape)["results"]["bindings"]).alias("b"))
    number = lambda c: F.coalesce(F.expr(f"try_cast(b.`{c}`.value AS BIGINT)"), F.lit(0)).alias(c)
    return rows.select(*[F.col("b")[c]["value"].alias(c) for c in names], *[number(c) for c in numbers])


def existing_terms(df: DataFrame, *columns: str) -> DataFrame:
    """text: the distinct terms of several columns, trimmed, without empty ones."""
    return df.select(F.explode(F.array(*[trimmed(F.col(c)) for c in columns])).alias("text")).where("text <> ''").distinct()


def layers(manifest: list[dict], read: Callable[[dict], DataFrame]) -> DataFrame:
    """Rows of the sources of a manifest that name a vertical layer (vertical_layer_id), with source and layer."""
    frames = [read(m).withColumns({"source": F.lit(m["id"]), "layer": F.lit(int(m["vertical_layer_id"]))}) for m in manifest if m.get("vertical_layer_id") is not None]
    return reduce(DataFrame.unionByName, frames)


def marked_block(df: DataFrame, begin: str, end: str) -> DataFrame:
    """Rows (file, ord, line) between the lines that hold begin and end; many tasks share a file."""
    return running.inside(df, ["file"], "ord", F.col("line").contains(begin), F.col("line").contains(end))


def within_budget(df: DataFrame, budget: int, by: str = "source", order: str = "ord", text: str = "text") -> DataFrame:
    """Rows of each input up to, and without, the one that takes the characters over the budget; many tasks share an input."""
    return running.until(df, budget, [by], order, F.length(text))


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path).groupBy("file").agg(F.count("*").alias("n"))


def ragged(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A term list whose rows may end early: missing fields are null."""
    df = _fields(lines(spark, path).where((F.col("line") != "") & ~F.col("line").startswith("#")))
    return df.select(*[_field(k).alias(c) for k, c in enumerate(names)], "ord")


def form_map(spark: SparkSession, path: str) -> dict[str, str]:
    """from -> to characters; each side one character, no character twice."""
    rows = ragged(spark, path, ["from", "to", "kind"]).limit(100_001).collect()
    pairs = {r["from"]: r["to"] for r in rows}
    if len(pairs) != len(rows) or len(rows) > 100_000 or any(len(a) != 1 or len(b or "") != 1 for a, b in pairs.items()):
        raise ValueError(f"{path}: a form map has single characters, each once")
    return pairs

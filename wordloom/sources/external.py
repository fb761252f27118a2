"""Readers of public dictionaries, dumps and catalogues, each a DataFrame of its records.

XML is read record by record: the end tag of a record separates the text source's rows, so a file is split anywhere, plain or bzip2 (one stream or many),
and no file is parsed as a whole.  That asks for records that don't contain themselves and for end tags that don't stand in CDATA or comments, as in
the dumps read here.  All other formats are lines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sources.readers import lines

MESH = "DescriptorUI STRING, DescriptorName STRUCT<String: STRING>, TreeNumberList STRUCT<TreeNumber: ARRAY<STRING>>, ConceptList STRUCT<Concept: ARRAY<STRUCT<TermList: STRUCT<Term: ARRAY<STRUCT<String: STRING>>>>>>"
PAGE = "title STRING, ns INT, id LONG, redirect STRUCT<_title: STRING>, revision STRUCT<text: STRUCT<_VALUE: STRING, `_xml:space`: STRING>>"


def xml_records(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """The records ``<tag ...>...</tag>`` of files, parsed by schema; a record that isn't well-formed is an error that shows it."""
    if not re.fullmatch(r"[A-Za-z_][\w.:-]*", tag):
        raise ValueError(f"no tag: {tag}")
    raw = spark.read.option("recursiveFileLookup", "true").option("lineSep", f"</{tag}>").text(path)
    # what stands before a record's begin: the file's head, or white space; after the last one, the file's end
    at = F.regexp_instr("value", F.lit(f"<{re.escape(tag)}[\\s>]"))
    record = raw.withColumn("at", at).where("at > 0").select(F.concat(F.expr("substring(value, at)"), F.lit(f"</{tag}>")).alias("record"))
    return record.select(F.from_xml("record", schema, {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}).alias("r")).select("r.*")


def mesh(spark: SparkSession, path: str) -> DataFrame:
    """ui, name, trees, terms (distinct, in order) of the descriptors of a MeSH file."""
    r = xml_records(spark, path, "DescriptorRecord", MESH)
    none = F.array().cast("array<string>")
    terms = F.flatten(F.transform("ConceptList.Concept", lambda c: F.coalesce(F.transform(c["TermList"]["Term"], lambda t: F.trim(t["String"])), none)))
    trees = F.coalesce("TreeNumberList.TreeNumber", none)
    return r.select(F.trim("DescriptorUI").alias("ui"), F.trim("DescriptorName.String").alias("name"), trees.alias("trees"), F.array_distinct(F.coalesce(terms, none)).alias("terms"))


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """id, ns, title, redirect (its target or null), text of the pages of a MediaWiki export."""
    r = xml_records(spark, path, "page", PAGE)
    return r.select("id", "ns", "title", F.col("redirect._title").alias("redirect"), F.coalesce(F.col("revision.text._VALUE"), F.lit("")).alias("text"))


def wiki_titles(spark: SparkSession, path: str) -> DataFrame:
    """title of a list of page titles, plain or gzip: a head line, then titles with _ for spaces."""
    return lines(spark, path).where((F.col("line") != "") & (F.col("line") != "page_title")).select(F.translate("line", "_", " ").alias("title"))


def page_views(spark: SparkSession, path: str, project: str) -> DataFrame:
    """title, views of a project, summed over hours and over ``project`` and its mobile form; lines ``project title views size``."""
    p = F.split("line", " ")
    rows = lines(spark, path).where(F.size(p) == 4).select(p[0].alias("project"), F.translate(p[1], "_", " ").alias("title"), F.expr("try_cast(split(line, ' ')[2] AS BIGINT)").alias("views"))
    return rows.where(F.col("project").isin(project, f"{project}.m") & F.col("views").isNotNull()).groupBy("title").agg(F.sum("views").alias("views"))


def unihan(spark: SparkSession, path: str) -> DataFrame:
    """char, field, value of Unihan files: ``U+4E00<tab>field<tab>value``; # lines are left out."""
    form = r"^U\+([0-9A-F]{4,6})\t(\w+)\t(.*\S)\s*$"
    rows = lines(spark, path).where(F.col("line").rlike(form))
    code = F.lpad(F.regexp_extract("line", form, 1), 8, "0")
    return rows.select(F.decode(F.unhex(code), "UTF-32").alias("char"), F.regexp_extract("line", form, 2).alias("field"), F.regexp_extract("line", form, 3).alias("value"))


def tagged_words(spark: SparkSession, path: str) -> DataFrame:
    """word, n, tag of a segmenter's dictionary: ``word number [tag]``; other lines are left out."""
    form = r"^(\S+) (\d+)(?: (\S+))?\s*$"
    rows = lines(spark, path).where(F.col("line").rlike(form))
    return rows.select(F.regexp_extract("line", form, 1).alias("word"), F.regexp_extract("line", form, 2).cast("long").alias("n"), F.nullif(F.regexp_extract("line", form, 3), F.lit("")).alias("tag"))


def conversions(spark: SparkSession, path: str) -> DataFrame:
    """form, target, rank (from 1) of a conversion dictionary: ``form<tab>target target ...``."""
    p = F.split("line", "\t")
    rows = lines(spark, path).where((F.size(p) == 2) & ~F.col("line").startswith("#"))
    out = rows.select(p[0].alias("form"), F.posexplode(F.split(F.trim(p[1]), " +")).alias("k", "target"))
    return out.select("form", "target", (F.col("k") + 1).alias("rank"))


def triples(spark: SparkSession, path: str) -> DataFrame:
    """subject, predicate, object, lang of N-Triples; a literal without its quotes and escapes, a resource without its brackets."""
    form = r"^(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(?:<([^>]*)>|(_:\S+)|\"((?:[^\"\\]|\\.)*)\"(?:@([A-Za-z0-9-]+)|\^\^<[^>]*>)?)\s*\.\s*$"
    rows = lines(spark, path).where(F.col("line").rlike(form))
    part = lambda k: F.regexp_extract("line", form, k)
    literal = F.from_json(F.concat(F.lit('["'), F.regexp_replace(part(5), r"\\U0000([0-9A-Fa-f]{4})", r"\\u$1"), F.lit('"]')), "ARRAY<STRING>")[0]  # the escapes of JSON
    is_literal = (part(3) == "") & (part(4) == "")
    return rows.select(F.regexp_replace(part(1), "^<|>$", "").alias("subject"), part(2).alias("predicate"), F.when(is_literal, literal).otherwise(F.concat(part(3), part(4))).alias("object"), F.nullif(part(6), F.lit("")).alias("lang"))


def search_index(spark: SparkSession, path: str) -> DataFrame:
    """document, title of a manual's search index: JSON with docnames and titles as the argument of one call; a file is one row."""
    raw = spark.read.option("wholetext", "true").text(path)
    r = F.from_json(F.regexp_extract("value", r"(?s)^[^{]*(\{.*\})[^}]*$", 1), "docnames ARRAY<STRING>, titles ARRAY<STRING>")
    return raw.select(F.explode(F.arrays_zip(r["docnames"].alias("document"), r["titles"].alias("title"))).alias("x")).select("x.*")

"""Queries of scans and sinks: tables go out in their text form, to the shared folder, and are read back whole."""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from wordloom.functions import keys
from wordloom.functions.bounded import shared_folder
from wordloom.operators import admission, fragments, transitions, variants
from wordloom.plans.catalogue import _A, _ACC, _BASE, _CONV, _FRAG, _LEX, _ROWS, _RULES, _TOK, _WC, lex, query, scored, table, tok, word_counts
from wordloom.sources import readers, writers

_LINES = r"ln AS (SELECT doc_id, coalesce(lang, 'none') AS domain, unnest(regexp_split_to_array(coalesce(text, ''), '\r\n|\n|\r')) AS line FROM documents)"


def folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"WITH {_LEX} SELECT reading AS key, reading, text, weight FROM lex")
def dictionary_strict_scan(spark, d):
    path = folder(spark, "dictionary")
    writers.sorted_table(lex(spark, d), path, ["reading", "text", "weight"], [F.desc("weight"), "reading", "text"])
    return readers.dictionary_strict(spark, path).select("key", "reading", "text", "weight")


@query(f"WITH {_LEX} SELECT text, reading, 1 AS rank FROM lex WHERE length(text) = length(reading) AND weight > 0")
def dictionary_lenient_scan(spark, d):
    path = folder(spark, "dictionary")
    rows = lex(spark, d).withColumn("reading", F.regexp_replace("reading", "(?<=.)(?=.)", "'"))
    writers.sorted_table(rows, path, ["reading", "text", "weight"], ["reading", "text"])
    return readers.dictionary_lenient(spark, path).select("text", F.array_join("syllables", "").alias("reading"), "rank")


@query(f"WITH {_WC} SELECT text, n FROM wc")
def count_table_scan(spark, d):
    path = folder(spark, "counts")
    writers.sorted_table(word_counts(spark, d), path, ["text", "n"], ["text"], header=["words", "of all documents"])
    return readers.counts(spark, [path, f"{path}.header"])


@query(f"WITH {_CONV}, c AS (SELECT word AS text, count(*) AS n FROM ctok GROUP BY 1) SELECT text, n, round(n / (SELECT sum(n) FROM c), 9) AS share FROM c")
def chat_count_scan(spark, d):
    words = table(spark, d, "conversations").select(F.explode(keys.words(F.col("text"))).alias("text")).groupBy("text").agg(F.count("*").alias("n"))
    path, head = folder(spark, "chat"), F.lit(1 << 62)
    total = words.agg(F.lit("total").alias("text"), F.sum("n").alias("n")).withColumn("o", head)
    rows = words.withColumn("o", F.col("n")).unionByName(total).repartition(1).sortWithinPartitions(F.desc("o"), "text")  # a word list: one file, its first line first
    rows.select(F.concat_ws("\t", "text", F.col("n").cast("string")).alias("value")).write.text(path)
    out, n = readers.counts_with_total(spark, path)
    return out.where("text <> 'total'").withColumn("share", F.round(F.col("n") / F.lit(n), 9))


@query(f"WITH {_WC} SELECT text FROM wc WHERE length(text) BETWEEN 2 AND 8")
def word_sets(spark, d):
    return readers.word_set(word_counts(spark, d), 2, 8)


@query(f"WITH {_LINES} SELECT domain, count(*) AS lines, sum(length(line))::BIGINT AS characters FROM ln GROUP BY 1")
def text_corpus_scan(spark, d):
    path = folder(spark, "corpus")
    docs = table(spark, d, "documents").select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("none")).alias("lang"))
    docs.write.partitionBy("lang").text(path)
    rows = readers.text_corpus(spark, path).withColumn("domain", F.regexp_replace("domain", "^lang=", ""))
    return rows.groupBy("domain").agg(F.count("*").alias("lines"), F.sum(F.length("text")).alias("characters"))


@query(f"WITH {_LINES} SELECT count(*) AS n FROM ln")
def row_counts_of_files(spark, d):
    path = folder(spark, "corpus")
    table(spark, d, "documents").select(F.coalesce("text", F.lit("")).alias("text")).write.text(path)
    return readers.row_counts(spark, path).agg(F.sum("n").alias("n"))


@query("SELECT md5(text) AS digest, count(*) AS n FROM documents WHERE text <> '' GROUP BY 1")
def json_corpus_scan(spark, d):
    path = folder(spark, "fragments")
    writers.json_fragments(table(spark, d, "documents").select(F.col("source"), "text"), path)
    return readers.json_corpus(spark, path).groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.count("*").alias("n"))


@query("SELECT doc_id::VARCHAR AS id, coalesce(source, 'none') AS source, length(text) AS characters FROM documents WHERE text <> ''")
def json_document_scan(spark, d):
    path = folder(spark, "documents")
    docs = table(spark, d, "documents")
    even = F.col("doc_id") % 2 == 0  # either name of each field
    docs.select(F.when(even, F.col("text")).alias("text"), F.when(~even, F.col("text")).alias("content"), F.coalesce("source", F.lit("none")).alias("dataset"), F.when(even, F.col("doc_id").cast("string")).alias("id"), F.when(~even, F.col("doc_id").cast("string")).alias("doc_hash")).write.option("compression", "gzip").json(path)
    return readers.json_documents(spark, path).select("id", "source", F.length("text").cast("long").alias("characters"))


def zipped(df):
    """path, content: a zip archive for each row (name, text)."""

    def run(batches):
        for batch in batches:
            out = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = io.BytesIO()
                with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(f"{name}.txt", text or "")
                    z.writestr(f"{name}.md", "left out")
                out.append(raw.getvalue())
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], names=["path", "content"])

    return df.select(F.col("name").cast("string").alias("name"), "text").mapInArrow(run, "path string, content binary")


@query("SELECT item_id, text FROM benchmark WHERE text <> ''")
def zip_member_scan(spark, d):
    files = zipped(table(spark, d, "benchmark").select(F.col("item_id").alias("name"), "text"))
    parts = readers.zip_members(files, chunk=64)
    whole = parts.groupBy("source").agg(F.expr("listagg(text, '') WITHIN GROUP (ORDER BY part)").alias("text"))
    return whole.select(F.regexp_extract("source", r"^(\d+)!", 1).cast("long").alias("item_id"), "text")


@query("SELECT n_name AS text, n_nationkey::BIGINT AS n FROM nation")
def pinned_archive_scan(spark, d):
    rows = [f"{r.n_name}  {r.n_nationkey}" for r in table(spark, d, "nation").orderBy("n_nationkey").collect()]  # 25 rows at every scale
    one = spark.createDataFrame([("nations", "\r\n".join(["no number here", *rows]))], "name string, text string")
    files = zipped(one)
    kept = spark.createDataFrame([tuple(r) for r in files.collect()], files.schema)  # a zip holds its time: made once
    digest = hashlib.sha256(kept.first().content).hexdigest()
    return readers.pinned(kept, digest, suffix=".txt")


@query(f"WITH {_LEX} SELECT reverse(text) AS traditional, text AS simplified, reading FROM lex")
def cedict_scan(spark, d):
    path = folder(spark, "cedict")
    rows = lex(spark, d).select(F.concat(F.reverse("text"), F.lit(" "), F.col("text"), F.lit(" ["), F.col("reading"), F.lit("] /gloss/")).alias("value"))
    rows.unionByName(spark.createDataFrame([("# comment",), ("no entry",)], "value string")).write.option("compression", "gzip").text(path)
    return readers.cedict(spark, path).select("traditional", "simplified", "reading")


@query("SELECT c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey END::BIGINT AS links FROM customer")
def remote_bindings_scan(spark, d):
    v = lambda c: F.struct(c.cast("string").alias("value"))
    c = table(spark, d, "customer")
    b = F.struct(v(F.col("c_name")).alias("name"), v(F.when(F.col("c_custkey") % 3 == 0, F.lit("no number")).otherwise(F.col("c_custkey").cast("string"))).alias("links"))
    pages = c.groupBy(F.expr("c_custkey div 500").alias("p")).agg(F.to_json(F.struct(F.struct(F.collect_list(b).alias("bindings")).alias("results"))).alias("page"))
    return readers.bindings(pages, ["name"], ["links"])


@query("SELECT p_name AS term, p_brand AS layer, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE '' END AS note FROM part")
def manifest_rows_scan(spark, d):
    path = folder(spark, "manifest")
    p = table(spark, d, "part")
    rows = p.select(F.concat_ws("\t", "p_name", "p_brand", F.when(F.col("p_partkey") % 2 == 0, F.col("p_type"))).alias("value"))
    rows.unionByName(spark.createDataFrame([("# comment",), ("",)], "value string")).write.text(path)
    return readers.ragged(spark, path, ["term", "layer", "note"]).drop("ord").fillna({"note": ""})


@query("SELECT DISTINCT text FROM (SELECT p_name AS text FROM part UNION ALL SELECT p_brand FROM part) WHERE text <> ''")
def existing_terms_scan(spark, d):
    p = table(spark, d, "part").select(F.concat(F.lit(" "), "p_name", F.lit("　")).alias("a"), F.when(F.col("p_size") > 0, F.col("p_brand")).otherwise(F.col("p_brand")).alias("b"))
    return readers.existing_terms(p.unionByName(p.select(F.lit("  ").alias("a"), "b")), "a", "b")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, sum(contains(event_type, 'signup')::INT - contains(event_type, 'error')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS depth FROM events) WHERE depth = 1 AND NOT contains(event_type, 'signup')")
def marked_block_scan(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("file"), F.col("event_id").alias("ord"), F.col("event_type").alias("line"))
    return readers.marked_block(e, "signup", "error").select(F.col("file").alias("user_id"), F.col("ord").alias("event_id"), F.col("line").alias("event_type"))


@query("SELECT source, doc_id FROM (SELECT coalesce(source, '') AS source, doc_id, sum(length(text)) OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) AS s FROM documents) WHERE s <= 100000")
def budgeted_scan(spark, d):
    """The budget is the feature: each input is read up to it."""
    docs = table(spark, d, "documents").select(F.coalesce("source", F.lit("")).alias("source"), F.col("doc_id").alias("ord"), "text")
    return readers.within_budget(docs, 100_000).select("source", F.col("ord").alias("doc_id"))


_INDEX = _ROWS.format(k=24).rsplit("SELECT", 1)[0]


@query(_BASE + _INDEX + "SELECT array_to_string(anchor, '|') AS anchor, array_to_string(syl, '''') AS reading, array_to_string(suffix, '') AS text, array_to_string(suffix, '|') AS path, evidence::INT AS evidence, sources::INT AS sources, 1 AS visible FROM o")
def index_text_rows(spark, d):
    paths = scored(spark, d, 2, 3).select("words", "syl", "evidence", "source_count")
    return writers.index_rows(transitions.completions(paths, 24).withColumn("visible", F.lit(True)))


@query(f"WITH {_LEX} SELECT 'same' AS versions, false AS changed UNION ALL SELECT 'fewer', (SELECT count(*) > 0 FROM lex WHERE n = 1)")
def publish_if_changed(spark, d):
    x = lex(spark, d).select("reading", "text", "weight", "n")
    cases = [("same", writers.changed(x, x.select("*"))), ("fewer", writers.changed(x, x.where("n > 1")))]
    return spark.createDataFrame(cases, "versions string, changed boolean")


@query(f"""WITH {_LEX}, p AS (SELECT reading, text, weight * 3 % 1001 AS ord FROM lex WHERE n >= 3) SELECT l.reading, l.text, l.weight, coalesce(p.ord, 4611686018427387904)::BIGINT AS place, CASE WHEN l.text LIKE '%e' THEN 'no_contains' ELSE '' END AS scope
FROM lex l LEFT JOIN p ON l.reading = p.reading AND l.text = p.text WHERE l.text NOT LIKE 'th%'""")
def dictionary_in_order(spark, d):
    x = lex(spark, d)
    previous = x.where("n >= 3").select("reading", "text", (F.col("weight") * 3 % 1001).alias("ord"))
    out = writers.keep_order(previous, x.select("reading", "text", "weight"), x.where("text LIKE 'th%'"), x.where("text LIKE '%e'"))
    return out.select("reading", "text", "weight", "place", F.coalesce("scope", F.lit("")).alias("scope"))


@query(f"WITH {_FRAG} SELECT count(*) AS fragments, sum(length(chunk))::BIGINT AS characters, count(DISTINCT doc_id) AS documents FROM f")
def stage_counters(spark, d):
    chunks = fragments.chunks(table(spark, d, "documents"), keys.LATIN, ["doc_id"])
    path = folder(spark, "fragments")
    seen = writers.observed(chunks, lambda df: df.select("doc_id", "chunk").write.parquet(path), fragments=F.count("*"), characters=F.sum(F.length("chunk")))
    docs = spark.read.parquet(path).select("doc_id").distinct().count()
    return spark.createDataFrame([(seen["fragments"], seen["characters"] or 0, docs)], "fragments long, characters long, documents long")


@query(rf"""WITH {_TOK}, t AS (SELECT DISTINCT word AS text, lang AS category FROM tok),
r AS (SELECT text, category, CASE WHEN NOT regexp_matches(text, '^\p{{L}}{{4,14}}$') THEN 'length_or_script' WHEN text LIKE 'th%' OR text LIKE '%ing' THEN 'fragment' WHEN text LIKE '%tion' THEN 'organization_label'
 WHEN category = 'de' AND NOT (contains(text, 'e') OR contains(text, 'u')) THEN 'de_domain_mismatch' WHEN category = 'fr' AND text LIKE '%oi' THEN 'publication_title' WHEN category = 'es' AND contains(text, 'ñ') THEN 'fiction_label'
 WHEN category = 'es' AND NOT (text LIKE '%a' OR text LIKE '%o' OR text LIKE '%s') THEN 'es_domain_mismatch' ELSE '' END AS reason FROM t) SELECT text, coalesce(category, '') AS category, reason FROM r WHERE reason <> ''""")
def review_queue(spark, d):
    t = tok(spark, d).select(F.col("word").alias("text"), F.col("lang").alias("category")).distinct()
    rows = writers.review_queue(t.withColumn("reason", admission.reason(F.col("text"), F.col("category"), _RULES)))
    return rows.fillna({"category": ""})


@query(f"WITH {_LINES} SELECT doc_id, length(line) AS characters, count(*) AS n FROM ln WHERE length(replace(line, 'ß', 'ss')) = length(line) GROUP BY ALL")
def aligned_lines(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), r"\r\n|\n|\r")).alias("line"))
    out = variants.same_length(lines, "line", F.replace("line", F.lit("ß"), F.lit("ss")))
    return out.groupBy("doc_id", F.length("line").cast("long").alias("characters")).agg(F.count("*").alias("n"))


_B2 = "".join(_ACC.values())


@query(f"WITH {_LEX} SELECT text, CASE WHEN length(text) >= 2 THEN translate(text, '{_A}', '{_B2}') ELSE text END AS word, CASE WHEN length(text) >= 2 THEN translate(text, '{_A}', '{_B2}') ELSE text END || ':' || weight || '|' || 'é:3' AS listed, CASE WHEN length(reading || text) >= 2 THEN reading || '|' || translate(text, '{_A}', '{_B2}') ELSE reading || '|' || text END AS path FROM lex")
def converted_forms(spark, d):
    x, t = lex(spark, d), F.col("text")
    listed = keys.mapped_weights(F.concat(t, F.lit(":"), F.col("weight").cast("string"), F.lit("|é:3")), _ACC)
    return x.select("text", keys.mapped_chars(t, _ACC).alias("word"), listed.alias("listed"), keys.mapped_path(F.concat_ws("|", "reading", t), _ACC).alias("path"))


@query(f"WITH {_LEX} SELECT text, n % 2 = 1 AND translate(text, '{_A}', '{_B2}') <> text AS repaired, CASE WHEN n % 2 = 1 THEN translate(text, '{_A}', '{_B2}') ELSE 'own' END AS other FROM lex")
def repaired_column(spark, d):
    rows = lex(spark, d).select("text", F.when(F.col("n") % 2 == 1, F.col("text")).otherwise("own").alias("other"))
    return variants.repaired(rows, "text", "other", F.translate("text", _A, _B2)).select("text", "repaired", "other")


@query(r"SELECT c_custkey, regexp_matches(c_name, '^[\p{L}#0-9]{2,18}$') AS is_name, CASE WHEN length(c_name) <= 4 THEN 40 ELSE 20 END AS weight FROM customer")
def name_filter(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", keys.is_name(F.col("c_name"), keys.UnitProfile(r"\p{L}#0-9"), 2, 18).alias("is_name"), keys.length_weight(F.col("c_name")).alias("weight"))


@query(r"WITH s AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[aeinorst]+')) AS stretch FROM documents) SELECT stretch, count(*) AS n, count(DISTINCT doc_id) AS documents FROM s GROUP BY 1")
def alphabet_stretches(spark, d):
    s = table(spark, d, "documents").select("doc_id", F.explode(keys.stretches(F.lower("text"), "aeinorst")).alias("stretch"))
    return s.groupBy("stretch").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("documents"))

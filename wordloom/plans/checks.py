"""Queries of validators, audited orders, path priors and corpus counters over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom.functions import keys
from wordloom.functions.bounded import stored
from wordloom.operators import fragments, query_paths, single_char, validation
from wordloom.plans.catalogue import _BASE, _FRAG, _LEX, _TOK, ORACLES, lex, query, scored, table, transition_completion
from wordloom.plans.curated import counted
from wordloom.plans.exchange import folder
from wordloom.sources import readers, remote, writers

_EST = f"{_LEX}, es AS (SELECT reading, text AS char, weight / 1000.0 AS rate, row_number() OVER (PARTITION BY reading ORDER BY weight DESC, text) AS k, count(*) OVER (PARTITION BY reading) AS size FROM lex)"


@query(f"WITH {_EST}, sm AS (SELECT reading, char, 1 + length(char) % (size - 1) AS most FROM es WHERE k = size AND size > 1), up AS (SELECT sm.reading, sm.char, es.rate * (1 + 1e-9) + 1e-12 AS rate FROM sm JOIN es ON es.reading = sm.reading AND es.k = sm.most) SELECT es.reading, es.char, round(coalesce(up.rate, es.rate) * 1e6, 2) AS rate FROM es LEFT JOIN up ON es.reading = up.reading AND es.char = up.char")
def sample_lifts(spark, d):
    """The last of each reading's characters is a sample that must come within a rank."""
    x = lex(spark, d)
    rows = x.select("reading", F.col("text").alias("char"), (F.col("weight") / 1000).alias("rate"))
    last = x.groupBy("reading").agg(F.count("*").alias("size"), F.max(F.struct((-F.col("weight")).alias("w"), "text")).alias("m")).where("size > 1")
    samples = last.select("reading", F.col("m.text").alias("char"), (1 + F.length("m.text") % (F.col("size") - 1)).cast("int").alias("max_rank"))
    return single_char.lifted(rows, samples).select("reading", "char", F.round(F.col("rate") * 1e6, 2).alias("rate"))


@query(f"""WITH {_LEX}, x AS (SELECT reading, text, weight, row_number() OVER (PARTITION BY reading ORDER BY text) AS k FROM lex), g AS (SELECT reading, max(weight) FILTER (k <= 2) AS top, max(weight) FILTER (k = 2) AS w2, count(*) AS size FROM x GROUP BY 1),
lo AS (SELECT x.reading, max(x.weight) AS lower FROM x JOIN g USING (reading) WHERE k > 2 AND x.weight < top GROUP BY 1)
SELECT x.reading, x.text AS char, CASE WHEN size < 2 OR k > 2 THEN x.weight WHEN k = 1 THEN top WHEN w2 >= top THEN round_even((top + coalesce(lower, 0)) / 2.0, 0)::BIGINT ELSE x.weight END AS weight FROM x JOIN g USING (reading) LEFT JOIN lo USING (reading)""")
def shared_form_order(spark, d):
    """Of each reading the first two texts, by code points, share a character: the first leads."""
    x = lex(spark, d)
    first = x.groupBy("reading").agg(F.array_sort(F.collect_set("text")).alias("t")).where(F.size("t") > 1)
    forms = first.select("reading", F.explode(F.slice("t", 1, 2)).alias("char"), F.col("t")[0].alias("leader"))
    forms = forms.withColumn("estimate", F.lit(1.0) / F.length("char"))
    return single_char.led(x.select("reading", F.col("text").alias("char"), "weight"), forms)


@query(f"WITH tc AS ({ORACLES['transition_completion']}) SELECT rule, n FROM (SELECT 'evidence' AS rule, count(*) FILTER (rank = 1) AS n FROM tc UNION ALL SELECT 'prefix', count(*) FILTER (rank = 2) FROM tc UNION ALL SELECT 'path', count(*) FILTER (rank = 3) FROM tc UNION ALL SELECT 'not_unique', 2 * count(*) FILTER (rank = 4) FROM tc) WHERE n > 0")
def transition_completion_violations(spark, d):
    """The completion rows with a fault in each of the first four ranks: counts, prefixes, paths, rows twice."""
    rows, r = stored(transition_completion(spark, d)), F.col("rank")  # once as it is, once for the rows twice
    rows = rows.withColumns({"evidence": F.when(r == 1, 0).otherwise(F.col("evidence")), "prefix": F.when(r == 2, F.concat("reading", "prefix")).otherwise(F.col("prefix")), "path": F.when(r == 3, F.concat("path", F.lit("x"))).otherwise(F.col("path"))})
    return counted(validation.transition_completion(rows.unionByName(rows.where(r == 4)).drop("rank"), most=99))


@query("SELECT p_partkey, p_type || '-' || p_brand || ' 1.0' AS license FROM part WHERE p_type IN ('PROMO', 'ECONOMY')")
def barred_licences(spark, d):
    """Parts as sources, their types and brands as licences, two types as barred tokens."""
    manifest = table(spark, d, "part").select("p_partkey", F.concat("p_type", F.lit("-"), "p_brand", F.lit(" 1.0")).alias("license"))
    return validation.barred_sources(manifest, ("promo", "economy"))


@query("WITH n AS (SELECT DISTINCT event_type || '/' || user_id || CASE WHEN user_id % 7 = 0 THEN '.zip' ELSE '.tsv' END AS name FROM events), q AS (SELECT DISTINCT 'view/' || c_custkey || '.tsv' AS name FROM customer) SELECT 'missing' AS rule, name FROM q WHERE name NOT IN (SELECT name FROM n) UNION ALL SELECT 'forbidden', name FROM n WHERE name LIKE '%.zip' OR name LIKE 'error/%'")
def published_files(spark, d):
    """Names made of events; one for each customer is required, archives and errors are barred."""
    e = table(spark, d, "events")
    names = e.select(F.concat("event_type", F.lit("/"), "user_id", F.when(F.col("user_id") % 7 == 0, ".zip").otherwise(".tsv")).alias("name")).distinct()
    required = table(spark, d, "customer").select(F.concat(F.lit("view/"), "c_custkey", F.lit(".tsv")).alias("name")).distinct()
    return validation.published(names, required, ["*.zip", "error/*"])


_PN = """pt AS (SELECT words, evidence FROM s2 WHERE n >= 3 UNION ALL SELECT words, evidence FROM s3 WHERE n >= 3), nd AS (SELECT regexp_replace(array_to_string(words[1:a], ''), '[^a-z]', '', 'g') AS reading, words[1:a] AS path, a = len(words) AS ends, evidence FROM (SELECT *, unnest(generate_series(1, len(words))) AS a FROM pt)),
no AS (SELECT reading, path, bool_or(ends) AS f, sum((NOT ends)::INT) AS through, sum(evidence) AS e FROM nd GROUP BY 1, 2), kp AS (SELECT *, sum(e) OVER (PARTITION BY reading) AS total, row_number() OVER (PARTITION BY reading ORDER BY e DESC, path) AS rank FROM no WHERE reading <> '' AND (f OR through >= 2))"""


@query(f"{_BASE}, {_PN} SELECT reading, array_to_string(path, '|') AS path, CASE WHEN f THEN 'full' ELSE 'prefix' END AS kind, rank::INT AS rank, greatest(1, round(1000 * e / total))::INT AS prior FROM kp WHERE rank <= 8")
def query_path_priors(spark, d):
    """Priors of the scored pairs and triples and of their beginnings."""
    out = query_paths.query_path_priors(_scored_paths(spark, d))
    return out.select("reading", F.concat_ws("|", "path").alias("path"), "kind", "rank", "prior")


def _scored_paths(spark, d):
    paths = scored(spark, d, 2, 3).select("words", "evidence")
    return paths.withColumn("syl", F.transform("words", lambda w: F.array(keys.latin_reading(w))))


@query(f"WITH {_FRAG}, m AS (SELECT r.r, trim(s.s) <> r.r AS mixed FROM r JOIN s USING (doc_id, sentence) WHERE length(r.r) >= 8), h AS (SELECT count(*) AS n FROM (SELECT DISTINCT coalesce(lang, 'none') FROM documents)) SELECT count(*) AS runs, count(*) FILTER (mixed) AS salvaged_mixed_fragments, count(*) FILTER (length(r) > 40) AS split_long_runs, sum(length(r))::BIGINT AS units, (SELECT n FROM h) AS skipped_holdout_files FROM m")
def sentence_stream_counters(spark, d):
    """Documents as JSON lines of one folder a language, each with a held-out file beside them, which is counted and not read."""
    path, docs = folder(spark, "sentences"), table(spark, d, "documents")
    held = docs.select(F.coalesce("lang", F.lit("none")).alias("domain")).distinct()
    writers.json_fragments(docs.where("text <> ''").select(F.col("source"), "text"), f"{path}/train")
    for k, r in enumerate(sorted(x.domain for x in held.collect())):  # a few languages
        remote.publish(f"{path}/{k}-{r}/validation.jsonl", b'{"text": "must not be read here at all"}')
    n = readers.held_out(spark, path).count()
    rows = readers.json_corpus(spark, path)
    return fragments.stream_counters(rows, keys.LATIN).withColumn("skipped_holdout_files", F.lit(n).cast("long"))


@query(f"WITH {_TOK} SELECT lang AS text, count(*) AS n, count(*) = (SELECT count(*) FROM tok) AS whole FROM tok WHERE lang IS NOT NULL GROUP BY 1")
def total_line_scan(spark, d):
    """A count table of which the total stands in a first line of its own: that line is written as a file that sorts first."""
    words = table(spark, d, "documents").where("lang IS NOT NULL").select("lang", F.explode(keys.words(F.col("text"))).alias("w")).groupBy(F.col("lang").alias("text")).agg(F.count("*").alias("n"))
    path = folder(spark, "total")
    words.select(F.concat_ws("\t", "text", F.col("n").cast("string")).alias("value")).write.text(f"{path}/counts")
    total = table(spark, d, "documents").select(F.sum(F.size(keys.words(F.col("text")))).alias("n"))
    total.select(F.concat(F.lit("total\t"), F.col("n").cast("string")).alias("value")).write.text(f"{path}/a-total")
    out, n = readers.counts_with_total(spark, path)
    return out.where("text <> 'total'").withColumn("whole", F.col("n") == n)

"""Queries of the lexicon and corpus-statistics operators over the driver tables, and the SQL each must agree with.

Documents stand for a corpus (source: document, domain: language); words are runs of letters, readings their ASCII letters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import keys
from wordloom.functions.bounded import stored
from wordloom.operators import admission, blocks, completion, counting, curation, evaluation, fragments, frequent, lexicon, patterns, segmentation, single_char, transitions, validation, variants
from wordloom.sources.readers import columnar
from wordloom.streaming import incremental

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return columnar(spark, f"{d.rstrip('/')}/{name}.parquet")


# --- shared views, in both languages -------------------------------------------------------------

_TOK = r"tok AS (SELECT doc_id, lang, i AS pos, w[i] AS word FROM (SELECT doc_id, lang, w, unnest(generate_series(1, len(w))) AS i FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents)))"
_WC = f"{_TOK}, wc AS (SELECT word AS text, count(*) AS n FROM tok GROUP BY 1)"
_LEX = f"{_WC}, lex AS (SELECT regexp_replace(text, '[^a-z]', '', 'g') AS reading, text, round(100 * log10(1 + n))::BIGINT AS weight, n FROM wc WHERE regexp_replace(text, '[^a-z]', '', 'g') <> '')"


def tok(spark, d):
    return counting.tokens(table(spark, d, "documents"), ["doc_id", "lang"])


def word_counts(spark, d):
    return tok(spark, d).groupBy(F.col("word").alias("text")).agg(F.count("*").alias("n"))


def lex(spark, d, counts=None):
    return (word_counts(spark, d) if counts is None else counts).select(keys.latin_reading(F.col("text")).alias("reading"), "text", keys.log_score(F.col("n")).alias("weight"), "n").where("reading <> ''")


@query(r"SELECT char, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '\p{L}')) AS char FROM documents) GROUP BY 1")
def char_frequency(spark, d):
    return counting.char_counts(table(spark, d, "documents"))


@query(f"WITH {_WC} SELECT text, n, round(100 * log10(1 + n))::BIGINT AS score FROM wc")
def word_frequency_score(spark, d):
    return word_counts(spark, d).withColumn("score", keys.log_score(F.col("n")))


@query(f"WITH {_LEX} SELECT reading, text, weight, (row_number() OVER (PARTITION BY reading ORDER BY weight DESC, text))::INT AS rank FROM lex QUALIFY rank <= 3")
def homophone_top_k(spark, d):
    return lexicon.bucket_top(lex(spark, d).select("reading", "text", "weight"), 3)


_CONV = r"ctok AS (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM conversations), clex AS (SELECT regexp_replace(word, '[^a-z]', '', 'g') AS reading, word AS text, round(100 * log10(1 + count(*)))::BIGINT AS weight FROM ctok GROUP BY word)"


@query(f"WITH {_LEX}, {_CONV} SELECT reading, text, max(weight) AS weight FROM (SELECT reading, text, weight FROM lex UNION ALL SELECT * FROM clex WHERE reading <> '') GROUP BY 1, 2")
def merged_dictionary_max_weight(spark, d):
    chat = counting.tokens(table(spark, d, "conversations"), ["conv_id"]).groupBy(F.col("word").alias("text")).agg(F.count("*").alias("n"))
    chat = chat.select(keys.latin_reading(F.col("text")).alias("reading"), "text", keys.log_score(F.col("n")).alias("weight")).where("reading <> ''")
    return lexicon.max_weight(lex(spark, d), chat)


_SAMPLES = r"s AS (SELECT DISTINCT regexp_replace(word, '[^a-z]', '', 'g') AS reading, word AS text, length(word) % 5 = 0 AS forbidden, 1 AS max_rank FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM benchmark) WHERE regexp_replace(word, '[^a-z]', '', 'g') <> '')"


@query(f"""WITH {_LEX}, {_SAMPLES}, r AS (SELECT reading, text, (row_number() OVER (PARTITION BY reading ORDER BY weight DESC, text))::INT AS rank FROM lex),
sh AS (SELECT reading, string_agg(text, ', ' ORDER BY rank) AS shown FROM r WHERE rank <= 5 GROUP BY 1),
x AS (SELECT s.reading, s.text, forbidden, max_rank, rank, shown FROM s LEFT JOIN r ON s.reading = r.reading AND s.text = r.text LEFT JOIN sh ON s.reading = sh.reading)
SELECT * FROM (SELECT reading, text, CASE WHEN forbidden AND rank IS NOT NULL THEN 'forbidden_present' WHEN forbidden THEN NULL WHEN shown IS NULL THEN 'no_candidates' WHEN rank IS NULL THEN 'missing' WHEN rank > max_rank THEN 'rank_exceeded' END AS problem, coalesce(rank, 0) AS rank, coalesce(shown, '') AS shown FROM x) WHERE problem IS NOT NULL""")
def regression_rank_check(spark, d):
    s = counting.tokens(table(spark, d, "benchmark"), ["item_id"]).select(keys.latin_reading(F.col("word")).alias("reading"), F.col("word").alias("text")).where("reading <> ''").distinct()
    return lexicon.regressions(lex(spark, d), s.withColumns({"forbidden": F.length("text") % 5 == 0, "max_rank": F.lit(1)})).fillna({"rank": 0, "shown": ""})


_FRAG = r"""s AS (SELECT doc_id, i - 1 AS sentence, p[i] AS s FROM (SELECT doc_id, p, unnest(generate_series(1, len(p))) AS i FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?;,:|\n\r\t]+') AS p FROM documents))),
r AS (SELECT doc_id, sentence, i - 1 AS run, x[i] AS r FROM (SELECT doc_id, sentence, x, unnest(generate_series(1, len(x))) AS i FROM (SELECT doc_id, sentence, regexp_extract_all(trim(s), '[\p{L} ]+') AS x FROM s))),
c AS (SELECT doc_id, sentence, run, (p0 / 36)::INT AS part, substring(r, p0 + 1, 40) AS chunk FROM (SELECT *, unnest(generate_series(0, CASE WHEN length(r) <= 40 THEN 0 ELSE length(r) - 8 END, 36)) AS p0 FROM r WHERE length(r) >= 8)),
f AS (SELECT * FROM c WHERE NOT (length(chunk) >= 8 AND list_max(list_transform(list_distinct(string_split(chunk, '')), lambda y: length(chunk) - length(replace(chunk, y, '')))) * 100 >= length(chunk) * 55))"""


@query(f"WITH {_FRAG} SELECT doc_id, sentence::INT AS sentence, run::INT AS run, part::INT AS part, chunk FROM f")
def fragment_chunks(spark, d):
    return fragments.chunks(table(spark, d, "documents"), keys.LATIN, ["doc_id"])


@query(f"WITH {_FRAG} SELECT chunk, first(doc_id ORDER BY doc_id, sentence, run, part) AS doc_id, count(*) AS copies FROM f GROUP BY 1")
def fragment_dedupe_first(spark, d):
    return fragments.first_of_equal(fragment_chunks(spark, d), "chunk", ["doc_id", "sentence", "run", "part"]).select("chunk", "doc_id", "copies")


@query("SELECT conv_id, turn, text AS said FROM conversations WHERE role = 'user' AND text <> ''")
def chat_record_text(spark, d):
    c = table(spark, d, "conversations").where("role = 'user'")
    record = F.to_json(F.struct(F.array(F.struct("role", F.col("text").alias("content"))).alias("messages")))
    return c.select("conv_id", "turn", F.explode(keys.record_text(record)).alias("said"))


_CC = r"cc AS (SELECT char, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}')) AS char FROM documents) GROUP BY 1)"
_IN = "ins AS (SELECT char, sum(n) AS inside FROM (SELECT unnest(string_split(text, '')) AS char, n FROM wc WHERE length(text) >= 2) GROUP BY 1)"


@query(f"WITH {_WC}, {_CC}, {_IN} SELECT char, n, greatest(0, n - coalesce(inside, 0))::BIGINT AS alone, round(sqrt(n * greatest(0, n - coalesce(inside, 0))) / 1e6 * 1e8, 3) AS rate FROM cc LEFT JOIN ins USING (char)")
def standalone_char_counts(spark, d):
    chars = counting.char_counts(table(spark, d, "documents").select(F.lower("text").alias("text")))
    rows = counting.standalone(chars, word_counts(spark, d))
    return rows.join(counting.use_rate(rows, 1e6), "char").withColumn("rate", F.round("rate", 3))


_ACC = {"é": "e", "è": "e", "ê": "e", "ü": "u", "ö": "o", "ä": "a", "ó": "o", "í": "i", "ñ": "n", "ç": "c"}
_A, _B = "".join(_ACC), "".join(_ACC.values())


@query(f"WITH {_WC}, {_CC}, {_IN}, u AS (SELECT translate(char, '{_A}', '{_B}') AS simplified, char AS traditional, coalesce(inside, 0)::BIGINT AS inside, greatest(0, n - coalesce(inside, 0))::BIGINT AS alone FROM cc LEFT JOIN ins USING (char)), v AS (SELECT *, sqrt((inside + alone)::DOUBLE * alone) AS use FROM u) SELECT simplified, traditional, inside, alone, round(use / sum(use) OVER (PARTITION BY simplified), 6) AS share FROM v QUALIFY sum(use) OVER (PARTITION BY simplified) > 0")
def variant_share(spark, d):
    chars = counting.char_counts(table(spark, d, "documents").select(F.lower("text").alias("text")))
    rows = counting.standalone(chars, word_counts(spark, d)).join(counting.inside_counts(word_counts(spark, d)), "char", "left")
    rows = rows.select(F.translate("char", _A, _B).alias("simplified"), F.col("char").alias("traditional"), F.coalesce("inside", F.lit(0)).cast("long").alias("inside"), "alone")
    return counting.form_shares(rows).withColumn("share", F.round("share", 6))


_G = "g{n} AS (SELECT doc_id, lang, {cols} AS gram FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY pos) QUALIFY lead(word, {k}) OVER w IS NOT NULL)"
_G2 = _G.format(n=2, k=1, cols="[word, lead(word) OVER w]")
_G3 = _G.format(n=3, k=2, cols="[word, lead(word) OVER w, lead(word, 2) OVER w]")
_EV = "e{n} AS (SELECT gram, least(count(*), 1000000) AS n, least(count(DISTINCT doc_id), 255) AS sources, count(DISTINCT lang) AS domains FROM g{n} GROUP BY 1)"


def texts_of_words(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", keys.words(F.col("text")).alias("words"))


def grams(spark, d, n):
    """path (words joined by |), n, sources, domains of all n-grams."""
    return transitions.gram_evidence(texts_of_words(spark, d), "doc_id", "lang", (n,)).withColumnRenamed("gram", "path")


def frequent_grams(spark, d, sizes, least):
    """The same of the n-grams of these sizes with ``least`` occurrences; rarer ones don't leave their texts."""
    docs = texts_of_words(spark, d)
    rows = transitions.gram_evidence(docs, "doc_id", "lang", sizes, frequent.marks(docs, sizes, least))
    return rows.withColumnRenamed("gram", "path").where(F.col("n") >= least)


@query(f"WITH {_TOK}, {_G2}, {_EV.format(n=2)} SELECT array_to_string(gram, '|') AS path, n, sources, domains FROM e2")
def bigram_evidence(spark, d):
    return grams(spark, d, 2)


@query(f"WITH {_TOK}, {_G3}, {_EV.format(n=3)} SELECT array_to_string(gram, '|') AS path, n, sources, domains FROM e3")
def trigram_evidence(spark, d):
    return grams(spark, d, 3)


_WT = "(380 + least(300, round(40 * log2(n)))::INT)"
_SC = """s{n} AS (SELECT gram AS words, n, sources, domains, w AS weight, strict AND w >= 430 AS visible,
 CASE WHEN NOT broad THEN least(559, w) WHEN strict AND w >= 430 THEN sc ELSE least(559, sc) END AS evidence, CASE WHEN broad THEN sources ELSE 1 END AS source_count
 FROM (SELECT *, w + least(96, round_even(log2(n + 1) * 12, 0)::INT) + least(60, 4 * sources) + least(36, 12 * domains) AS sc FROM
 (SELECT *, {wt} AS w, n >= 12 AND sources >= 5 AND domains >= 2 AS strict, n >= 3 AND sources >= 2 AND domains >= 1 AS broad FROM e{n})))"""


def scored(spark, d, *sizes, counts=None):
    """Scored paths of these sizes, in one reading of the texts; or of their counts, as from frequent_grams."""
    rows = (frequent_grams(spark, d, sizes, 3) if counts is None else counts).withColumn("words", F.split("path", r"\|")).where(F.size("words").isin(*sizes))
    weight = (380 + F.least(F.lit(300), F.round(40 * F.log2("n"))).cast("int")).alias("weight")
    return transitions.scored(rows.select("words", F.transform("words", lambda w: F.array(keys.latin_reading(w))).alias("syl"), "n", "sources", "domains", weight))


@query(f"WITH {_TOK}, {_G2}, {_EV.format(n=2)}, {_SC.format(n=2, wt=_WT)} SELECT array_to_string(words, '|') AS path, weight, evidence::INT AS evidence, source_count::INT AS source_count, visible FROM s2 WHERE n >= 3")
def evidence_gate_scores(spark, d):
    return scored(spark, d, 2).select(F.concat_ws("|", "words").alias("path"), "weight", "evidence", "source_count", "visible")


_BASE = f"WITH {_TOK}, {_G2}, {_EV.format(n=2)}, {_G3}, {_EV.format(n=3)}, {_SC.format(n=2, wt=_WT)}, {_SC.format(n=3, wt=_WT)}, p AS (SELECT words, evidence FROM s2 WHERE n >= 3 AND evidence >= 450)"


def pairs(s2):
    return s2.where("evidence >= 450").select("words", "syl", "evidence")


@query(_BASE + ", t AS (SELECT words, evidence FROM s3 WHERE n >= 3) , k AS MATERIALIZED (SELECT words[1] || '|' || words[2] AS w, evidence FROM p), u AS MATERIALIZED (SELECT array_to_string(words, '|') AS path, words[1] || '|' || words[2] AS a, words[2] || '|' || words[3] AS b, evidence FROM t) SELECT path, (least(l.evidence, r.evidence) + greatest(0, u.evidence - 360))::INT AS evidence FROM u JOIN k l ON u.a = l.w JOIN k r ON u.b = r.w")
def pair_backed_trigrams(spark, d):
    counts = stored(frequent_grams(spark, d, (2, 3), 3))  # read for the triples and either half
    p = pairs(scored(spark, d, 2, counts=counts))
    return transitions.pair_backed(scored(spark, d, 3, counts=counts), p).select(F.concat_ws("|", "words").alias("path"), "evidence")


@query(_BASE + """, t AS (SELECT words, evidence + 100 AS evidence FROM s3 WHERE n >= 3),
a AS (SELECT *, row_number() OVER (PARTITION BY words[2:3] ORDER BY evidence DESC, words) AS k FROM t QUALIFY k <= 6), b AS (SELECT *, row_number() OVER (PARTITION BY words[1:2] ORDER BY evidence DESC, words) AS k FROM t QUALIFY k <= 6)
SELECT array_to_string(list_append(a.words, b.words[3]), '|') AS path, (least(a.evidence, b.evidence) - 36)::INT AS evidence FROM a JOIN b ON a.words[2:3] = b.words[1:2] WHERE least(a.evidence, b.evidence) - 36 >= 560""")
def four_word_paths(spark, d):
    counts = stored(frequent_grams(spark, d, (3,), 3))  # read for either side
    t = scored(spark, d, 3, counts=counts).withColumn("evidence", F.col("evidence") + 100)
    return transitions.four_words(t).select(F.concat_ws("|", "words").alias("path"), "evidence")


_ROWS = """, x AS (SELECT *, unnest(generate_series(1, len(words) - 1)) AS a FROM (SELECT words, evidence, source_count FROM s2 WHERE n >= 3 UNION ALL SELECT words, evidence, source_count FROM s3 WHERE n >= 3)),
y AS (SELECT words[1:a] AS anchor, words[a + 1:] AS suffix, evidence + (a - 1) * 18 - (len(words) - a - 1) * 14 AS evidence, source_count AS sources FROM x),
z AS (SELECT anchor, array_to_string(suffix, '') AS text, list_transform(suffix, lambda w: regexp_replace(w, '[^a-z]', '', 'g')) AS syl, suffix, evidence, sources FROM y),
q AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY anchor, text, syl ORDER BY evidence DESC, len(suffix), sources DESC, suffix DESC) = 1),
o AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY evidence DESC, sources DESC, len(syl), suffix, syl) <= {k})
SELECT array_to_string(anchor, '|') AS anchor, array_to_string(suffix, '|') AS suffix, evidence::INT AS evidence, sources::INT AS sources FROM o"""


def _completions(spark, d, k):
    paths = scored(spark, d, 2, 3).select("words", "syl", "evidence", "source_count")
    return transitions.completions(paths, k).select(F.concat_ws("|", "anchor").alias("anchor"), F.concat_ws("|", "suffix").alias("suffix"), "evidence", "sources")


@query(_BASE + _ROWS.format(k=24))
def completion_rows_recall(spark, d):
    return _completions(spark, d, 24)


@query(_BASE + _ROWS.format(k=8))
def completion_rows_visible(spark, d):
    return _completions(spark, d, 8)


def _index_rows(name, lm, most):
    """The CTEs of the index rows over the paths of ``lm``: what completions() does, in SQL."""
    side = lambda p, at: f"{p}_{name} AS (SELECT * FROM {lm} WHERE len(words) = 3 QUALIFY row_number() OVER (PARTITION BY words[{at}:{at + 1}] ORDER BY evidence DESC, words) <= 6)"
    return f"""{side("l", 2)}, {side("r", 1)},
f_{name} AS (SELECT list_append(a.words, b.words[3]) AS words, least(a.evidence, b.evidence) - 36 AS evidence, 12 AS source_count FROM l_{name} a JOIN r_{name} b ON a.words[2:3] = b.words[1:2] WHERE least(a.evidence, b.evidence) - 36 >= 560),
x_{name} AS (SELECT *, unnest(generate_series(1, least(3, len(words) - 1))) AS a FROM (SELECT words, evidence, 12 AS source_count FROM s2 WHERE n >= 3 AND evidence >= 560 UNION ALL SELECT * FROM {lm} UNION ALL SELECT * FROM f_{name})),
z_{name} AS (SELECT words[1:a] AS anchor, words[a + 1:] AS suffix, array_to_string(words[a + 1:], '') AS text, list_transform(words[a + 1:], lambda w: regexp_replace(w, '[^a-z]', '', 'g')) AS syl, evidence + (a - 1) * 18 - (len(words) - a - 1) * 14 AS evidence, source_count AS sources FROM x_{name}),
q_{name} AS (SELECT * FROM z_{name} QUALIFY row_number() OVER (PARTITION BY anchor, text, syl ORDER BY evidence DESC, len(suffix), sources DESC, suffix DESC) = 1),
{name} AS (SELECT * FROM q_{name} QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY evidence DESC, sources DESC, len(syl), suffix, syl) <= {most})"""


_STRONGEST = "SELECT words, m.evidence AS evidence, m.source_count AS source_count FROM (SELECT words, max(struct_pack(evidence := evidence, source_count := source_count)) AS m FROM ({}) GROUP BY words)"


@query(_BASE + f""", lm AS (SELECT words, evidence, source_count, visible FROM s2 WHERE n >= 3 UNION ALL SELECT words, evidence, source_count, visible FROM s3 WHERE n >= 3), seen AS (SELECT words, evidence, source_count FROM lm WHERE visible),
bk AS (SELECT t.words, least(l.evidence, r.evidence) + greatest(0, t.evidence - 360) AS evidence, 12 AS source_count FROM seen t JOIN p l ON t.words[1:2] = l.words JOIN p r ON t.words[2:3] = r.words WHERE len(t.words) = 3),
st AS MATERIALIZED ({_STRONGEST.format("SELECT * FROM seen UNION ALL SELECT * FROM bk")}), ac AS MATERIALIZED ({_STRONGEST.format("SELECT * FROM st UNION ALL SELECT words, evidence, source_count FROM lm WHERE NOT visible")}),
{_index_rows("shown", "st", 8)}, {_index_rows("recall", "ac", 24)}
SELECT array_to_string(r.anchor, '|') AS anchor, array_to_string(r.suffix, '|') AS suffix, r.evidence::INT AS evidence, r.sources::INT AS sources, EXISTS (SELECT 1 FROM shown s WHERE s.anchor = r.anchor AND s.suffix = r.suffix AND s.syl = r.syl) AS visible FROM recall r""")
def completion_index(spark, d):
    """Pairs, paths and four-word paths together."""
    counts = stored(frequent_grams(spark, d, (2, 3), 3))  # read many times below
    index = transitions.completion_index(pairs(scored(spark, d, 2, counts=counts)), scored(spark, d, 2, 3, counts=counts))
    return index.select(F.concat_ws("|", "anchor").alias("anchor"), F.concat_ws("|", "suffix").alias("suffix"), "evidence", "sources", "visible")


@query(f"WITH {_LEX}, x AS (SELECT *, unnest(generate_series(1, least(length(reading) - 1, 12))) AS i FROM lex WHERE length(reading) > 1) SELECT substring(reading, 1, i) AS prefix, reading, text, weight, (row_number() OVER (PARTITION BY substring(reading, 1, i) ORDER BY weight DESC, reading, text))::INT AS rank FROM x QUALIFY rank <= 6")
def prefix_lookup_top6(spark, d):
    return completion.prefix_top(lex(spark, d))


@query(f"""WITH {_LEX}, {_G2}, {_EV.format(n=2)}, pr AS (SELECT gram[1] AS l, gram[2] AS r, regexp_replace(gram[1], '[^a-z]', '', 'g') AS lr, regexp_replace(gram[2], '[^a-z]', '', 'g') AS rr, n AS evidence FROM e2 WHERE sources >= 5),
k AS (SELECT * FROM pr WHERE lr <> '' AND length(rr) > 1 AND NOT EXISTS (SELECT 1 FROM lex WHERE lex.reading = lr || rr AND lex.text = l || r)),
x AS (SELECT *, lr || substring(rr, 1, i) AS prefix FROM (SELECT *, unnest(generate_series(1, length(rr) - 1)) AS i FROM k))
SELECT prefix, lr || rr AS reading, l || r AS text, l || '|' || r AS path, evidence, (row_number() OVER (PARTITION BY prefix ORDER BY evidence DESC, l || r, l))::INT AS rank FROM x QUALIFY rank <= 6""")
def transition_completion(spark, d):
    gram = F.split("path", r"\|")
    g = frequent_grams(spark, d, (2,), 5).where("sources >= 5").select(gram[0].alias("left"), gram[1].alias("right"), "sources", F.col("n").alias("evidence"))
    g = g.withColumns({"left_reading": keys.latin_reading(F.col("left")), "right_reading": keys.latin_reading(F.col("right"))})
    words = blocks.gram_counts(texts_of_words(spark, d), "doc_id", F.lit(0).cast("long"), (1,)).groupBy(F.col("gram").alias("text")).agg(F.sum("n").alias("n"))
    return completion.transition_completion(g, stored(lex(spark, d, words)))  # read for the whole and either side


_PAT = r"pat AS (SELECT DISTINCT word AS pattern FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM benchmark) WHERE length(word) BETWEEN 6 AND 9)"


@query(f"""WITH {_PAT}, l AS (SELECT DISTINCT length(pattern) AS k FROM pat),
h AS (SELECT doc_id, lang, substring(t, i, k) AS pattern FROM (SELECT doc_id, lang, lower(text) AS t, k, unnest(generate_series(1, length(text) - k + 1)) AS i FROM documents, l WHERE length(text) >= k)),
c AS (SELECT pattern, count(*) AS n, count(DISTINCT doc_id) AS s, count(DISTINCT lang) AS domains FROM h SEMI JOIN pat USING (pattern) GROUP BY 1)
SELECT pattern, least(coalesce(n, 0), 1000000)::BIGINT AS n, least(coalesce(s, 0), 255)::BIGINT AS sources, coalesce(domains, 0) AS domains FROM pat LEFT JOIN c USING (pattern)""")
def pattern_support_scan(spark, d):
    docs = table(spark, d, "documents").select(F.lower("text").alias("text"), F.col("doc_id").alias("source"), F.col("lang").alias("domain"))
    p = counting.tokens(table(spark, d, "benchmark"), ["item_id"]).select(F.col("word").alias("pattern")).where(F.length("pattern").between(6, 9)).distinct()
    return patterns.support_scanned(docs, p)


QUERIES["pattern_support_join"] = lambda spark, d: patterns.support_joined(
    table(spark, d, "documents").select(F.lower("text").alias("text"), F.col("doc_id").alias("source"), F.col("lang").alias("domain")),
    counting.tokens(table(spark, d, "benchmark"), ["item_id"]).select(F.col("word").alias("pattern")).where(F.length("pattern").between(6, 9)).distinct(),
)
ORACLES["pattern_support_join"] = ORACLES["pattern_support_scan"]


@query(ORACLES["pattern_support_scan"])
def pattern_support_anchored(spark, d):
    """The same patterns by rare anchors, as for sets that no task can hold."""
    docs = table(spark, d, "documents").select(F.lower("text").alias("text"), F.col("doc_id").alias("source"), F.col("lang").alias("domain"))
    p = counting.tokens(table(spark, d, "benchmark"), ["item_id"]).select(F.col("word").alias("pattern")).where(F.length("pattern").between(6, 9)).distinct()
    return patterns.support_anchored(docs, p)


@query(f"""WITH {_WC}, small AS (SELECT text FROM wc WHERE length(text) BETWEEN 2 AND 8 AND n >= 20), ps AS (SELECT text, unnest(generate_series(0, length(text) - 1)) AS p0 FROM wc),
su AS MATERIALIZED (SELECT text, p0, k, substring(text, p0 + 1, k) AS span FROM ps, (SELECT unnest(generate_series(2, 8)) AS k) WHERE p0 + k <= length(text)), sp AS (SELECT su.text, p0, k FROM su SEMI JOIN small ON su.span = small.text),
cv AS (SELECT DISTINCT text, unnest(generate_series(p0, p0 + k - 1)) AS p0, true AS hit FROM sp)
SELECT text AS word, p0::INT AS position, coalesce(hit, false) AS covered FROM ps LEFT JOIN cv USING (text, p0)""")
def word_cover_positions(spark, d):
    wc = word_counts(spark, d)
    small = wc.where(F.length("text").between(2, 8) & (F.col("n") >= 20))
    return counting.covered_positions(wc.select(F.col("text").alias("word")), small).select("word", F.col("at").alias("position"), "covered")


@query(f"WITH {_LEX}, m AS (SELECT reading, translate(text, '{_A}', '{_B}') AS new, text, weight FROM lex) SELECT reading, new AS text, max(weight) AS weight FROM m GROUP BY 1, 2")
def variant_twin_merge(spark, d):
    rows = lex(spark, d).select("reading", "text", "weight")
    return variants.merged_twins(rows, ["reading", "text"], {"text": F.translate("text", _A, _B)}, F.col("weight"))


@query(f"""WITH {_TOK}, {_G2}, {_EV.format(n=2)}, g AS (SELECT translate(array_to_string(gram, ' '), '{_A}', '{_B}') AS gram, array_to_string(gram, ' ') AS ord, round_even(1000 * ln(n / 1e6), 0) AS score FROM e2 WHERE n >= 2)
SELECT gram, list_reduce(list(score ORDER BY ord), lambda a, b: round_even(greatest(a, b) + 1000 * ln(1 + exp((least(a, b) - greatest(a, b)) / 1000.0)), 0))::INT AS score, '0' AS backoff FROM g GROUP BY gram""")
def ngram_logsumexp_merge(spark, d):
    g = grams(spark, d, 2).where("n >= 2").select(F.translate(F.translate("path", "|", " "), _A, _B).alias("gram"), F.translate("path", "|", " ").alias("ord"), F.bround(1000 * F.log(F.col("n") / 1e6)).cast("int").alias("score"), F.lit("0").alias("backoff"))
    return variants.log_sum_exp(g)


_RULES = admission.Rules(shape=r"^\p{L}{4,14}$", fragment_starts=("th",), fragment_ends=("ing",), organisation_ends=("tion",), markers={"de": ("e", "u")}, barred_ends={"fr": ("oi",)}, barred={"es": ("ñ",)}, required_ends={"es": ("a", "o", "s")})


@query(rf"""WITH {_TOK}, t AS (SELECT DISTINCT word AS text, lang AS category FROM tok),
r AS (SELECT category, CASE WHEN NOT regexp_matches(text, '^\p{{L}}{{4,14}}$') THEN 'length_or_script' WHEN text LIKE 'th%' OR text LIKE '%ing' THEN 'fragment' WHEN text LIKE '%tion' THEN 'organization_label'
 WHEN category = 'de' AND NOT (contains(text, 'e') OR contains(text, 'u')) THEN 'de_domain_mismatch' WHEN category = 'fr' AND text LIKE '%oi' THEN 'publication_title' WHEN category = 'es' AND contains(text, 'ñ') THEN 'fiction_label'
 WHEN category = 'es' AND NOT (text LIKE '%a' OR text LIKE '%o' OR text LIKE '%s') THEN 'es_domain_mismatch' ELSE 'admitted' END AS reason FROM t) SELECT category, reason, count(*) AS n FROM r GROUP BY 1, 2""")
def admission_reasons(spark, d):
    t = tok(spark, d).select(F.col("word").alias("text"), F.col("lang").alias("category")).distinct()
    return admission.reason_counts(t.withColumn("reason", admission.reason(F.col("text"), F.col("category"), _RULES)))


@query(rf"""WITH {_TOK}, b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM benchmark), c AS (SELECT word AS text, lang, count(*) AS n FROM tok WHERE word NOT IN (SELECT word FROM b) GROUP BY 1, 2)
SELECT text, lang, n, CASE WHEN n >= 100 THEN 0.8 WHEN n >= 50 THEN 0.78 WHEN n >= 25 THEN 0.76 WHEN n >= 12 THEN 0.74 ELSE 0.72 END::DOUBLE AS hint FROM c QUALIFY row_number() OVER (PARTITION BY text ORDER BY n DESC, lang) = 1""")
def known_term_antijoin_candidates(spark, d):
    known = counting.tokens(table(spark, d, "benchmark"), ["item_id"]).select(F.col("word").alias("text"))
    c = tok(spark, d).groupBy(F.col("word").alias("text"), "lang").agg(F.count("*").alias("n"))
    return lexicon.best(lexicon.unknown(c, known), ["text"], ["n"], ["lang"]).withColumn("hint", keys.link_hint(F.col("n")))


_CUR = f"{_LEX}, cur AS (SELECT reading, text, weight FROM lex WHERE n >= 3), ex AS (SELECT text FROM lex WHERE text LIKE 'th%' AND length(text) >= 2)"


@query(f"WITH {_CUR} SELECT * FROM cur UNION ALL SELECT reading, text, weight FROM lex WHERE text NOT IN (SELECT text FROM cur) AND text NOT IN (SELECT text FROM ex)")
def snapshot_restore(spark, d):
    x = lex(spark, d)
    return curation.restored(x.where("n >= 3").select("reading", "text", "weight"), x.select("reading", "text", "weight"), x.where("text LIKE 'th%'"))


@query(f"WITH {_CUR} SELECT reading, text, CASE WHEN n >= 3 AND length(text) % 4 = 0 THEN 347 WHEN n < 3 AND length(text) % 4 = 0 THEN 347 ELSE weight END::INT AS weight FROM lex WHERE n >= 3 OR length(text) % 4 = 0")
def curated_override_inject(spark, d):
    x = lex(spark, d)
    rows = x.where(F.length("text") % 4 == 0).select("reading", "text", F.lit(0.347).alias("score"))
    return curation.force(x.where("n >= 3").select("reading", "text", "weight"), rows)


@query(f"WITH {_LEX} SELECT rule, count(*) AS n FROM (SELECT 'reading' AS rule FROM lex WHERE NOT regexp_matches(reading, '^[a-z]+$') UNION ALL SELECT 'text' FROM lex WHERE length(text) < 2 UNION ALL SELECT 'not_unique' FROM (SELECT count(*) OVER (PARTITION BY reading) AS k FROM lex) WHERE k > 1 UNION ALL SELECT 'rows' FROM (SELECT count(*) OVER (PARTITION BY substring(reading, 1, 2)) AS k FROM lex) WHERE k > 50) GROUP BY 1")
def constraint_violations(spark, d):
    v = validation.violations(lex(spark, d).withColumn("two", F.substring("reading", 1, 2)), {"reading": F.col("reading").rlike("^[a-z]+$"), "text": F.length("text") >= 2}, ["reading"], {"rows": (["two"], 50)})
    return v.groupBy("rule").agg(F.count("*").alias("n"))


@query(f"""WITH {_LEX}, c AS (SELECT lang, regexp_replace(word, '[^a-z]', '', 'g') AS reading, word AS text, count(*) AS n FROM tok GROUP BY 1, 2, 3), t AS (SELECT reading, text, sum(n) AS total FROM c WHERE reading <> '' GROUP BY 1, 2),
cur AS (SELECT reading, min(text) AS current FROM t GROUP BY 1), want AS (SELECT lang, reading, text AS wanted FROM c WHERE reading <> '' QUALIFY row_number() OVER (PARTITION BY lang, reading ORDER BY n DESC, text) = 1),
outp AS (SELECT l.lang, c.reading, c.text AS output FROM (SELECT DISTINCT lang FROM c) l JOIN (SELECT lang, reading, text, n FROM c WHERE reading <> '') c ON c.lang <> l.lang GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY l.lang, c.reading ORDER BY sum(n) DESC, c.text) = 1),
g AS (SELECT w.lang AS domain, wanted, current, coalesce(output, current) AS output FROM want w JOIN cur USING (reading) LEFT JOIN outp o ON o.lang = w.lang AND o.reading = w.reading)
SELECT domain, count(*) AS groups, count(*) FILTER (current = wanted) AS current_hits, count(*) FILTER (output = wanted) AS output_hits, count(*) FILTER (current <> wanted AND output = wanted) AS rescues, count(*) FILTER (current = wanted AND output <> wanted) AS regressions, count(*) FILTER (current <> output) AS switches, count(*) FILTER (current <> wanted AND output = wanted) - count(*) FILTER (current = wanted AND output <> wanted) AS net, round(count(*) FILTER (output = wanted) / count(*), 6) AS rate FROM g GROUP BY 1""")
def leave_one_domain_out_eval(spark, d):
    c = tok(spark, d).groupBy("lang", F.col("word").alias("text")).agg(F.count("*").alias("n")).withColumn("reading", keys.latin_reading(F.col("text"))).where("reading <> ''")
    current = c.groupBy("reading").agg(F.min("text").alias("current"))
    wanted = lexicon.best(c, ["lang", "reading"], ["n"], ["text"]).select("lang", "reading", F.col("text").alias("wanted"))
    # a word's count outside a domain is its total less the domain's own: nothing is joined domain by domain
    total = c.groupBy("reading", "text").agg(F.sum("n").alias("total"))
    spread = wanted.select("lang", "reading").join(total, "reading")  # only what a domain asks for
    rest = spread.join(c, ["lang", "reading", "text"], "left").withColumn("rest", F.col("total") - F.coalesce("n", F.lit(0))).where("rest > 0")
    out = lexicon.best(rest, ["lang", "reading"], ["rest"], ["text"]).select("lang", "reading", F.col("text").alias("output"))
    g = wanted.join(current, "reading").join(out, ["lang", "reading"], "left").select(F.col("lang").alias("domain"), "wanted", "current", F.coalesce("output", "current").alias("output"))
    return evaluation.by_domain(g)


#: Words seen less often are segmented, but are no entries of the lexicon.
LEXICON_COUNT = 20


def _stretches(spark, d):
    wc = word_counts(spark, d)
    return wc.select(F.col("text").alias("stretch"), "n"), wc.where((F.length("text") >= 2) & (F.col("n") >= LEXICON_COUNT))


_ST = f"{_WC}, lx AS MATERIALIZED (SELECT text FROM wc WHERE length(text) >= 2 AND n >= 20), po AS (SELECT text, unnest(generate_series(0, length(text) - 1)) AS p0 FROM wc), sn AS MATERIALIZED (SELECT po.text, p0, length(lx.text) AS k FROM (SELECT text, p0, k, substring(text, p0 + 1, k) AS span FROM po, (SELECT DISTINCT length(text) AS k FROM lx) WHERE p0 + k <= length(text)) po JOIN lx ON po.span = lx.text AND po.k = length(lx.text))"
_GREEDY = "g1 AS MATERIALIZED (SELECT piece, sum(n)::BIGINT AS n FROM (SELECT n, substring(text, p0 + 1, k) AS piece FROM gc) GROUP BY 1)"
_GREEDY = f"gb AS MATERIALIZED (SELECT po.text, po.p0, coalesce(max(k), 1) AS k FROM po LEFT JOIN sn USING (text, p0) GROUP BY 1, 2), gc AS (SELECT wc.text, n, 0 AS p0, k FROM wc JOIN gb ON gb.text = wc.text AND gb.p0 = 0 UNION ALL SELECT gc.text, gc.n, gb.p0, gb.k FROM gc JOIN gb ON gb.text = gc.text AND gb.p0 = gc.p0 + gc.k), {_GREEDY}"


def _likeliest(i):
    """The CTEs of pass i (2 or later): fewest pieces, then likeliest by the counts of pass i - 1, of equal ones the longest last piece."""
    g = f"g{i - 1}"
    cost = f"ln((coalesce(c.n, 0) + 0.5) / (SELECT sum(n) FROM {g})) - 1000.0"
    return f"""sp{i} AS (SELECT s.text, p0, p0 + k AS e, {cost} AS c FROM (SELECT text, p0, k, substring(text, p0 + 1, k) AS w FROM sn UNION ALL SELECT text, p0, 1, substring(text, p0 + 1, 1) FROM po) s LEFT JOIN {g} c ON c.piece = s.w),
en{i} AS MATERIALIZED (SELECT text, e, list(struct_pack(s := p0, c := c)) AS sp FROM sp{i} GROUP BY 1, 2),
dp{i} AS (SELECT text, 0 AS e, [0.0::DOUBLE] AS v, [0::BIGINT] AS b FROM wc UNION ALL
 SELECT text, e, list_append(v, m.v), list_append(b, -m.o) FROM (SELECT d.text, en.e, d.v, d.b, list_max(list_transform(en.sp, lambda x: struct_pack(v := d.v[x.s + 1] + x.c, o := -x.s::BIGINT))) AS m FROM dp{i} d JOIN en{i} en ON en.text = d.text AND en.e = d.e + 1)),
bt{i} AS (SELECT text, b, length(text)::BIGINT AS e FROM dp{i} WHERE e = length(text) UNION ALL SELECT text, b, b[e + 1] FROM bt{i} WHERE b[e + 1] > 0),
g{i} AS MATERIALIZED (SELECT piece, sum(n)::BIGINT AS n FROM (SELECT n, substring(bt.text, b[e + 1] + 1, e - b[e + 1]) AS piece FROM bt{i} bt JOIN wc USING (text)) GROUP BY 1)"""


@query(f"WITH RECURSIVE {_ST}, {_GREEDY} SELECT piece, n FROM g1")
def greedy_segmentation_counts(spark, d):
    """The lexicon holds every word of two letters or more and of ``LEXICON_COUNT`` occurrences, however many there are."""
    return segmentation.piece_counts_of(*_stretches(spark, d), mode="greedy")


@query(f"WITH RECURSIVE {_ST}, {_GREEDY}, {', '.join(_likeliest(i) for i in range(2, 7))} SELECT piece, n FROM g6")
def min_word_segmentation_counts(spark, d):
    """The lexicon holds every word of two letters or more and of ``LEXICON_COUNT`` occurrences, however many there are."""
    return segmentation.reestimated(*_stretches(spark, d))


@query(f"""WITH {_WC}, ch AS (SELECT substring(text, 1, 1) AS char, regexp_replace(text, '[^a-z]', '', 'g')[1:1] AS reading, sum(n)::BIGINT AS weight, min(text) AS ord, count(*)::DOUBLE AS rate FROM wc WHERE regexp_replace(text, '[^a-z]', '', 'g') <> '' GROUP BY 1, 2),
mr AS (SELECT *, row_number() OVER w AS k, lead(weight) OVER w AS nx FROM ch WINDOW w AS (PARTITION BY char ORDER BY weight DESC, reading DESC)), mv AS (SELECT char, reading, weight, ord FROM mr WHERE k = 1 AND (nx IS NULL OR nx <= weight - 100)),
u AS (SELECT char, sum(rate) AS rate FROM ch GROUP BY 1), m AS (SELECT mv.*, rate, count(*) OVER (PARTITION BY reading) AS c FROM mv JOIN u USING (char) QUALIFY c >= 2),
pl AS (SELECT reading, char, row_number() OVER (PARTITION BY reading ORDER BY rate DESC, weight DESC, ord) AS k FROM m), vl AS (SELECT reading, weight AS moved, row_number() OVER (PARTITION BY reading ORDER BY weight DESC, ord) AS k FROM m),
nw AS (SELECT reading, char, moved FROM pl JOIN vl USING (reading, k)) SELECT ch.reading, ch.char, coalesce(moved, weight) AS weight FROM ch LEFT JOIN nw ON ch.reading = nw.reading AND ch.char = nw.char""")
def weight_redistribution(spark, d):
    wc = word_counts(spark, d).withColumn("r", keys.latin_reading(F.col("text"))).where("r <> ''")
    rows = wc.groupBy(F.substring("text", 1, 1).alias("char"), F.substring("r", 1, 1).alias("reading")).agg(F.sum("n").alias("weight"), F.min("text").alias("ord"), F.count("*").cast("double").alias("rate"))
    use = rows.groupBy("char").agg(F.sum("rate").alias("rate"))
    return single_char.redistributed(rows.drop("rate"), use).select("reading", "char", "weight")


@query("SELECT c_name AS name, n_name AS nation, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment = 'BUILDING' ORDER BY name DESC LIMIT 100")
def sparql_like_triples(spark, d):
    pre = lambda df, c, p: df.withColumn(c, F.concat(F.lit(p), F.col(c).cast("string")))
    n, c = pre(table(spark, d, "nation"), "n_nationkey", "n:"), pre(table(spark, d, "customer"), "c_custkey", "c:")
    n, r = pre(n, "n_regionkey", "r:"), pre(table(spark, d, "region"), "r_regionkey", "r:")
    c = pre(c, "c_nationkey", "n:")
    facts = admission.triples(c, "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"]).unionByName(admission.triples(n, "n_nationkey", ["n_name", "n_regionkey"])).unionByName(admission.triples(r, "r_regionkey", ["r_name"]))
    out = admission.matched(facts, [("?c", "c_mktsegment", "BUILDING"), ("?c", "c_name", "?name"), ("?c", "c_nationkey", "?n"), ("?n", "n_name", "?nation"), ("?n", "n_regionkey", "?r"), ("?r", "r_name", "?region")])
    return out.select("name", "nation", "region").orderBy(F.desc("name")).limit(100)


@query(f"WITH {_WC}, {_CONV} SELECT text AS word, sum(n)::BIGINT AS n FROM (SELECT text, n FROM wc UNION ALL SELECT word, count(*) FROM ctok GROUP BY 1) GROUP BY 1")
def incremental_counts_merge(spark, d):
    chat = counting.tokens(table(spark, d, "conversations"), ["conv_id"]).groupBy("word").agg(F.count("*").alias("n"))
    return incremental.merged(word_counts(spark, d).withColumnRenamed("text", "word"), chat)


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_event_counts(spark, d):
    return incremental.windowed_counts(table(spark, d, "events"))


_EVN = "ev AS (SELECT doc_id AS source, coalesce(lag(word) OVER (PARTITION BY doc_id ORDER BY pos), '') AS before, substring(word, 1, 2) AS prefix, word AS text FROM tok WHERE true)"


@query(f"""WITH {_TOK}, {_EVN}, x AS (SELECT *, unnest(generate_series(0, least(4, length(before)))) AS width FROM ev), y AS (SELECT width, CASE WHEN width = 0 THEN '' ELSE substring(before, length(before) - width + 1, width) END AS context, prefix, text, source FROM x)
SELECT width::INT AS width, context, prefix, text, count(*) AS occurrences, least(count(DISTINCT source), 16) AS sources, (round(100 * log2(1 + count(*))) + 20 * least(count(DISTINCT source), 16))::BIGINT AS evidence FROM y GROUP BY 1, 2, 3, 4""")
def competition_prior(spark, d):
    return evaluation.word_competition(texts_of_words(spark, d), "doc_id")

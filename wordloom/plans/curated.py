"""Queries of curation, variants, checks, transitions with guards, and rescoring."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wordloom.functions import keys
from wordloom.functions.bounded import stored
from wordloom.operators import admission, completion, counting, curation, evaluation, fragments, frequent, lexicon, rescoring, segmentation, single_char, transitions, validation, variants
from wordloom.plans.catalogue import _A, _ACC, _CONV, _EV, _EVN, _G2, _LEX, _SC, _TOK, _WC, _WT, _stretches, competition_prior, lex, query, scored, table, texts_of_words, tok, word_counts
from wordloom.streaming import incremental

_B = "".join(_ACC.values())
_PLAIN = f"translate(text, '{_A}', '{_B}')"
_RTW = "SELECT reading, text, weight FROM lex"


def rtw(spark, d):
    return lex(spark, d).select("reading", "text", "weight")


def plain(c="text"):
    return F.translate(c, _A, _B)


# --- curated rows ---

_MODE = "CASE length(text) % 6 WHEN 0 THEN '' WHEN 1 THEN 'exact_zero' WHEN 2 THEN 'exact_rank' WHEN 3 THEN 'no_contains' WHEN 4 THEN 'exact_rank_no_contains' ELSE 'exact_rank_exact_only' END"


@query(f"""WITH {_LEX}, m AS (SELECT text, reading, {_MODE} AS mode, (n % 1000) / 1000.0 AS score FROM lex) SELECT text AS sc, mode,
coalesce(CASE WHEN mode = 'exact_zero' THEN 0 WHEN mode LIKE 'exact_rank%' THEN round_even(score::DOUBLE * 1000, 0) END, -1)::INT AS forced, CASE WHEN mode LIKE '%no_contains' THEN 'no_contains' ELSE '' END AS scope,
mode LIKE 'exact_%' AS post_rank, mode = 'exact_rank_exact_only' AS exact_only FROM m""")
def curated_modes(spark, d):
    k = F.length("text") % 6
    mode = F.when(k == 0, F.lit(None))
    for i, name in enumerate(("exact_zero", "exact_rank", "no_contains", "exact_rank_no_contains"), 1):
        mode = mode.when(k == i, name)
    rows = lex(spark, d).select(F.col("text").alias("sc"), F.col("text").alias("tc"), "reading", ((F.col("n") % 1000) / 1000.0).alias("score"), mode.otherwise("exact_rank_exact_only").alias("mode"))
    return curation.curated(rows).select("sc", "mode", F.coalesce("forced", F.lit(-1)).alias("forced"), F.coalesce("scope", F.lit("")).alias("scope"), "post_rank", "exact_only")


@query(f"WITH {_LEX}, x AS (SELECT *, CASE length(text) % 3 WHEN 0 THEN 'keep' WHEN 1 THEN 'zero' ELSE 'none' END AS m FROM lex) SELECT reading, text, CASE WHEN m = 'zero' THEN 0 WHEN m = 'keep' AND n < 3 THEN 1 ELSE weight END::INT AS weight FROM x WHERE n >= 3 OR m <> 'none'")
def curated_markers(spark, d):
    x, k = lex(spark, d), F.length("text") % 3
    rows = x.where(k < 2).select("reading", "text", F.when(k == 0, curation.KEEP_OR_ONE).otherwise(curation.FORCE_ZERO).alias("score"))
    return curation.force(x.where("n >= 3").select("reading", "text", "weight"), rows)


@query(f"WITH {_LEX} SELECT reading, text, weight FROM lex WHERE NOT (text LIKE 'th%' AND length(text) >= 2)")
def excluded_terms(spark, d):
    return curation.excluded(rtw(spark, d), lex(spark, d).where("text LIKE 'th%' OR length(text) = 1"))


@query(f"WITH {_LEX} SELECT reading, text, CASE WHEN length(text) = 1 AND n % 2 = 0 THEN weight ELSE weight + 7 END AS weight FROM lex")
def kept_single_weights(spark, d):
    x = lex(spark, d)
    return curation.kept_single(x.select("reading", "text", (F.col("weight") + 7).alias("weight")), x.where("n % 2 = 0"))


@query(f"WITH {_LEX} SELECT reading, text, CASE WHEN text LIKE 'a%' THEN least(weight, 80) ELSE weight END AS weight FROM lex")
def capped_terms(spark, d):
    return curation.capped(rtw(spark, d), lex(spark, d).where("text LIKE 'a%'")).select("reading", "text", F.col("weight").cast("long").alias("weight"))


@query(f"""WITH {_LEX}, o AS (SELECT text, reading || 'x' AS new FROM lex WHERE length(text) % 3 = 1) SELECT reading, text, max(weight) AS weight FROM
(SELECT coalesce(new, reading) AS reading, text, weight FROM lex LEFT JOIN o USING (text) UNION ALL SELECT reading, text, weight FROM lex JOIN o USING (text) WHERE length(text) = 1) GROUP BY 1, 2""")
def reading_overrides(spark, d):
    o = lex(spark, d).where("length(text) % 3 = 1").select("text", F.concat("reading", F.lit("x")).alias("reading"))
    return curation.overridden(rtw(spark, d), o)


@query(f"""WITH {_LEX}, a AS (SELECT text, reading || 'a' AS reading, least(weight, 150) AS weight FROM lex WHERE weight > 0 AND length(text) % 4 = 2) SELECT reading, text, weight FROM lex
UNION ALL SELECT reading, text, weight FROM a WHERE NOT EXISTS (SELECT 1 FROM lex WHERE lex.reading = a.reading AND lex.text = a.text)""")
def reading_aliases(spark, d):
    aliases = lex(spark, d).where("length(text) % 4 = 2").select("text", F.concat("reading", F.lit("a")).alias("reading"), F.col("reading").alias("from_reading"))
    out = curation.aliased(rtw(spark, d), aliases, 150)
    return out.select("reading", "text", F.col("weight").cast("long").alias("weight"))


@query(rf"WITH {_TOK}, r AS (SELECT DISTINCT {_PLAIN.replace('text', 'word')} AS text, word AS reading FROM tok) SELECT text, min(reading) AS reading FROM r GROUP BY 1 HAVING count(*) = 1")
def single_reading_overrides(spark, d):
    return curation.single_reading_overrides(tok(spark, d).select(plain("word").alias("text"), F.col("word").alias("reading")))


@query(f"WITH {_TOK}, c AS (SELECT word AS text, lang, count(DISTINCT doc_id) AS df FROM tok GROUP BY 1, 2) SELECT text, sum(df)::BIGINT AS frequency, count(*) AS categories, max(df) AS largest FROM c GROUP BY 1 HAVING count(*) >= 2")
def category_frequency(spark, d):
    rows = tok(spark, d).groupBy(F.col("word").alias("text"), F.col("lang").alias("category")).agg(F.count_distinct("doc_id").alias("df"))
    out = curation.category_frequency(rows)
    return out.select("text", "frequency", F.size("by_category").cast("long").alias("categories"), F.array_max(F.map_values("by_category")).alias("largest"))


@query(f"WITH {_LEX} SELECT text, CASE WHEN n >= 5 THEN round_even(158 + 25 * ((n % 100) / 100.0)::DOUBLE, 0)::INT ELSE 1 END AS popularity, CASE WHEN n >= 5 THEN 0 ELSE 4 END AS layer, 7 AS fields FROM lex")
def specialist_priors(spark, d):
    x = lex(spark, d)
    out = curation.specialist_prior(x.select("text"), x.where("n >= 5").select("text", ((F.col("n") % 100) / 100.0).alias("familiarity")))
    return out.select("text", F.col("prior")[0].alias("popularity"), F.col("prior")[5].alias("layer"), F.size("prior").alias("fields"))


@query(f"""WITH {_LEX}, s AS (SELECT text, n AS corpus, (n % 10) / 10.0::DOUBLE AS usage, n % 7 = 0 AS hot, n % 5 = 0 AS low, CASE WHEN length(text) % 2 = 0 THEN 3 END AS layer, n % 3 AS hits FROM lex),
p AS (SELECT *, 60 * log10(1 + corpus) + 300 * usage AS base FROM s) SELECT text, least(1000, round_even(CASE WHEN hot THEN greatest(700, base) WHEN low AND layer IS NOT NULL THEN least(199, base) ELSE base END, 0))::INT AS popularity,
hits::INT AS hits, CASE WHEN low AND layer IS NOT NULL THEN 260 ELSE 100 END AS risk, coalesce(layer, 0)::INT AS layer, 0 AS path_score FROM p""")
def popularity_priors(spark, d):
    n = F.col("n")
    s = lex(spark, d).select("text", n.alias("corpus"), ((n % 10) / 10.0).alias("usage"), (n % 7 == 0).alias("hot"), (n % 5 == 0).alias("low"), F.when(F.length("text") % 2 == 0, 3).alias("layer"), (n % 3).alias("hits"), F.lit(None).cast("int").alias("path_score"))
    return curation.popularity_prior(s)


@query(f"WITH {_LEX}, c AS (SELECT * FROM lex WHERE n >= 3) SELECT reading, text, weight FROM c UNION ALL SELECT reading, text, 150 FROM lex WHERE n < 3 AND length(text) > 3")
def specialist_rows_added(spark, d):
    x = lex(spark, d)
    rows = x.where("length(text) > 3").select(F.col("text").alias("sc"), F.col("text").alias("tc"), F.lit(0.15).alias("usage"), "reading")
    new = curation.checked(rows).select("reading", F.col("tc").alias("text"), F.bround(F.col("usage") * 1000).cast("long").alias("weight"))
    return lexicon.add_only(x.where("n >= 3").select("reading", "text", "weight"), new)


# --- variants ---


@query(f"""WITH {_LEX}, v AS (SELECT text AS variant, {_PLAIN} AS target FROM lex WHERE {_PLAIN} <> text), b AS (SELECT reading, text, CASE WHEN text IN (SELECT variant FROM v) THEN least(1, weight) ELSE weight END AS weight FROM lex),
g AS (SELECT reading, target AS text, max(weight) AS given FROM lex JOIN v ON text = variant GROUP BY 1, 2) SELECT reading, text, greatest(weight, given) AS weight FROM b FULL JOIN g USING (reading, text)""")
def raised_twins(spark, d):
    v = lex(spark, d).select(F.col("text").alias("variant"), plain().alias("target")).where("variant <> target")
    return variants.raised_twins(rtw(spark, d), v)


@query(f"""WITH {_LEX}, {_CONV}, s AS (SELECT reading, {_PLAIN} AS text, max(weight) AS w FROM lex GROUP BY 1, 2), t AS (SELECT reading, text, weight FROM clex WHERE reading <> '')
SELECT reading, text, greatest(weight, w) AS weight, weight IS NOT NULL AS twin FROM t FULL JOIN s USING (reading, text)""")
def backfilled_lexicon(spark, d):
    chat = counting.tokens(table(spark, d, "conversations"), ["conv_id"]).groupBy(F.col("word").alias("text")).agg(F.count("*").alias("n"))
    chat = chat.select(keys.latin_reading(F.col("text")).alias("reading"), "text", keys.log_score(F.col("n")).alias("weight")).where("reading <> ''")
    return variants.backfilled(chat, rtw(spark, d), plain())


_SPELT = f"w AS (SELECT text AS l, {_PLAIN} AS r FROM lex), z AS (SELECT l, r, unnest(string_split(l, '')) AS a, unnest(string_split(r, '')) AS b FROM w)"


def spelt(spark, d):
    return lex(spark, d).select(F.col("text").alias("left"), plain().alias("right"))


@query(f"WITH {_LEX}, {_SPELT} SELECT a, b, count(*) AS n FROM z WHERE a <> b GROUP BY 1, 2")
def char_variant_pairs(spark, d):
    return variants.char_pairs(spelt(spark, d))


@query(f"WITH {_LEX}, {_SPELT} SELECT l AS word, r AS form FROM w WHERE NOT EXISTS (SELECT 1 FROM z WHERE z.l = w.l AND z.r = w.r AND a <> b AND a NOT IN ('é', 'ü', 'ö'))")
def same_word_forms(spark, d):
    pairs = spark.createDataFrame([("é", "e"), ("ü", "u"), ("ö", "o")], "a string, b string")
    return variants.same_word(spelt(spark, d), pairs).select(F.col("left").alias("word"), F.col("right").alias("form"))


@query(f"WITH {_LEX}, {_SPELT}, p AS (SELECT DISTINCT a, b FROM z WHERE a <> b) SELECT a AS source, CASE WHEN a = 'é' THEN 'ê' ELSE b END AS target FROM p WHERE a <> 'ü'")
def corrected_char_map(spark, d):
    pairs = variants.char_pairs(spelt(spark, d)).select(F.col("a").alias("from"), F.col("b").alias("to"))
    fixes = spark.createDataFrame([("é", "ê"), ("ü", None)], "from string, to string")
    return variants.corrected_map(pairs, fixes).select(F.col("from").alias("source"), F.col("to").alias("target"))


@query(f"WITH {_WC}, a AS (SELECT DISTINCT unnest(string_split(text, '')) AS char FROM wc), b AS (SELECT DISTINCT unnest(string_split(word, '')) AS char FROM (SELECT unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM benchmark)) SELECT char FROM a EXCEPT SELECT char FROM b")
def only_characters(spark, d):
    return lexicon.only_characters(word_counts(spark, d), counting.tokens(table(spark, d, "benchmark"), ["item_id"]).select(F.col("word").alias("text")))


@query(f"""WITH {_WC}, ch AS (SELECT text, n, unnest(string_split(text, '')) AS char FROM wc) SELECT char, CASE WHEN length(text) % 2 = 0 THEN 'even' ELSE 'odd' END AS form, sum(CASE WHEN length(text) >= 2 THEN n ELSE 0 END)::BIGINT AS inside, sum(CASE WHEN length(text) >= 2 THEN 0 ELSE n END)::BIGINT AS alone FROM ch GROUP BY 1, 2""")
def form_use_counts(spark, d):
    ch = word_counts(spark, d).select("n", F.when(F.length("text") % 2 == 0, "even").otherwise("odd").alias("form"), (F.length("text") >= 2).alias("covered"), F.explode(F.split("text", "")).alias("char")).where("char <> ''")
    return counting.form_counts(ch)


# --- lexicon and readings ---


@query(f"""WITH {_LEX}, r AS (SELECT *, row_number() OVER (PARTITION BY reading ORDER BY weight DESC, text) AS rank, max(weight) OVER (PARTITION BY reading) AS top FROM lex) SELECT text, count(*)::INT AS readings, sum(rank)::BIGINT AS ranks, max(top) AS top FROM r GROUP BY 1""")
def entry_index(spark, d):
    out = lexicon.entry_index(rtw(spark, d))
    total = F.aggregate("entries", F.lit(0).cast("long"), lambda a, e: a + e["rank"])
    return out.select("text", F.size("entries").alias("readings"), total.alias("ranks"), F.array_max(F.transform("entries", lambda e: e["top"])).alias("top"))


@query(f"WITH {_LEX} SELECT reading, text, weight, text IN (SELECT text FROM lex WHERE n >= 50) AS common FROM lex")
def flagged_rows(spark, d):
    x = lex(spark, d)
    return lexicon.flagged(rtw(spark, d), x.where("n >= 50"), ["reading", "text"], "common")


@query(f"""WITH {_LEX} SELECT text, CASE WHEN length(reading) <> length(text) THEN 'script_or_reading_length' WHEN regexp_matches(text, '[qx]') THEN 'unverified_character_reading' WHEN contains(text, 'nn') THEN 'ambiguous_boundary' ELSE '' END AS reason FROM lex""")
def reading_checks(spark, d):
    t = lex(spark, d).select("text", plain().alias("converted"), F.regexp_extract_all("reading", F.lit("(.)"), F.lit(1)).alias("syllables"))
    known = spark.createDataFrame([(c, c) for c in "abcdefghijklmnoprstuvwyz"], "char string, reading string")
    return admission.reading_reason(t, known, ~F.col("text").contains("nn")).select("text", "reason")


@query(f"""WITH {_LEX}, x AS (SELECT * FROM lex l WHERE NOT (reading LIKE '%r' AND EXISTS (SELECT 1 FROM lex b WHERE b.reading || 'r' = l.reading AND b.text = substring(l.text, 1, length(l.text) - 1) AND b.text NOT LIKE 'th%')) AND text NOT LIKE 'th%'),
y AS (SELECT *, unnest(generate_series(1, least(length(reading) - 1, 12))) AS i FROM x WHERE length(reading) > 1) SELECT substring(reading, 1, i) AS prefix, reading, text, weight, (row_number() OVER (PARTITION BY substring(reading, 1, i) ORDER BY weight DESC, reading, text))::INT AS rank FROM y QUALIFY rank <= 6""")
def prefix_lookup_guarded(spark, d):
    specialist = lex(spark, d).where("text LIKE 'th%'")
    return completion.prefix_top(rtw(spark, d), specialist=specialist, bound="r")


@query(f"""WITH {_LEX}, s AS (SELECT regexp_replace(reading, '(.)(.)', '\\1\\2''', 'g') AS r0, text, weight FROM lex), t AS (SELECT string_split(rtrim(r0, ''''), '''') AS s, rtrim(r0, '''') AS reading, text, weight FROM s),
x AS (SELECT *, unnest(generate_series(1, len(s) - 1)) AS i FROM t WHERE len(s) > 1) SELECT array_to_string(s[1:i], '') AS prefix, reading, text, weight, (row_number() OVER (PARTITION BY array_to_string(s[1:i], '') ORDER BY weight DESC, reading, text))::INT AS rank FROM x QUALIFY rank <= 6""")
def syllable_prefix_lookup(spark, d):
    r = F.rtrim(F.regexp_replace("reading", "(.)(.)", "$1$2'"), F.lit("'"))
    return completion.syllable_prefix_top(lex(spark, d).select(r.alias("reading"), "text", "weight"))


@query(f"WITH {_LEX} SELECT reading, text, weight FROM lex QUALIFY row_number() OVER (PARTITION BY reading ORDER BY weight DESC, text) <= 2")
def first_rows_of_each(spark, d):
    """The budget is the feature."""
    return fragments.first_rows(rtw(spark, d), 2, ["reading"], [F.desc("weight"), "text"])


@query(f"WITH {_LEX}, o AS (SELECT a.reading, a.text AS char, b.text AS other FROM lex a JOIN lex b ON a.reading = b.reading AND a.text > b.text), m AS (SELECT o.reading, char, max(b.weight) + 3 AS least FROM o JOIN lex b ON b.reading = o.reading AND b.text = o.other GROUP BY 1, 2) SELECT l.reading, l.text AS char, greatest(l.weight, coalesce(least, 0)) AS weight FROM lex l LEFT JOIN m ON l.reading = m.reading AND l.text = m.char")
def raised_over_margin(spark, d):
    x = rtw(spark, d).withColumnRenamed("text", "char")
    other = x.select("reading", F.col("char").alias("other"))
    order = x.join(other, "reading").where("char > other").select("reading", "char", "other", F.lit(3).alias("margin"))
    return single_char.raised_over(x, order)


@query(f"WITH {_LEX} SELECT a.reading, a.text AS char, b.text AS other FROM lex a JOIN lex b ON a.reading = b.reading AND a.text < b.text AND a.weight <= b.weight")
def order_violations(spark, d):
    x = rtw(spark, d).withColumnRenamed("text", "char")
    order = x.select("reading", "char").join(x.select("reading", F.col("char").alias("other")), "reading").where("char < other")
    return validation.order_kept(x, order).select("reading", "char", "other")


# --- transitions ---

_S2 = f"{_G2}, {_EV.format(n=2)}, {_SC.format(n=2, wt=_WT)}"


@query(f"WITH {_LEX}, {_S2} SELECT array_to_string(words, '|') AS path, a.reading || '''' || b.reading AS reading FROM s2 JOIN lex a ON words[1] = a.text JOIN lex b ON words[2] = b.text WHERE s2.n >= 3 AND s2.weight >= 350")
def read_paths(spark, d):
    s = scored(spark, d, 2).where("n >= 3")
    t = s.select(F.concat_ws("", *[keys.latin_reading(F.col("words")[k]) for k in (0, 1)]).alias("query"), "words", "weight")
    readings = lex(spark, d).select("text", F.array("reading").alias("syllables"), F.lit(1).alias("rank"))
    return transitions.read_paths(t, readings).select(F.concat_ws("|", "words").alias("path"), F.array_join(F.flatten("syl"), "'").alias("reading"))


@query("WITH t AS (SELECT text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nx FROM conversations) SELECT text AS anchor, ',' || nx AS suffix, len(string_split(nx, ''))::INT AS syllables, 900 AS evidence, 9 AS sources FROM t WHERE nx <> '' AND text IS NOT NULL")
def next_line_rows(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, d, "conversations").select(F.col("text").alias("line"), F.lit(",").alias("mark"), F.lead("text").over(w).alias("next")).where("next <> '' AND line IS NOT NULL")
    out = transitions.next_lines(c.withColumn("reading", F.concat(F.repeat(F.lit("a'"), F.length("next") - 1), F.lit("a"))))
    return out.select(F.col("anchor")[0].alias("anchor"), F.col("suffix")[0].alias("suffix"), F.size("syllables").alias("syllables"), "evidence", "sources")


@query(f"WITH {_LEX}, b AS (SELECT reading, text, weight FROM lex WHERE n >= 3) SELECT coalesce(b.reading, l.reading) AS reading, coalesce(b.text, l.text) AS path, coalesce(b.weight, l.weight + 1000) AS weight FROM lex l LEFT JOIN b ON l.reading = b.reading AND l.text = b.text")
def transitions_kept(spark, d):
    x = lex(spark, d).withColumnRenamed("text", "path")
    return transitions.kept_weights(x.where("n >= 3"), x.withColumn("weight", F.col("weight") + 1000))


_CTX = f"""cx AS (SELECT word AS l, lead(word) OVER w AS r, lag(word) OVER w AS b, lead(word, 2) OVER w AS a, doc_id FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
pr AS (SELECT l, r, regexp_replace(l || r, '[^a-z]', '', 'g') AS reading, count(*) AS n, count(DISTINCT doc_id) AS sources, count(DISTINCT b) AS lefts, count(DISTINCT a) AS rights FROM cx WHERE r IS NOT NULL GROUP BY 1, 2)"""


def contexts_of_pairs(spark, d):
    """left, right, reading, n, sources, lefts, rights of neighbouring words."""
    w = table(spark, d, "documents").select("doc_id", keys.words(F.col("text")).alias("w"))
    at = lambda i: F.get(F.col("w"), i)
    cells = F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.struct(at(i).alias("left"), at(i + 1).alias("right"), at(i - 1).alias("before"), at(i + 2).alias("after")))
    p = w.where(F.size("w") >= 2).select("doc_id", F.inline(cells))
    return p.groupBy("left", "right").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("sources"), F.count_distinct("before").alias("lefts"), F.count_distinct("after").alias("rights")).withColumn("reading", keys.latin_reading(F.concat("left", "right")))


def guarded_candidates(spark, d, least):
    """The same of the pairs with ``least`` occurrences or more; lefts and rights are 2 for any more.

    Rarer pairs don't leave their texts.  Words before and after are told apart by 64-bit hashes: among 10**7 different words two are taken for one
    with a chance of 3 * 10**-6.
    """
    texts = texts_of_words(spark, d)
    docs = frequent.with_places(texts, frequent.marks(texts, (2,), least))
    at = lambda i: F.get(F.col("words"), i)
    hashed = lambda w: F.when(w.isNotNull(), F.xxhash64(w))
    cell = lambda p: F.struct(F.concat_ws("|", at(F.shiftright(p, 3)), at(F.shiftright(p, 3) + 1)).alias("path"), hashed(at(F.shiftright(p, 3) - 1)).alias("b"), hashed(at(F.shiftright(p, 3) + 2)).alias("a"))
    docs = docs.select("doc_id", F.transform("places", cell).alias("cells"))
    rows = counting.sorted_marks(docs, ["doc_id"], "cells", "path").select("doc_id", "first", "item.*")
    ends = [f(c).alias(f"{c}{k}") for c in "ba" for k, f in enumerate((F.min, F.max))]
    if counting.one_row_each(texts, "doc_id"):
        out = rows.groupBy("path").agg(F.count("*").alias("n"), F.count_if(F.col("first") & F.col("doc_id").isNotNull()).alias("sources"), *ends)
    else:
        one = rows.groupBy("path", "doc_id").agg(F.count("*").alias("n"), *ends)
        out = one.groupBy("path").agg(F.sum("n").alias("n"), F.count("doc_id").alias("sources"), *[f(c).alias(c) for f, c in ((F.min, "b0"), (F.max, "b1"), (F.min, "a0"), (F.max, "a1"))])
    seen = lambda c: F.when(F.col(f"{c}0") < F.col(f"{c}1"), 2).when(F.col(f"{c}0").isNotNull(), 1).otherwise(0)
    pair = F.split("path", r"\|")
    out = out.where(F.col("n") >= least).select(pair[0].alias("left"), pair[1].alias("right"), "n", "sources", seen("b").alias("lefts"), seen("a").alias("rights"))
    return out.withColumn("reading", keys.latin_reading(F.concat("left", "right")))


@query(f"""WITH {_LEX}, {_CTX}, lg AS (SELECT substring(text, 1, i) AS text, sum(n) AS inside FROM (SELECT text, n, unnest(generate_series(1, length(text) - 1)) AS i FROM lex WHERE length(text) > 1) GROUP BY 1),
f AS (SELECT pr.*, l || r AS text FROM pr WHERE sources >= 4 AND lefts >= 2 AND rights >= 2 AND l || r NOT IN (SELECT text FROM lex) AND r NOT LIKE 'th%'),
g AS (SELECT f.* FROM f LEFT JOIN lg USING (text) WHERE coalesce(inside, 0) < 0.9 * f.n),
k AS (SELECT *, row_number() OVER w AS k, first(n) OVER w AS top FROM g WINDOW w AS (PARTITION BY reading ORDER BY n DESC, text))
SELECT l || '|' || r AS path, reading, n, sources, k::INT AS k FROM k WHERE k = 1 OR n * 2.0 > top""")
def guarded_pair_transitions(spark, d):
    wc = stored(word_counts(spark, d))  # read for the lexicon, its beginnings and the tails
    x = wc.withColumn("reading", keys.latin_reading(F.col("text"))).where("reading <> ''")
    out = transitions.guarded_pairs(guarded_candidates(spark, d, 4), x.select("text", "n"), wc.where("text LIKE 'th%'").select("text"))
    return out.select(F.concat_ws("|", "left", "right").alias("path"), "reading", "n", "sources", "k")


@query(f"""WITH {_LEX}, {_CTX}, ac AS (SELECT right(l, 1) AS l, left(r, 1) AS r, sum(n) AS n FROM pr WHERE length(l) > 1 OR length(r) > 1 GROUP BY 1, 2),
f AS (SELECT pr.l || pr.r AS text, reading, pr.n, sources FROM pr LEFT JOIN ac ON pr.l = ac.l AND pr.r = ac.r WHERE length(pr.l) = 1 AND length(pr.r) = 1 AND coalesce(ac.n, 0) <= 0.5 * pr.n),
k AS (SELECT *, row_number() OVER w AS k, first(n) OVER w AS top FROM f WHERE sources >= 4 AND text NOT IN (SELECT text FROM lex) WINDOW w AS (PARTITION BY reading ORDER BY n DESC, text)) SELECT text, reading, n, sources, k::INT AS k FROM k WHERE k = 1 OR (k = 2 AND n * 2.0 > top)""")
def strong_single_pairs(spark, d):
    p = contexts_of_pairs(spark, d)
    cross = p.where((F.length("left") > 1) | (F.length("right") > 1)).groupBy(F.right("left", F.lit(1)).alias("left"), F.left("right", F.lit(1)).alias("right")).agg(F.sum("n").alias("n"))
    return transitions.strong_single_pairs(p, lex(spark, d), cross).select("text", "reading", "n", "sources", "k")


@query()
def nbest_bigram_priors(spark, d):
    """Near-best segmentations of all stretches by the lexicon of the segmentation counts; a test checks them by brute force."""
    s, words = _stretches(spark, d)
    cut = segmentation.segmentations(s, words, mode="nearest").join(s, "stretch")
    return transitions.nbest_priors(cut.select("stretch", "n", "score", "pieces")).withColumn("weight", F.round("weight", 6))


# --- evaluation and validators ---

_AUD = f"""aw AS (SELECT *, substring(text, 1, 2) AS prefix, row_number() OVER (PARTITION BY substring(text, 1, 2) ORDER BY n DESC, text) AS k FROM wc), bc AS (SELECT a.prefix, a.text AS baseline, b.text AS challenger FROM aw a JOIN aw b ON a.prefix = b.prefix AND a.k = 1 AND b.k = 2),
{_EVN}, ae AS (SELECT before, ev.prefix, baseline, challenger, text AS chosen FROM ev JOIN bc USING (prefix) WHERE text IN (baseline, challenger)),
ax AS (SELECT *, unnest(generate_series(0, least(4, length(before)))) AS width FROM ae), ay AS (SELECT width::INT AS width, CASE WHEN width = 0 THEN '' ELSE substring(before, length(before) - width + 1, width) END AS context, prefix, baseline, challenger, chosen FROM ax),
ag AS (SELECT width, context, prefix, baseline, challenger, count(*) FILTER (chosen = baseline) AS keep, count(*) FILTER (chosen = challenger) AS switch FROM ay GROUP BY ALL),
au AS (SELECT *, switch / (keep + switch) AS share, keep + switch >= CASE width WHEN 0 THEN 3 WHEN 1 THEN 5 ELSE 4 END AS enough FROM ag)"""


def audit_events(spark, d):
    w = Window.partitionBy("prefix").orderBy(F.desc("n"), "text")
    top = word_counts(spark, d).withColumn("prefix", F.substring("text", 1, 2)).withColumn("k", F.row_number().over(w)).where("k <= 2")
    two = top.groupBy("prefix").agg(F.max(F.when(F.col("k") == 1, F.col("text"))).alias("baseline"), F.max(F.when(F.col("k") == 2, F.col("text"))).alias("challenger")).where("challenger IS NOT NULL")
    docs = table(spark, d, "documents").select(keys.words(F.col("text")).alias("w"))
    cells = F.transform("w", lambda x, i: F.struct(F.when(i == 0, "").otherwise(F.get(F.col("w"), i - 1)).alias("before"), F.substring(x, 1, 2).alias("prefix"), x.alias("chosen")))
    return docs.select(F.inline(cells)).join(two, "prefix").where((F.col("chosen") == F.col("baseline")) | (F.col("chosen") == F.col("challenger")))


@query(f"""WITH {_WC}, {_AUD} SELECT width, context, prefix, baseline, challenger, keep, switch, CASE WHEN enough AND share >= 0.85 THEN 1 ELSE 0 END AS decision, round_even(1000 * greatest(share, 1 - share), 0)::INT AS confidence FROM au WHERE NOT (enough AND share <= 1 - 0.85)""")
def pair_audit(spark, d):
    return evaluation.pair_audit(audit_events(spark, d))


@query(f"""WITH {_WC}, {_AUD} SELECT width, count(*) AS n FROM au WHERE NOT (enough AND share <= 1 - 0.85) GROUP BY 1""")
def rows_by_width(spark, d):
    return evaluation.by_width(evaluation.pair_audit(audit_events(spark, d)))


def counted(violations):
    return violations.groupBy("rule").agg(F.count("*").alias("n"))


@query(f"WITH {_WC}, {_AUD}, x AS (SELECT * FROM au WHERE NOT (enough AND share <= 1 - 0.85)) SELECT rule, n FROM (SELECT 'not_unique' AS rule, count(*) * 2 AS n FROM x WHERE width = 0 UNION ALL SELECT 'confidence', count(*) FROM x WHERE width = 1) WHERE n > 0")
def pair_audit_violations(spark, d):
    rows = evaluation.pair_audit(audit_events(spark, d))
    bad = rows.unionByName(rows.where("width = 0")).withColumn("confidence", F.when(F.col("width") == 1, 1001).otherwise(F.col("confidence")))
    return counted(validation.pair_audit(bad))


@query(f"WITH {_LEX} SELECT rule, n FROM (SELECT 'text' AS rule, count(*) FILTER (n % 4 = 1) AS n FROM lex UNION ALL SELECT 'scope', count(*) FILTER (n % 4 = 2) FROM lex UNION ALL SELECT 'reading', count(*) FILTER (n % 4 = 3) FROM lex UNION ALL SELECT 'weight', count(*) FILTER (n % 8 = 4) FROM lex) WHERE n > 0")
def dictionary_violations(spark, d):
    k = F.col("n") % 4
    rows = lex(spark, d).select(F.when(k == 3, F.concat("reading", F.lit("'"))).otherwise(F.col("reading")).alias("reading"), F.when(k == 1, "").otherwise(F.col("text")).alias("text"), F.when(F.col("n") % 8 == 4, "x").otherwise(F.col("weight").cast("string")).alias("weight"), F.when(k == 2, "other").alias("scope"))
    return counted(validation.dictionary(rows))


@query(f"""WITH {_TOK}, {_EVN}, x AS (SELECT *, unnest(generate_series(0, least(4, length(before)))) AS width FROM ev), y AS (SELECT width, CASE WHEN width = 0 THEN '' ELSE substring(before, length(before) - width + 1, width) END AS context, prefix, text FROM x),
g AS (SELECT width, context, prefix, text, count(*) AS c FROM y GROUP BY ALL) SELECT rule, n FROM (SELECT 'width' AS rule, count(*) FILTER (width = 4) AS n FROM g UNION ALL SELECT 'sources', count(*) FILTER (c % 5 = 0) FROM g) WHERE n > 0""")
def competition_violations(spark, d):
    rows = competition_prior(spark, d).withColumn("reading", F.col("text"))
    rows = rows.withColumn("sources", F.when(F.col("occurrences") % 5 == 0, 17).otherwise(F.col("sources"))).withColumn("width", F.when(F.col("width") == 4, 5).otherwise(F.col("width")))
    return counted(validation.competition(rows))


@query(f"""WITH {_LEX}, k AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY reading) AS c FROM lex WINDOW w AS (PARTITION BY reading ORDER BY weight DESC, text)), g AS (SELECT reading, min(c) AS c FROM k GROUP BY 1)
SELECT rule, n FROM (SELECT 'size' AS rule, count(*) FILTER (c = 1) AS n FROM g UNION ALL SELECT 'promoted_once', count(*) FILTER (c = 1) FROM g UNION ALL SELECT 'baseline_first', count(*) FILTER (length(reading) % 2 = 0) FROM g) WHERE n > 0""")
def short_promotion_violations(spark, d):
    top = lexicon.bucket_top(rtw(spark, d), 3).groupBy("reading").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("text").alias("word"), "weight"))).alias("candidates"))
    first = F.when(F.length("reading") % 2 == 0, "another").otherwise(F.col("candidates")[0]["word"])
    rows = top.select(F.col("reading").alias("prefix"), first.alias("baseline"), F.coalesce(F.get("candidates", F.lit(1))["word"], F.lit("none")).alias("promoted"), "candidates")
    return counted(validation.short_promotion(rows))


@query(f"WITH {_LEX} SELECT 'format' AS rule, count(*) AS n FROM lex WHERE n % 2 = 0 HAVING count(*) > 0")
def override_violations(spark, d):
    line = F.concat(F.col("text"), F.when(F.col("n") % 2 == 0, " ").otherwise("\t"), F.col("reading"))
    return counted(validation.overrides(lex(spark, d).select(line.alias("line"))))


@query(f"""WITH {_LEX}, {_S2}, x AS (SELECT * FROM s2 WHERE n >= 3) SELECT rule, n::BIGINT AS n FROM (SELECT 'counts' AS rule, count(*) FILTER (n % 3 = 0) AS n FROM x UNION ALL SELECT 'recall_rows', sum(c) FILTER (c > 24) FROM (SELECT count(*) AS c FROM x GROUP BY words[1])
UNION ALL SELECT 'visible_rows', sum(c) FILTER (c > 8) FROM (SELECT count(*) AS c FROM x GROUP BY words[1])) WHERE n > 0""")
def long_completion_violations(spark, d):
    x = stored(scored(spark, d, 2).select("words", "n", "evidence", "source_count"))  # checked as it is, and as shown
    rows = x.select(F.slice("words", 1, 1).alias("anchor"), F.slice("words", 2, 1).alias("suffix"), F.slice("words", 2, 1).alias("syllables"), F.when(F.col("n") % 3 == 0, 0).otherwise(F.col("evidence")).alias("evidence"), F.col("source_count").alias("sources"), F.lit(True).alias("visible"))
    return counted(validation.long_completion(rows))


@query("SELECT id AS source FROM (VALUES ('a', 'MIT'), ('b', 'GPL-3.0'), ('c', 'CC BY-SA 4.0'), ('d', 'Apache 2.0')) v(id, licence) WHERE licence LIKE '%GPL%' OR licence LIKE '%SA%'")
def licence_violations(spark, d):
    manifest = [{"id": i, "license": x} for i, x in (("a", "MIT"), ("b", "GPL-3.0"), ("c", "CC BY-SA 4.0"), ("d", "Apache 2.0"))]
    return spark.createDataFrame([(x,) for x in validation.licences(manifest, "permissive")], "source string")


@query("SELECT * FROM (VALUES ('missing', 'manifest.json'), ('forbidden', 'cache/a.zip'), ('forbidden', 'raw/corpus.txt')) v(rule, name)")
def file_violations(spark, d):
    names = ["dictionary.tsv", "cache/a.zip", "raw/corpus.txt", "README.md"]
    return spark.createDataFrame(validation.files(names, ["dictionary.tsv", "manifest.json"], ["*.zip", "raw/*"]), "rule string, name string")


@query(f"WITH {_WC}, {_CONV}, c AS (SELECT word, count(*) AS n FROM ctok GROUP BY 1) SELECT text AS word, n FROM wc UNION ALL SELECT word, n FROM c WHERE word NOT IN (SELECT text FROM wc)")
def counts_added_only(spark, d):
    chat = counting.tokens(table(spark, d, "conversations"), ["conv_id"]).groupBy("word").agg(F.count("*").alias("n"))
    return incremental.added_only(word_counts(spark, d).withColumnRenamed("text", "word"), chat)


@query(f"WITH {_WC} SELECT text, round(ln((n + 0.5) / (SELECT sum(n) FROM wc)), 9) AS cost FROM wc")
def word_costs(spark, d):
    wc = word_counts(spark, d)
    total = wc.agg(F.sum("n").alias("total"))
    return wc.join(F.broadcast(total)).select("text", F.round(F.log((F.col("n") + 0.5) / F.col("total")), 9).alias("cost"))  # one row


# --- rescoring ---


@query(f"""WITH {_TOK}, v AS (SELECT word AS text, lang AS day, count(*) AS n FROM tok GROUP BY 1, 2), g AS (SELECT text, count(DISTINCT day) AS days, sum(n) AS total, max(n) AS top FROM v GROUP BY 1)
SELECT text, days, round(1 - top / total, 6) AS persistence, days >= 3 AND top > 4.0 * (total - top) / greatest(1, days - 1) AS burst FROM g""")
def view_bursts(spark, d):
    return rescoring.burst(tok(spark, d).groupBy(F.col("word").alias("text"), F.col("lang").alias("day")).agg(F.count("*").alias("n")))


@query(f"WITH {_LEX}, {_CONV}, c AS (SELECT word AS text, count(*) AS hits FROM ctok GROUP BY 1) SELECT reading, text, (weight + coalesce(least(60, 10 * floor(log2(1 + hits))::INT), 0))::BIGINT AS weight FROM lex LEFT JOIN c USING (text)")
def rescored_lexicon(spark, d):
    chat = counting.tokens(table(spark, d, "conversations"), ["conv_id"]).groupBy(F.col("word").alias("text")).agg(F.count("*").alias("hits"))
    return rescoring.rescored(rtw(spark, d), chat)


@query(f"WITH {_LEX} SELECT reading, text, (CASE WHEN row_number() OVER (PARTITION BY reading ORDER BY weight DESC, text) > 3 THEN greatest(1, floor(weight * 80 / 100)) ELSE weight END)::BIGINT AS weight FROM lex")
def damped_homophones(spark, d):
    return rescoring.damped_homophones(rtw(spark, d))


@query(f"WITH {_LEX}, r AS (SELECT reading, {_PLAIN} AS text, max(weight) AS weight FROM lex GROUP BY 1, 2) SELECT reading, text, (CASE WHEN row_number() OVER (PARTITION BY text ORDER BY weight DESC, reading) > 1 THEN floor(weight * 50 / 100) ELSE weight END)::BIGINT AS weight FROM r")
def damped_readings(spark, d):
    r = rtw(spark, d).groupBy("reading", plain().alias("text")).agg(F.max("weight").alias("weight"))
    return rescoring.damped_readings(r)


@query(f"WITH {_LEX} SELECT reading, text, weight FROM lex WHERE length(text) <= 2 OR weight >= 100 OR text LIKE 'e%'")
def pruned_tail(spark, d):
    return rescoring.pruned_tail(rtw(spark, d), 100, lex(spark, d).where("text LIKE 'e%'"))


@query(f"""WITH {_LEX}, b AS (SELECT text AS p, max(weight) AS w FROM lex GROUP BY 1), x AS (SELECT reading, text, substring(text, 1, i) AS p FROM (SELECT *, unnest(generate_series(greatest(1, length(text) - 3), length(text) - 1)) AS i FROM lex WHERE length(text) > 1)),
l AS (SELECT reading, text, min(w) - 1 AS most FROM x JOIN b USING (p) GROUP BY 1, 2) SELECT lex.reading, lex.text, greatest(0, least(weight, coalesce(most, weight)))::BIGINT AS weight FROM lex LEFT JOIN l ON lex.reading = l.reading AND lex.text = l.text""")
def capped_extensions(spark, d):
    return rescoring.capped_extensions(rtw(spark, d))


@query(r"""WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages) SELECT page_id, CASE WHEN contains(title, ':') THEN 'namespace' WHEN regexp_matches(title, '[()]') THEN 'bracketed' WHEN title LIKE 'The %' THEN 'list' WHEN NOT regexp_matches(title, '^[\p{L} ,.]{2,60}$') THEN 'shape' ELSE '' END AS reason FROM t""")
def title_filter(spark, d):
    t = table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    return rescoring.titles(t, F.col("title"), r"^[\p{L} ,.]{2,60}$", ("The ",)).select("page_id", "reason")


@query(f"WITH {_LEX} SELECT DISTINCT text, regexp_replace(text, '(ing|ed|s)$', '') AS alias FROM lex WHERE regexp_replace(text, '(ing|ed|s)$', '') <> text AND length(regexp_replace(text, '(ing|ed|s)$', '')) >= 2")
def place_aliases(spark, d):
    return rescoring.place_aliases(lex(spark, d), ("ing", "ed", "s"))


@query(f"""WITH {_LEX}, {_CONV}, x AS (SELECT *, first(text) OVER (PARTITION BY reading ORDER BY weight DESC, text) AS top FROM lex), r AS (SELECT reading, text, weight, CASE WHEN weight >= 200 AND text NOT IN (SELECT word FROM ctok) THEN 'unsupported' WHEN text <> top AND starts_with(text, top) THEN 'extends_top' END AS reason FROM x) SELECT * FROM r WHERE reason IS NOT NULL""")
def suspicious_rows(spark, d):
    chat = counting.tokens(table(spark, d, "conversations"), ["conv_id"]).select(F.col("word").alias("text"))
    return rescoring.suspicious(rtw(spark, d), chat)

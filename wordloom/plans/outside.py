"""Queries of the readers of archives, dumps and remote answers: the given tables go out in the format and are read back whole."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions import generators, keys, syllables
from wordloom.functions.bounded import read_bounded, settled
from wordloom.operators import fragments, variants
from wordloom.plans.catalogue import _A, _B, _FRAG, _LEX, lex, query, table
from wordloom.plans.exchange import folder
from wordloom.sources import archives, external, publishing, remote
from wordloom.sources.readers import bindings
from wordloom.streaming import stateful

_PLAIN = r"[\x00-\x08\x0B\x0C\x0E-\x1F￾￿]"
_PLAIN_SQL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"


def escaped(c):
    """Text as XML: what XML can't hold becomes a space."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


@query("SELECT doc_id, length(coalesce(text, '')) AS characters, md5(coalesce(text, '')) AS digest FROM documents")
def zip_directory_scan(spark, d):
    """Documents as members of archives that several tasks write; members are read by ranges."""
    docs = table(spark, d, "documents").select(F.concat("doc_id", F.lit(".txt")).alias("member"), "text")
    found = archives.directory(archives.write_archives(docs, folder(spark, "archives")))
    parts = archives.members(found, chunk=1 << 16)
    whole = parts.groupBy("source").agg(F.expr("listagg(text, '') WITHIN GROUP (ORDER BY part)").alias("text"))
    whole = found.select(F.concat_ws("!", "path", "member").alias("source")).join(whole, "source", "left")  # an empty member has no part
    text = F.coalesce("text", F.lit(""))
    return whole.select(F.regexp_extract("source", r"!(\d+)\.txt$", 1).cast("long").alias("doc_id"), F.length(text).cast("long").alias("characters"), F.md5(text.cast("binary")).alias("digest"))


@query(r"SELECT doc_id, k - 1 AS line, md5(l[k]) AS digest FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS k FROM (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '\n$', ''), '\r?\n') AS l FROM documents WHERE text <> ''))")
def zip_lines_scan(spark, d):
    """Lines of members that are read in small pieces: lines that cross pieces are put together."""
    docs = table(spark, d, "documents").where("text <> ''").select(F.concat("doc_id", F.lit(".txt")).alias("member"), "text")
    rows = archives.member_lines(archives.members(archives.directory(archives.write_archives(docs, folder(spark, "archives"))), chunk=4096))
    line = F.row_number().over(Window.partitionBy("source").orderBy("part", "n")) - 1
    return rows.select(F.regexp_extract("source", r"!(\d+)\.txt$", 1).cast("long").alias("doc_id"), line.cast("long").alias("line"), F.md5(F.col("line").cast("binary")).alias("digest"))


@query("SELECT p_name AS text, p_partkey::BIGINT AS n FROM part")
def pinned_members_scan(spark, d):
    """Lines ``text  number`` of the members of one archive whose digest, taken by a task, is the one given."""
    rows = table(spark, d, "part").select(F.concat_ws("  ", "p_name", "p_partkey").alias("line"), F.pmod(F.col("p_partkey"), F.lit(7)).alias("k"))
    text = rows.groupBy("k").agg(F.array_join(F.sort_array(F.collect_list("line")), "\r\n").alias("text"))
    found = archives.write_archives(text.select(F.concat("k", F.lit(".txt")).alias("member"), "text").coalesce(1), folder(spark, "pinned"))
    return archives.pinned_rows(found, archives.digests(found).first().sha256)


@query("SELECT c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey END::BIGINT AS links FROM customer")
def paged_answers_scan(spark, d):
    """Exported pages of answers through the data source; pages past the end are asked for and are empty."""
    v = lambda c: F.struct(c.cast("string").alias("value"))
    c = table(spark, d, "customer")
    row = F.struct(v(F.col("c_name")).alias("name"), v(F.when(F.col("c_custkey") % 3 == 0, F.lit("no number")).otherwise(F.col("c_custkey").cast("string"))).alias("links"))
    numbered = c.select(((F.row_number().over(Window.partitionBy((F.col("c_custkey") / 1000).cast("int")).orderBy("c_custkey")) - 1) / 100).cast("int").alias("k"), (F.col("c_custkey") / 1000).cast("int").alias("part"), row.alias("b"))
    pages = numbered.groupBy("part", "k").agg(F.to_json(F.struct(F.struct(F.collect_list("b").alias("bindings")).alias("results"))).alias("value"))
    path = folder(spark, "answers")
    pages.withColumn("page", F.col("part") * 10 + F.col("k")).select("value", "page").write.partitionBy("page").text(path)
    last = pages.agg(F.max(F.col("part") * 10 + F.col("k"))).first()[0]
    spark.dataSource.register(remote.PagedAnswers)
    read = spark.read.format("paged_answers").options(url=path, page_size="1", pages=str(last + 3), pages_each="5", requests=json.dumps([{}])).load()
    return bindings(read.select(F.col("body").alias("page")), ["name"], ["links"])


@query("SELECT 'D' || p_partkey AS ui, p_name AS name, p_brand AS tree, CASE WHEN p_name = p_type THEN 1 ELSE 2 END::BIGINT AS terms FROM part")
def mesh_scan(spark, d):
    """Descriptors, their names twice among the terms, in bzip2 files that are split."""
    p, x = table(spark, d, "part"), lambda c: escaped(F.col(c))
    term = lambda c: F.concat(F.lit("<Term><String>"), x(c), F.lit("</String></Term>"))
    record = F.concat(
        F.lit("<DescriptorRecord DescriptorClass = \"1\"><DescriptorUI>D"), "p_partkey", F.lit("</DescriptorUI><DescriptorName><String>"), x("p_name"), F.lit("</String></DescriptorName>\n<TreeNumberList><TreeNumber>"), x("p_brand"),
        F.lit("</TreeNumber></TreeNumberList>\n<ConceptList><Concept><TermList>"), term("p_name"), F.lit("</TermList></Concept><Concept><TermList>"), term("p_type"), term("p_name"), F.lit("</TermList></Concept></ConceptList></DescriptorRecord>"),
    )
    path = folder(spark, "mesh")
    p.select(record.alias("value")).write.option("compression", "bzip2").text(path)
    return external.mesh(spark, path).select("ui", "name", F.col("trees")[0].alias("tree"), F.size("terms").cast("long").alias("terms"))


@query(rf"SELECT doc_id AS id, (doc_id % 3)::INT AS ns, 'Title ' || doc_id AS title, CASE WHEN doc_id % 5 = 0 THEN coalesce(lang, 'none') END AS redirect, md5(regexp_replace(coalesce(text, ''), '{_PLAIN_SQL}', ' ', 'g')) AS digest FROM documents")
def wiki_page_scan(spark, d):
    """Documents as pages of an export, whole texts."""
    docs = table(spark, d, "documents")
    text = escaped(F.regexp_replace(F.coalesce("text", F.lit("")), _PLAIN, " "))
    redirect = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit('<redirect title="'), escaped(F.coalesce("lang", F.lit("none"))), F.lit('" />'))).otherwise("")
    page = F.concat(F.lit("  <page>\n    <title>Title "), "doc_id", F.lit("</title>\n    <ns>"), F.col("doc_id") % 3, F.lit("</ns>\n    <id>"), "doc_id", F.lit("</id>\n"), redirect, F.lit('<revision><id>1</id><text xml:space="preserve">'), text, F.lit("</text></revision>\n  </page>"))
    path = folder(spark, "pages")
    docs.select(page.alias("value")).write.option("compression", "bzip2").text(path)
    return external.wiki_pages(spark, path).select("id", "ns", "title", "redirect", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("SELECT p_name AS title FROM part")
def title_list_scan(spark, d):
    path = folder(spark, "titles")
    rows = table(spark, d, "part").select(F.translate("p_name", " ", "_").alias("value"))
    rows.unionByName(spark.createDataFrame([("page_title",), ("",)], "value string")).write.option("compression", "gzip").text(path)
    return external.wiki_titles(spark, path)


@query("SELECT event_type AS title, sum(user_id + 1)::BIGINT AS views FROM events WHERE user_id % 4 < 2 GROUP BY 1")
def page_view_scan(spark, d):
    e = table(spark, d, "events")
    project = F.when(F.col("user_id") % 4 == 0, "zh").when(F.col("user_id") % 4 == 1, "zh.m").when(F.col("user_id") % 4 == 2, "zhx").otherwise("de")
    path = folder(spark, "views")
    rows = e.select(F.concat_ws(" ", project, "event_type", (F.col("user_id") + 1).cast("string"), F.lit("0")).alias("value"))
    rows.unionByName(spark.createDataFrame([("zh broken",), ("zh no number 0",)], "value string")).write.option("compression", "gzip").text(path)
    return external.page_views(spark, path, "zh")


@query("WITH c AS (SELECT unnest(string_split(coalesce(text, ''), '')) AS c, doc_id FROM documents) SELECT c AS char, 'kFrequency' AS field, count(*)::VARCHAR AS value FROM c WHERE c > ' ' GROUP BY 1")
def unihan_scan(spark, d):
    """Character counts as a field of a character database."""
    c = table(spark, d, "documents").select(F.explode(F.split("text", "")).alias("c")).where("c > ' '").groupBy("c").agg(F.count("*").alias("n"))
    digits = F.regexp_replace(F.hex(F.encode("c", "UTF-32")), "^0+", "")
    code = F.lpad(digits, F.greatest(F.length(digits), F.lit(4)), F.lit("0"))
    path = folder(spark, "unihan")
    rows = c.select(F.concat(F.lit("U+"), code, F.lit("\tkFrequency\t"), "n").alias("value"))
    rows.unionByName(spark.createDataFrame([("# comment",), ("",)], "value string")).write.text(path)
    return external.unihan(spark, path)


@query(f"WITH {_LEX} SELECT text AS word, weight::BIGINT AS n, CASE WHEN n >= 3 THEN reading END AS tag FROM lex")
def tagged_word_scan(spark, d):
    path = folder(spark, "tagged")
    lex(spark, d).select(F.concat_ws(" ", "text", F.col("weight").cast("long").cast("string"), F.when(F.col("n") >= 3, F.col("reading"))).alias("value")).write.text(path)
    return external.tagged_words(spark, path)


@query(f"WITH {_LEX} SELECT reading AS form, text AS target, row_number() OVER (PARTITION BY reading ORDER BY text)::INT AS rank FROM lex")
def conversion_scan(spark, d):
    path = folder(spark, "conversions")
    rows = lex(spark, d).groupBy("reading").agg(F.array_join(F.sort_array(F.collect_list("text")), " ").alias("t"))
    rows.select(F.concat_ws("\t", "reading", "t").alias("value")).write.text(path)
    return external.conversions(spark, path)


@query("""SELECT 'http://x/' || item_id AS subject, 'http://x/text' AS predicate, text AS object, 'en' AS lang FROM benchmark
UNION ALL SELECT 'http://x/' || item_id, 'http://x/next', 'http://x/' || (item_id + 1), NULL FROM benchmark""")
def triple_scan(spark, d):
    b = table(spark, d, "benchmark")
    node = lambda c: F.concat(F.lit("<http://x/"), c, F.lit(">"))
    literal = F.expr("substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)")
    rows = b.select(F.concat_ws(" ", node("item_id"), F.lit("<http://x/text>"), F.concat(literal, F.lit("@en")), F.lit(".")).alias("value"))
    rows = rows.unionByName(b.select(F.concat_ws(" ", node("item_id"), F.lit("<http://x/next>"), node(F.col("item_id") + 1), F.lit(".")).alias("value")))
    path = folder(spark, "triples")
    rows.write.option("compression", "gzip").text(path)
    return external.triples(spark, path)


@query("SELECT 'part/' || s_suppkey AS document, s_name AS title FROM supplier")
def search_index_scan(spark, d):
    path = folder(spark, "index")
    s = table(spark, d, "supplier").groupBy((F.col("s_suppkey") / 500).cast("int").alias("k")).agg(F.collect_list(F.concat(F.lit("part/"), "s_suppkey")).alias("docnames"), F.collect_list("s_name").alias("titles"))
    s.select(F.concat(F.lit("Search.setIndex("), F.to_json(F.struct("docnames", "titles")), F.lit(");")).alias("value"), "k").write.partitionBy("k").text(path)
    return external.search_index(spark, path)


@query(f"WITH {_FRAG} SELECT chunk, first(doc_id ORDER BY doc_id, sentence, run, part) AS doc_id FROM f GROUP BY 1")
def streamed_first_fragments(spark, d):
    """The first of equal fragments by a stream that is stopped and started again: documents come in three lots, by id."""
    rows, path = fragments.chunks(table(spark, d, "documents"), keys.LATIN, ["doc_id"]), folder(spark, "stream")
    cuts = table(spark, d, "documents").approxQuantile("doc_id", [1 / 3, 2 / 3], 0.01)
    lots = [F.col("doc_id") <= cuts[0], (F.col("doc_id") > cuts[0]) & (F.col("doc_id") <= cuts[1]), F.col("doc_id") > cuts[1]]
    for k, lot in enumerate(lots):
        rows.where(lot).write.parquet(f"{path}/in/{k}")
        stateful.first_wins(stateful.files(spark, f"{path}/in", rows.schema), "chunk", ["doc_id", "sentence", "run", "part"], f"{path}/out", f"{path}/state")
    return stateful.result(spark, f"{path}/out").select("chunk", "doc_id")


_PH = "ph AS (SELECT DISTINCT text AS form, '<' || upper(left(text, 1)) || '>' AS target FROM lex WHERE length(text) BETWEEN 2 AND 6 AND n >= 50 AND regexp_matches(text, '^[a-z]+$'))"


@query(f"""WITH RECURSIVE {_LEX}, {_PH}, w AS (SELECT DISTINCT text FROM lex), po AS (SELECT text, unnest(range(0, length(text))) AS p0 FROM w),
sn AS (SELECT text, p0, max(struct_pack(k := k, target := target)) AS m FROM (SELECT *, unnest(range(2, 7)) AS k FROM po) x JOIN ph ON substring(text, p0 + 1, k) = form AND length(form) = k GROUP BY 1, 2),
g AS (SELECT text, 0 AS p0, '' AS converted, 0 AS n, 0 AS units FROM w UNION ALL
 SELECT g.text, g.p0 + coalesce(m.k, 1), converted || coalesce(m.target, translate(substring(g.text, g.p0 + 1, 1), '{_A}', '{_B}')), n + (m IS NOT NULL)::INT, units + coalesce(m.k, 0)
 FROM g LEFT JOIN sn ON g.text = sn.text AND g.p0 = sn.p0 WHERE g.p0 < length(g.text))
SELECT text, converted, n::BIGINT AS phrases, units::BIGINT AS units FROM g WHERE p0 = length(text)""")
def phrase_first_forms(spark, d):
    """Words converted by the longest phrases first, then by characters."""
    x = lex(spark, d)
    phrases = x.where(F.length("text").between(2, 6) & (F.col("n") >= 50) & F.col("text").rlike("^[a-z]+$")).select(F.col("text").alias("form"), F.concat(F.lit("<"), F.upper(F.left("text", F.lit(1))), F.lit(">")).alias("target")).distinct()
    out = variants.phrase_first(x.select("text").distinct(), "text", phrases, dict(zip(_A, _B)))
    units = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return out.select("text", "converted", F.size("spans").cast("long").alias("phrases"), units.alias("units"))


_SY = "sy AS (SELECT DISTINCT reading AS s FROM lex WHERE length(reading) BETWEEN 1 AND 4 AND n >= 30)"


@query(f"""WITH RECURSIVE {_LEX}, {_SY}, r AS (SELECT DISTINCT reading FROM lex),
e AS (SELECT reading, a, list(k ORDER BY k) AS ks FROM (SELECT reading, unnest(range(0, length(reading))) AS a FROM r) p, range(1, 5) t(k) WHERE a + k <= length(reading) AND substring(reading, a + 1, k) IN (SELECT s FROM sy) GROUP BY 1, 2),
dp AS (SELECT reading, length(reading) AS a, [1::BIGINT] AS w, [0::BIGINT] AS f, [1::BIGINT] AS fw, [''] AS p FROM r UNION ALL
 SELECT reading, a - 1, list_prepend(coalesce(m.w, 0), w), list_prepend(coalesce(m.f, 0), f), list_prepend(coalesce(m.fw, 0), fw), list_prepend(coalesce(m.p, ''), p)
 FROM (SELECT dp.*, (SELECT struct_pack(w := sum(o.w)::BIGINT, f := min(o.f) + 1, fw := (sum(o.fw) FILTER (o.f = o.least))::BIGINT, p := arg_min(substring(dp.reading, dp.a, o.k) || ' ' || o.p, struct_pack(f := o.f, k := -o.k)))
   FROM (SELECT *, min(q.f) OVER () AS least FROM (SELECT k, dp.w[k] AS w, dp.f[k] AS f, dp.fw[k] AS fw, dp.p[k] AS p FROM (SELECT unnest(e.ks) AS k)) q WHERE q.w > 0) o) AS m
  FROM dp LEFT JOIN e ON e.reading = dp.reading AND e.a = dp.a - 1 WHERE dp.a > 0))
SELECT reading, CASE WHEN w[1] > 0 THEN trim(p[1]) ELSE '' END AS syllables, w[1] AS ways, fw[1] AS fewest FROM dp WHERE a = 0""")
def parsed_readings(spark, d):
    """Readings as syllables, and in how many ways they can be read; the syllables are the short readings that occur often."""
    x = lex(spark, d)
    table = [r.reading for r in read_bounded(x.where(F.length("reading").between(1, 4) & (F.col("n") >= 30)).select("reading").distinct(), 27**4)]
    out = x.select("reading").distinct().withColumn("r", syllables.parsed(F.col("reading"), table))
    return out.select("reading", F.coalesce(F.array_join("r.syllables", " "), F.lit("")).alias("syllables"), "r.ways", "r.fewest")


@query("SELECT doc_id, unnest(regexp_extract_all(lower(text), '[aeinorst]+')) AS stretch FROM documents")
def stretches_in_sql(spark, d):
    generators.register(spark)
    table(spark, d, "documents").createOrReplaceTempView("wordloom_documents")
    return spark.sql("SELECT doc_id, s.stretch FROM wordloom_documents, LATERAL stretches(lower(text), 'aeinorst') s")


@query(r"WITH r AS (SELECT doc_id, regexp_replace(text, '[\n\r]+', ' ', 'g') AS r FROM documents), p AS (SELECT doc_id, r, unnest(range(0, CASE WHEN length(r) <= 40 THEN 1 ELSE length(r) - 7 END, 36)) AS p0 FROM r WHERE length(r) >= 8) SELECT doc_id, (p0 / 36)::INT AS part, substring(r, p0 + 1, 40) AS fragment FROM p")
def fragments_in_sql(spark, d):
    generators.register(spark)
    table(spark, d, "documents").createOrReplaceTempView("wordloom_documents")
    return spark.sql("SELECT doc_id, f.* FROM wordloom_documents, LATERAL fragments(regexp_replace(text, '[\n\r]+', ' '), 8, 40, 4) f")


@query(f"WITH {_LEX}, a AS (SELECT reading, text, weight FROM lex WHERE n >= 3), b AS (SELECT reading, text, weight FROM lex) SELECT 'first' AS version, count(*) AS n, sum(weight)::BIGINT AS weight FROM a UNION ALL SELECT 'refused', count(*), sum(weight)::BIGINT FROM a UNION ALL SELECT 'second', count(*), sum(weight)::BIGINT FROM b")
def published_versions(spark, d):
    """A lexicon published twice; a version that a check refuses leaves the one before it."""
    x, path = lex(spark, d).select("reading", "text", "weight", "n"), folder(spark, "published")

    def seen(name):
        return publishing.read(spark, path).agg(F.lit(name).alias("version"), F.count("*").alias("n"), F.sum("weight").cast("long").alias("weight"))

    publishing.publish(x.where("n >= 3").drop("n"), path)
    out = [settled(seen("first"))]
    try:
        publishing.publish(x.drop("n"), path, {"short words": lambda new: new.where("length(text) >= 1")})
    except publishing.NotPublished:
        out.append(settled(seen("refused")))
    publishing.publish(x.drop("n"), path, {"no reading": lambda new: new.where("reading = ''")})
    return reduce(DataFrame.unionByName, [*out, seen("second")])

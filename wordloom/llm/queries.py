"""The corpus operators' queries, and the SQL for those that SQL can express."""

from __future__ import annotations

from wordloom.llm.bpe_codec import op4_bpe_codec
from wordloom.llm.exact import op7_exact_dedup
from wordloom.llm.jaccard import op9_ngram_jaccard_join
from wordloom.llm.language import op2_language_id
from wordloom.llm.lines import op5_line_dedup
from wordloom.llm.packing import op10_packing
from wordloom.llm.pii import op11_personal_data
from wordloom.llm.quality import op1_quality_classifier
from wordloom.llm.runs import op12_periodic_runs
from wordloom.llm.spelling import op13_spelling_variants
from wordloom.llm.substrings import op8_substring_dedup
from wordloom.llm.token_counts import op3_token_counts
from wordloom.llm.topk import op6_top_k

QUERIES = {
    f.__name__: f
    for f in (op1_quality_classifier, op2_language_id, op3_token_counts, op4_bpe_codec, op5_line_dedup, op6_top_k, op7_exact_dedup, op8_substring_dedup, op9_ngram_jaccard_join, op10_packing, op11_personal_data, op12_periodic_runs, op13_spelling_variants)
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op5_line_dedup": f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, i, lines[i] AS line FROM (SELECT *, unnest(generate_series(1, len(lines))) AS i FROM s)),
k AS (SELECT *, {_LOWER.format("regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', '')")} AS key FROM l),
c AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (c.key IS NOT NULL AND c.keep <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL OR c.keep = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN c USING (key) GROUP BY k.doc_id
""",
    "op6_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS w FROM embeddings),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM p QUALIFY rank <= 20
""",
    "op7_exact_dedup": f"""
WITH t AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS x FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
""",
    "op8_substring_dedup": """
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, k, sha256(array_to_string(w[k:k + 12], ' ')) AS h
      FROM (SELECT *, unnest(generate_series(1, len(w) - 12)) AS k FROM t WHERE len(w) >= 13)),
f AS (SELECT h, min(doc_id) AS least FROM s GROUP BY h),
r AS (SELECT DISTINCT doc_id, unnest(generate_series(k, k + 12)) AS i FROM s JOIN f USING (h) WHERE least < doc_id),
p AS (SELECT doc_id, i, w[i] AS word FROM (SELECT *, unnest(generate_series(1, len(w))) AS i FROM t)),
g AS (SELECT p.doc_id, count(*) FILTER (r.i IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY p.i) FILTER (r.i IS NULL) AS kept
      FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.i = r.i GROUP BY p.doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN g USING (doc_id)
""",
    "op13_spelling_variants": f"""
WITH RECURSIVE t AS (SELECT list(list_reduce([i] || range(8), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t FROM range(256) r(i)),
r AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
x AS (SELECT run, n, hex(encode(coalesce(doc_id::TEXT, '') || ':' || run)) AS x FROM r),
b AS (SELECT run, n, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS b FROM x),
h AS (SELECT run, n, xor(list_reduce([4294967295] || b, lambda c, y: xor(c // 256, t.t[xor(c, y) % 256 + 1])), 4294967295) AS h FROM b, t),
c AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM c WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS (SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS d FROM (SELECT *, unnest(range(1, length(word) + 1)) AS k FROM w)),
i AS (SELECT DISTINCT d.word AS a, w.word AS b FROM d JOIN w ON d.d = w.word),
p AS (SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.d = b.d AND a.k = b.k AND a.word <> b.word UNION ALL SELECT a, b FROM i UNION ALL SELECT b, a FROM i),
m AS (SELECT a, count(*) AS n_near, max(n) AS top FROM p JOIN w ON p.b = w.word GROUP BY a),
g AS (SELECT m.a, min(w.word) AS form FROM m JOIN p USING (a) JOIN w ON p.b = w.word AND w.n = m.top GROUP BY m.a),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * w.n THEN form END AS form, CASE WHEN top >= 5 * w.n THEN top END AS form_n
      FROM w LEFT JOIN m ON w.word = m.a LEFT JOIN g ON w.word = g.a),
u AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT u.word, f.word, f.form FROM u JOIN f ON u.next = f.word)
SELECT f.word, f.form, u.at AS root, f.n, f.n_near, f.form_n FROM f JOIN u ON f.word = u.word AND u.next IS NULL
""",
}

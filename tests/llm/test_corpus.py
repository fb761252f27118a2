import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from wordloom.llm import bpe_codec, exact, jaccard, language, lines, packing, quality, queries, substrings, token_counts, topk
from wordloom.llm.common import read_table

PACKED: list = []
EDGE = [(1, "A b\nc  d "), (2, None), (3, ""), (4, " \n\t"), (5, "A b\nc  d "), (6, "é" * 300), (None, "x y"), (7, "word " * 3000), (7, "word " * 3000), (None, None), (8, "日本語 <|endoftext|> ①\u0085z")]


@pytest.fixture(scope="session")
def edge(spark):
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in EDGE], "doc_id long, text string, n_words string, score int")
    return df


@pytest.mark.parametrize("name", sorted(set(queries.ORACLES) - {"op13_spelling_variants"}))
def test_query_agrees_with_sql(spark, duck, name):
    assert rows(queries.QUERIES[name](spark, SMALL)) == duck(queries.ORACLES[name])


def texts(spark, n=120):
    return [(r.doc_id, r.text) for r in read_table(spark, SMALL, "documents").orderBy("doc_id").limit(n).collect()]


def odd_texts():
    r = random.Random(3)
    return ["".join(r.choice("ab eéÉ\n\t▁ßΣσς中\U0001F600'.!<>|0x́\x1c\x85\xa0sdt ") for _ in range(r.randint(0, 60))) for _ in range(1500)]


def test_quality_on_held_out_rows(spark):
    big = SMALL.replace("0.001", "0.01")
    out = queries.op1_quality_classifier(spark, big).join(read_table(spark, big, "labels"), "doc_id").where("held_out").toPandas()
    good, bad = out[out.quality == 1].score.values, out[out.quality == 0].score.values
    assert (good[:, None] > bad[None, :]).mean() > 0.97 and (good >= 0.7).mean() > 0.98


def test_quality_edges(spark, edge):
    none = spark.createDataFrame([], "doc_id long, label int")
    model = quality.fit(edge.select("doc_id", "text"), none)
    out = quality.quality_scores(edge, model, carry=["n_words"]).collect()
    assert len(out) == len(EDGE) and all(0 <= r.score <= 1 for r in out)


def test_quality_of_long_words(spark):
    word = "".join(random.Random(8).choice("abcdefgh日") for _ in range(9000))
    raw = f"<{word}>".encode()
    whole = [zlib.crc32(word.encode()), *(zlib.crc32(raw[i : i + n], n) for n in (3, 4, 5) for i in range(len(raw) - n + 1))]
    assert Counter(quality.features(word)) == Counter(x & (quality.BUCKETS - 1) for x in whole)
    weights = np.random.default_rng(1).normal(size=quality.BUCKETS).astype(np.float32)
    docs = spark.createDataFrame([(1, word), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, (weights, 0.1)).collect()}
    for i, w in ((1, word), (2, "short")):
        f = quality.features(w)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(weights[f].astype(float).sum() / (len(f) + quality.CALM) + 0.1))))


def test_language_on_held_out_rows(spark):
    big = SMALL.replace("0.001", "0.01")
    out = queries.op2_language_id(spark, big).join(read_table(spark, big, "documents").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.98


def test_language_edges(spark, edge):
    out = language.languages(edge, {}).collect()
    assert {r.lang_pred for r in out} == {"und"} and len(out) == len(EDGE)


def test_every_language_is_learned(spark):
    name = lambda k: chr(97 + k // 26) + chr(97 + k % 26)
    docs = spark.createDataFrame([(k, name(k) * 4, name(k)) for k in range(205)], "doc_id long, text string, lang string").coalesce(1).cache()
    assert sorted(language.fit(docs)) == sorted(name(k) for k in range(205))
    with pytest.raises(ValueError):
        language.fit(docs, most=204)


def test_short_texts_fill_the_characters(spark):
    docs = spark.createDataFrame([(k, f"{'abcdefghij'[k % 10]} word", "q") for k in range(3000)], "doc_id long, text string, lang string").coalesce(2)
    assert language.fit(docs)["q"][2] == 3000 * 7 + 1
    assert 0.95 * 5000 < language.fit(docs, chars=5000)["q"][2] * 6 / 7 <= 5001


def test_languages_of_long_documents_learn_too(spark):
    docs = spark.createDataFrame([(1, "abc " * 50, "q"), (2, "abd " * 40, "q"), (3, "x", "r"), (None, "yz", "r"), (4, "12", "s"), (5, None, "t")], "doc_id long, text string, lang string")
    model = language.fit(docs, chars=100)
    assert sorted(model) == ["q", "r"] and model["q"][2] == 101 and model["r"][2] == 6  # q: 25 words of 100 characters, between spaces


def test_phrases_of_a_huge_word(spark):
    model = {k: language.SuffixAutomaton(t).flat() for k, t in (("a", " " + "abc " * 250), ("b", " " + "я" * 1000 + " "))}
    docs = spark.createDataFrame([(1, "я" * 1_048_600), (2, "abc abc")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language.languages(docs, model).collect()} == {1: "b", 2: "a"}


def naive_phrases(ref, text):
    """Longest matches by plain search."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while text[i:j] in ref and j < len(text) and text[i : j + 1] in ref:
            j += 1
        n, i = n + 1, j
    return n


def test_phrases_are_longest_matches():
    r = random.Random(5)
    for _ in range(200):
        ref, text = ("".join(r.choice("abc ") for _ in range(n)) for n in (30, 20))
        text += "z" * r.randint(0, 1)
        assert language.Parser([language.SuffixAutomaton(ref).flat()]).counts([text]).tolist() == [[naive_phrases(ref, text)]]


def test_texts_in_step_and_alone(monkeypatch):
    r = random.Random(3)
    word = lambda abc, n: "".join(r.choice(abc) for _ in range(n))
    refs = [" " + word("abc ", 200), " " + word("bcdé ", 150)]
    p = language.Parser([language.SuffixAutomaton(x).flat() for x in refs])
    texts_ = [word("abcdéz ", r.randint(1, 60)) for _ in range(60)]
    want = [[naive_phrases(x, t) for x in refs] for t in texts_]
    assert p.counts(texts_).tolist() == want
    monkeypatch.setattr(language, "LONG", 20)
    assert p.counts(texts_).tolist() == want


def test_large_alphabets_take_little_memory():
    r = random.Random(6)
    han = [chr(0x4E00 + k) for k in range(4000)]
    refs = [" " + "".join(r.choice(han) for _ in range(20_000)) + " "] + [" " + "".join(r.choice("abcdefghijklmnopqrst"[k:]) for _ in range(20_000)) + " " for k in range(5)]
    p = language.Parser([language.SuffixAutomaton(x).flat() for x in refs])
    arcs = sum(len(language.SuffixAutomaton(x).arcs) for x in refs)
    assert len(p.arcs.cells) < 3 * arcs + p.width and p.arcs.cells.nbytes + p.arcs.base.nbytes + p.first.nbytes + p.column.nbytes < 20_000_000
    texts_ = [x[i : i + 40] + "日z" for x in refs for i in (0, 500, 19_000)]
    assert p.counts(texts_).tolist() == [[naive_phrases(x, t) for x in refs] for t in texts_]


def test_language_against_brute_force(spark):
    """The whole prediction, from the formula: fewest phrases times the logarithm of the learned length."""
    r = random.Random(9)
    refs = {k: " " + " ".join("".join(r.choice(abc) for _ in range(r.randint(1, 6))) for _ in range(80)) + " " for k, abc in (("p", "abcde"), ("q", "defgh"), ("r", "abgh"))}
    docs = [(i, " ".join("".join(r.choice("abcdefghz½2é") for _ in range(r.randint(1, 7))) for _ in range(r.randint(0, 30)))) for i in range(150)]
    docs += [(200, "½ ² ① Ⅷ 12 .,"), (201, None), (202, ""), (203, "e\u0301a ÀB"), (204, "abc" * 2000)]
    model = {k: language.SuffixAutomaton(t).flat() for k, t in refs.items()}
    got = {x.doc_id: (x.lang_pred, x.score) for x in language.languages(spark.createDataFrame(docs, "doc_id long, text string"), model).collect()}
    import unicodedata

    for i, t in docs:
        plain = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (t or "").lower())
        words = plain.split()
        if not any(unicodedata.category(c)[0] == "L" for c in plain):
            assert got[i] == ("und", 0.0)
            continue
        text = " " + " ".join(words) + " "
        rate = {k: naive_phrases(ref, text) * np.log2(len(ref) + 2) / (len(text) - 1) for k, ref in refs.items()}
        best = min(rate, key=lambda k: (rate[k], k))
        assert got[i][0] == best and got[i][1] == pytest.approx(1 / sum(np.exp(-4 * (x - rate[best])) for x in rate.values()))
    assert language.languages(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_token_counts(spark):
    import sentencepiece

    c, lib = token_counts.counter(P.path("piece_bpe_32k.model")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for t in [t for _, t in texts(spark)] + odd_texts():
        assert c.count(t) == len(lib.encode(t))


def test_token_counts_edges(spark, edge):
    out = {(r.doc_id, r.n_bytes) for r in token_counts.token_counts(edge, P.path("piece_bpe_32k.model")).collect() if not r.n_tokens}
    assert out == {(2, 0), (3, 0), (None, 0)}


def test_codec(spark):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    lib, c = Tokenizer.from_file(path), bpe_codec.codec(path)
    known = Counter(w for _, t in texts(spark) for w in c.words(t)).most_common(300)
    e = bpe_codec.Encoder(path, bpe_codec.Lexicon(bpe_codec.compiled({w: tuple(c.encode(w)) for w, _ in known})))
    assert all(e.lexicon.find(w) == c.encode(w) for w, _ in known) and e.lexicon.find("qzqzqz") is None
    for t in [t for _, t in texts(spark)] + odd_texts():
        ids = lib.encode(t, add_special_tokens=False).ids
        assert e.encode(t) == (np.array(ids, dtype="<u4").tobytes(), lib.decode(ids, skip_special_tokens=False))


def test_codec_edges_and_sharing(spark, edge):
    assert bpe_codec.bpe_encode(edge, P.path("word_bpe_49k.json")).count() == len(EDGE)
    t = bpe_codec.Transducer([b"bats", b"cats", b"rats"])
    assert t.states == 5  # the ends of the three words are one path
    empty = bpe_codec.Lexicon(bpe_codec.compiled({}))
    assert empty.find("a") is None


def brute_lines(docs, min_docs=5):
    keys = lambda t: [k.encode().lower() if len(k) >= 40 else None for k in (x.strip(" \t\n\v\f\r") for x in (t or "").split("\n"))]
    held = defaultdict(list)
    for i, t in docs:
        for k in {*keys(t)} - {None}:
            held[k].append(-1 if i is None else i)
    gone = lambda i, k: k is not None and len(held[k]) >= min_docs and max(held[k]) != (-1 if i is None else i)
    return sorted((-1 if i is None else i, "\n".join(x for x, k in zip((t or "").split("\n"), keys(t)) if not gone(i, k))) for i, t in docs)


@pytest.mark.parametrize("room", [1 << 20, 64, 0])
def test_lines_however_many_keys_are_shared(spark, room):
    r = random.Random(7)
    pool = [f"{'Line' if k % 2 else 'line'} {k} that is shared and longer than forty characters" for k in range(12)]
    docs = [(i, "\n".join(r.choice(["\t", ""]) + (x.upper() if r.random() < 0.3 else x) for x in r.sample(pool, r.choice([1, 2, 3])))) for i in range(40)]
    docs += [(i, pool[0] + f"\nown {i}\n" + "x" * 39) for i in range(40, 70)] + [(70, None), (None, ""), (None, pool[0]), (5, pool[1])]
    out = lines.line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), broadcast_bytes=room, shards=3)
    assert sorted((-1 if x.doc_id is None else x.doc_id, x.text) for x in out.collect()) == brute_lines(docs)


def test_lines_edges(spark, edge):
    assert lines.line_dedup(edge, carry=["score"]).count() == len(EDGE)
    assert lines.line_dedup(edge.limit(0)).count() == 0
    assert lines.line_dedup(edge, broadcast_bytes=0).count() == len(EDGE)


def test_perfect_hash_is_minimal():
    k = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64))
    for a, b in ((k, k[::-1]), (k, k * 0), (k * 0, k)):  # equal halves part by the other half
        assert sorted(lines.PerfectHash.of(a, b).index(a, b).tolist()) == list(range(len(k)))
    with pytest.raises(ValueError):
        lines.PerfectHash.of(np.array([5, 5], dtype=np.uint64), np.array([7, 7], dtype=np.uint64))


def test_top_k_edges(spark):
    v = [(i, [float(x) / 7 for x in ((i * 3) % 5, i % 3, -(i % 2))]) for i in range(60)] + [(60, None), (61, [None, 1.0, 1.0]), (62, [float("nan"), 0.0, 0.0]), (63, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>")
    out = defaultdict(list)
    for r in topk.top_k(df.where("vec_id % 20 = 0"), df, k=7, blocks=3).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
    w = {i: [int(np.floor(64 * float(np.float32(x)))) for x in e] for i, e in v[:60]}
    for q in (0, 20, 40):
        want = sorted(((i, sum(a * b for a, b in zip(w[q], w[i]))) for i in w if i != q), key=lambda x: (-x[1], x[0]))[:7]
        assert out[q] == want
    assert set(out) == {0, 20, 40}
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    twice = df.where("vec_id < 3").unionByName(df.where("vec_id < 3"))
    found = [tuple(r) for r in topk.top_k(twice.where("vec_id = 0").distinct(), twice, k=3).orderBy("rank").collect()]
    assert [r[:2] for r in found] == [(0, 1), (0, 2), (0, 3)] and all(r[2] in (1, 2) for r in found)


def test_top_k_large_weights():
    r = np.random.default_rng(1)
    w, ids = r.integers(-(1 << 60), 1 << 60, (50, 4)), np.arange(50)
    q = np.array([[1, 0, -1, 0]])
    exact_scores = sorted((sum(-int(a) * int(b) for a, b in zip(q[0], x)), i) for i, x in enumerate(w))[:3]
    _, v, s = topk.Postings(ids, w).best(np.array([99]), q, 3)
    assert sorted(zip((-s).tolist(), v.tolist())) == exact_scores
    with pytest.raises(OverflowError):
        topk.Postings(ids, w).best(np.array([99]), w[:1], 3)
    with pytest.raises(OverflowError):
        topk.weights(pa.array([[1e30]]), 64)


def test_exact_edges_and_huge_texts(spark, edge):
    docs = edge.select("doc_id", "text")
    assert rows(exact.fingerprints(docs, huge=100)) == rows(exact.fingerprints(docs))
    out = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_dedup(edge).collect()}
    assert exact.exact_dedup(edge.limit(0)).count() == 0
    assert {(1, 5, 2, False), (5, 5, 2, True), (2, 3, 3, False), (3, 3, 3, True), (7, 7, 2, True), (None, 3, 3, False), (None, None, 1, True)} <= out


def test_texts_beyond_the_huge_limit_take_linear_time(spark):
    import time

    def took(n):
        docs = spark.createDataFrame([(1,), (2,), (None,)], "doc_id long").withColumn("text", F.concat(F.expr(f"repeat('éA', {n})"), F.coalesce("doc_id", F.lit(1)).cast("string")))
        began = time.time()
        r = {x.doc_id: x for x in exact.fingerprints(docs).collect()}
        assert r[1].n_bytes == 3 * n + 1 and (r[1].fp, r[1].text_sha256) == (r[None].fp, r[None].text_sha256) != (r[2].fp, r[2].text_sha256)
        assert r[2].text_sha256 == hashlib.sha256(("éa" * n + "2").encode()).hexdigest()
        return time.time() - began

    took(2_200_000)
    assert took(9_000_000) < 40


def test_chunks_of_huge_texts_are_compared(spark):
    docs = spark.createDataFrame([(1, "aB" * 60000), (2, "Ab" * 60000), (3, "ab" * 60000), (4, "x"), (5, "X"), (6, "y")], "doc_id long, text string")
    found = exact.fingerprints(docs, huge=1000)
    groups = found.groupBy("fp", "n_bytes").agg(F.count("*").alias("n")).where("n > 1")
    assert groups.count() == 2 and exact.unlike_groups(docs, found, groups, huge=1000).count() == 0
    wrong = docs.unionByName(spark.createDataFrame([(7, "ab" * 59999 + "ac")], docs.schema))
    fp = found.where("doc_id = 1").first()
    more = found.unionByName(exact.fingerprints(wrong.where("doc_id = 7"), huge=1000).withColumn("fp", F.lit(fp.fp)))
    assert [tuple(r) for r in exact.unlike_groups(wrong, more, groups, huge=1000).collect()] == [(fp.fp, fp.n_bytes)]


def test_bitmap_marks_every_group(spark):
    r = random.Random(5)
    fps = [r.randrange(1 << 62) for _ in range(20000)]
    raw = np.frombuffer(exact.bitmap(spark.createDataFrame([(x,) for x in fps], "fp long")), np.uint8)
    at = exact._slot(np.array(fps), 8 * len(raw))
    assert (raw[at >> 3] >> (at & 7).astype(np.uint8) & 1).all() and np.unpackbits(raw).mean() < 0.2


def test_fingerprints_combine():
    a, b = b"abc" * 50, b"xyz" * 9
    assert exact.fingerprint(a + b) == exact.combine(exact.fingerprint(a), exact.fingerprint(b), len(b))


def test_equal_fingerprints_of_unlike_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "b", "A", "b", "c"])], "doc_id long, text string")
    true = exact.fingerprints(docs)
    monkeypatch.setattr(exact, "fingerprints", lambda d, huge=0: true.withColumns({"fp": F.lit(1).cast("long"), "n_bytes": F.lit(1).cast("long")}))
    same = {"fp": F.lit(1).cast("long"), "n_bytes": F.lit(1).cast("long")}
    plain = exact._members
    monkeypatch.setattr(exact, "_members", lambda d, marks: plain(d, b"\xff" * len(marks)).withColumns(same))
    out = sorted((r.doc_id, r.keep_id, r.group_size) for r in exact.exact_dedup(docs).collect())
    assert out == [(0, 2, 2), (1, 3, 2), (2, 2, 2), (3, 3, 2), (4, 4, 1)]


def brute_passages(docs, w=13):
    first, toks = {}, [(i, (t or "").encode().split()) for i, t in docs]
    for i, x in toks:
        for k in range(len(x) - w + 1):
            key = tuple(x[k : k + w])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, x in toks:
        gone = {j for k in range(len(x) - w + 1) if first[tuple(x[k : k + w])] < i for j in range(k, k + w)}
        out[i] = (len(x), len(gone), hashlib.sha256(b" ".join(y for j, y in enumerate(x) if j not in gone)).hexdigest())
    return out


def test_passages_with_runs(spark, edge):
    r = random.Random(8)
    docs = [(i, " ".join(r.choice("ab") if r.random() < 0.9 else r.choice("xyz") for _ in range(r.randint(0, 60)))) for i in range(60)]
    docs += [(60, "a " * 40), (61, "b b " + "a " * 12 + "b"), (62, "b b b " + "a " * 14), (63, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = substrings.substring_dedup(df, blocks=4).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256))
    assert {x[0]: tuple(x[1:]) for x in out.collect()} == brute_passages(docs)
    kept = substrings.substring_dedup(edge, carry=["score"], untouched=True)
    assert kept.count() == len(EDGE) and substrings.substring_dedup(edge.limit(0)).count() == 0


def brute_links(docs):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("group", [768, 15])
def test_similar_texts(spark, group):
    r = random.Random(2)
    base = [[r.choice("abcdefgh") for _ in range(r.randint(3, 60))] for _ in range(6)]
    docs = []
    for i in range(250):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 3, 6])):
            w[r.randrange(len(w))] = r.choice("abcdefghXYZ")
        docs.append((i, " ".join(w)))
    docs += [(400, None), (401, ""), (402, " \n"), (403, "one two"), (404, "One  TWO")]
    out = jaccard.similar(spark.createDataFrame(docs, "doc_id long, text string"), blocks=4, group=group)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out.collect()} == brute_links(docs)


def test_similar_edges(spark, edge):
    assert jaccard.similar(edge).count() == len(EDGE)
    assert jaccard.similar(edge.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "u v w x y z"), (3, "u v w x y z"), (None, "a b c d e f")], "doc_id long, text string")
    assert sorted((x.n_shingles, x.component_id or -1) for x in jaccard.similar(twice).collect()) == [(2, -1), (2, -1), (2, 1), (2, 1)]


def test_links_do_not_depend_on_the_order_of_rows():
    r = random.Random(4)
    sets = [np.unique(np.array([r.randrange(9) if r.random() < 0.1 else k for k in range(10, 40)], dtype="<u8")) for _ in range(12)]
    found = set()
    for _ in range(20):
        order = r.sample(range(12), 12)
        t = jaccard.links_of(jaccard.pa.table({"id": order, "set": [sets[i].tobytes() for i in order]}))
        found.add(tuple(sorted(zip(t.column("a").to_pylist(), t.column("b").to_pylist()))))
    assert len(found) == 1 and len(found.pop()) > 5


def test_components_of_links_that_turn_round(spark, tmp_path):
    def links(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                mark = tmp_path / str(i)
                turned = mark.exists()
                mark.touch()
                a, b = 2 * i, 2 * i + 1
                yield jaccard.pa.record_batch({"a": [b if turned else a], "b": [a if turned else b]})

    out = jaccard.components(spark.range(5).mapInArrow(links, "a long, b long"))
    assert sorted(map(tuple, out.collect())) == [(i, i - i % 2) for i in range(10)]


def test_near_copies_that_share_an_id(spark):
    import corpus_pipeline as C

    near = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    docs = [(5, near + " two"), (5, near + " one"), (5, near.upper() + " ONE"), (9, near), (5, "another text of the same id"), (6, "Another text of THE same id")]
    docs += [(None, "no id at all here"), (None, "no id at all here"), (7, "no id at all here"), (8, ""), (8, ""), (10, "alone with its words")]
    df = spark.createDataFrame([(*d, k) for k, d in enumerate(docs)], "doc_id long, text string, k int")
    out = C.near_copy_stage(spark, df, SMALL)
    assert out.columns == df.columns
    # of equal ids the first by text: upper case sorts before lower
    assert sorted(r.k for r in out.collect()) == [2, 4, 6, 7, 9, 10, 11]


def test_packing(spark, edge):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = texts(spark, 200) + [(1000, None), (1001, "x " * 9000), (1002, "日本語 <|endoftext|>\n\n a"), (1003, "")]
    out = packing.pack(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), P.path("byte_bpe_50k.json")).collect()
    ids = {i: np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for i, t in docs}
    at, fill = defaultdict(int), defaultdict(int)
    for r in sorted(out, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert at == {i: len(x) for i, x in ids.items()} and max(fill.values()) <= 2048
    padding = sum(2048 - n for n in fill.values() if n & (n - 1))
    assert padding < 0.01 * sum(fill.values())
    assert packing.pack(edge, P.path("byte_bpe_50k.json")).where("start = 0").count() == len(EDGE)


def test_packing_keeps_the_order_of_a_small_table(spark, tmp_path):
    """A table of one file and over a megabyte, which other queries deal over the cores."""
    text = "".join(random.Random(1).choice("abcdefghij ") for _ in range(400))
    spark.range(6000).coalesce(1).selectExpr("id AS doc_id", f"concat('{text}', sha2(cast(id AS string), 512)) AS text").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op10_packing(spark, str(tmp_path)).collect()
    assert [r.doc_id for r in out] == sorted(r.doc_id for r in out) and len({r.doc_id for r in out}) == 6000
    assert [r.sequence_id for r in out] == sorted(r.sequence_id for r in out)


def test_cuts_against_brute_force():
    r = random.Random(6)
    late = 0
    for _ in range(400):
        n, window = r.randint(1, 40), 16
        position = np.cumsum([r.randint(1, 7) for _ in range(n)]).tolist()
        penalty = [r.choice([0, 2, 12]) for _ in range(n - 1)] + [0]
        known = dict(zip(position, penalty))
        best = {0: 0}
        for p in position:
            best[p] = min(best[j] + window + known[p] for j in best if p - j <= window)
        power = lambda t: t & (t - 1) == 0
        end = position[-1]

        def tail(j):
            out, p = end - j, j
            while p < end:
                p += 1 << ((end - p).bit_length() - 1)
                out += known.get(p, packing.BROKEN) if p < end else 0
            return min(out, end - j if power(end - j) else window)

        want = min(best[j] + tail(j) for j in best if 0 < end - j <= window)

        def cost(ends):
            total, a = 0, 0
            for b in ends:
                t = b - a
                total += (t if power(t) and end - a <= window else window) + (0 if b == end else known.get(b, packing.BROKEN))
                a = b
            return total

        whole = packing.Cutter(window)
        whole.extend(position, penalty)
        ends = whole.final()
        ends = ends + whole.finish()
        assert ends[-1] == end and all(0 < b - a <= window for a, b in zip([0, *ends], ends)) and cost(ends) <= want
        pieces, parts, i = packing.Cutter(window), [], 0
        while i < n:
            k = r.randint(1, 6)
            pieces.extend(position[i : i + k], penalty[i : i + k])
            parts += pieces.final()
            i += k
        late += len(parts) > 2
        assert parts + pieces.finish() == ends
    assert late > 100


@pytest.mark.parametrize("rows_each", [1, 7, 500])
def test_packing_does_not_depend_on_batches(spark, rows_each):
    docs = spark.createDataFrame(texts(spark, 200) + [(1001, "x " * 9000), (1002, "abc" * 20000)], "doc_id long, text string").coalesce(1)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_each)
    try:
        out = sorted(map(tuple, packing.pack(docs, P.path("byte_bpe_50k.json")).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    PACKED.append(out)
    assert out == PACKED[0]


def brute_pipeline(docs, kept):
    """The stages from line dedup to passages in plain Python, over (doc_id, text) rows with unlike ids that quality kept."""
    docs = [(i, t) for i, t in docs if i in kept]
    after_lines = dict(brute_lines(docs))
    links = brute_links(sorted(after_lines.items()))
    alone = {i: t for i, t in after_lines.items() if links[i][1] == i}
    words = brute_passages(sorted(alone.items()))
    return after_lines, alone, words


@pytest.fixture(scope="session")
def stages(spark, tmp_path_factory):
    """What each stage returns for a table with columns that clash with the operators' own."""
    import corpus_pipeline as C

    docs = read_table(spark, SMALL, "documents").withColumns({"score": F.lit(1), "kept_id": F.lit("k"), "row": F.lit(2.0), "b": F.lit(0), "size": F.lit(9)})
    out = {"documents": docs}
    for name, stage in C.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        new = stage(spark, docs, SMALL)
        assert name == "packing" or new.columns == docs.columns
        new.write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def test_pipeline_against_brute_force(spark, stages):
    from tokenizers import Tokenizer

    texts_of = lambda name: {r.doc_id: r.text for r in stages[name].select("doc_id", "text").collect()}
    before = [(r.doc_id, r.text) for r in stages["documents"].select("doc_id", "text").collect()]
    model = quality.fit(stages["documents"].select("doc_id", "text"), quality.labelled(spark, SMALL))
    scores = {r.doc_id: r.score for r in quality.quality_scores(stages["documents"].select("doc_id", "text"), model).collect()}
    kept = {i for i, s in scores.items() if s >= quality.THRESHOLD}
    assert set(texts_of("quality")) == kept and 0 < len(kept) < len(before)
    after_lines, alone, words = brute_pipeline(before, kept)
    assert texts_of("lines") == after_lines
    assert texts_of("near_copies") == alone and len(alone) < len(after_lines)
    passages = texts_of("passages")
    assert set(passages) == set(alone) and any(gone for _, gone, _ in words.values())
    for i, (_, gone, sha) in words.items():
        assert passages[i] == alone[i] if not gone else hashlib.sha256((passages[i] or "").encode()).hexdigest() == sha
    assert all(r.n_chars == len(r.text or "") for r in stages["passages"].select("n_chars", "text").collect())
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    sizes = {i: len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in passages.items()}
    got = {r.doc_id: r.n for r in stages["packing"].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == sizes


def test_pipeline_runs_as_a_query(spark, stages):
    import corpus_pipeline as C

    out = C.run(spark, SMALL)
    assert out.groupBy().agg(F.sum("length")).first()[0] == stages["packing"].groupBy().agg(F.sum("length")).first()[0]


def _morse(n, a="a", b="b"):
    """Two sequences that differ in every place and agree in every polynomial hash modulo 2**64 with an odd base."""
    one = [a if bin(i).count("1") % 2 else b for i in range(n)]
    return one, [b if x == a else a for x in one]


@pytest.fixture(scope="module")
def morse_rows():
    """Unlike words of 1,024 letters, unlike passages of 1,024 words, and one true copy."""
    one, two = ("".join(x) for x in _morse(1024))
    p, q = (" ".join(x) for x in _morse(1024, "north", "southern-most"))
    start = " ".join(f"w{i}" for i in range(12))
    return [(1, one), (2, two), (3, f"{start} {one}"), (4, f"{start} {two}"), (5, p), (6, q), (7, one)]


def test_passages_of_words_made_to_collide(spark, morse_rows):
    df = spark.createDataFrame(morse_rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substrings.substring_dedup(df).collect()}
    words = {i: t.split() for i, t in morse_rows}
    expected = {}
    for i, w in words.items():
        seen = {tuple(words[j][k : k + 13]) for j in words if j < i for k in range(len(words[j]) - 12)}
        gone = {k + x for k in range(len(w) - 12) if tuple(w[k : k + 13]) in seen for x in range(13)}
        expected[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    assert got == expected and got[4][1] == 0


def test_sets_of_words_made_to_collide(spark, morse_rows):
    df = spark.createDataFrame(morse_rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.similar(df).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: got[6], 7: 1}  # 3 and 4 share eight of ten shingles
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in morse_rows}
    assert got[6] == (5 if 100 * len(sets[5] & sets[6]) >= 80 * len(sets[5] | sets[6]) else 6)


def test_stages_of_words_made_to_collide(spark, morse_rows):
    import corpus_pipeline

    df = spark.createDataFrame(morse_rows[:4], "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    for stage, n in ((corpus_pipeline.near_copy_stage, 2), (corpus_pipeline.passage_stage, 4)):
        assert sorted((r.doc_id, r.text) for r in stage(spark, df.where(F.col("doc_id") <= n), "").collect()) == morse_rows[:n]


def test_word_hashes():
    from wordloom.llm.common import Words

    texts = pa.array(["a a\x00 b ab abcdefgh abcdefghi abcdefgh\x00 abcdefghijklmnop abcdefghijklmnopq abcdefghijklmno", None, "abcdefghi é ab", "x" * 100_000 + " " + "x" * 100_001])
    w = Words(texts, seed=5)
    words = [bytes(w.data[a:b]) for a, b in zip(w.start, w.end)]
    for h in (w.hash, w.check, zip(w.hash.tolist(), w.check.tolist())):
        h = list(h)
        assert len(set(zip(words, h))) == len(set(words)) == len(set(h))
    assert not set(w.hash.tolist()) & set(Words(texts, seed=6).hash.tolist())

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SMALL
from wordloom.llm import queries, runs, spelling
from wordloom.llm.common import read_table

EDGE = [(1, "a b " * 20), (2, None), (3, ""), (4, " \n\t"), (1, "a b " * 20), (None, "x " * 30), (7, "long " * 50_000), (None, None), (20, " ".join(f"w{i}" for i in range(100)))]


def whole_runs(w, least):
    """By every period: stretches that agree with themselves q places on, unless a smaller period explains them."""
    _, v = np.unique(np.array(w, dtype=object).astype(str), return_inverse=True) if w else (None, np.zeros(0, int))
    out = []
    for q in range(1, len(v) // 2 + 1):
        same = np.concatenate(([0], (v[:-q] == v[q:]).astype(int), [0]))
        begin, end = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for s, e in zip(begin.tolist(), end.tolist()):
            n = e - s + q
            if n >= max(least, 2 * q) and not any((v[s : s + n - p] == v[s + p : s + n]).all() for p in range(1, q) if q % p == 0):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected_row(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + k % p] for k in range(n - a)]
    found = whole_runs(w, 12)
    gone = {k for s, m, q in found for k in range(s + q, s + m)}
    s, m, q = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return i, len(found), s, m, q, 1000 * m // q if q else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(" ".join(x for k, x in enumerate(w) if k not in gone))


def as_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()), key=repr)


def test_periodic_runs_query_against_brute_force(spark):
    docs = [tuple(r) for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert as_rows(queries.op12_periodic_runs(spark, SMALL)) == sorted((expected_row(*d) for d in docs), key=repr)


def test_runs_of_small_alphabets():
    r = random.Random(1)
    for _ in range(300):
        docs = []
        for _ in range(r.randint(1, 5)):
            w = [r.randrange(r.choice([1, 2, 3, 5])) for _ in range(r.choice([0, 1, 2, 5, 20, 60]))]
            if len(w) > 3 and r.random() < 0.5:
                p, a = r.randint(1, len(w) // 2), r.randrange(len(w))
                w = w[:a] + [w[a + k % min(p, len(w) - a)] for k in range(len(w) - a)]
            docs.append(w)
        least, first = r.choice([2, 4, 12]), np.concatenate(([0], np.cumsum([len(d) for d in docs])))
        got = runs.runs_of(np.array([x for d in docs for x in d], dtype=np.int64), first, least)
        assert list(zip(*(x.tolist() for x in got))) == [(s + int(first[k]), n, q) for k, d in enumerate(docs) for s, n, q in whole_runs(d, least)]


def test_runs_edges(spark, tmp_path):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in EDGE], "doc_id long, text string, start string, runs int")
    got = {(r.doc_id, r.n_words): (r.text, [tuple(x) for x in r.runs]) for r in runs.collapse_runs(df).collect()}
    assert got[1, 40] == ("a b", [(0, 40, 2)]) and got[None, 30] == ("x", [(0, 30, 1)]) and got[7, 50_000] == ("long", [(0, 50_000, 1)])
    assert got[2, 0] == got[3, 0] == got[4, 0] == ("", []) and got[20, 100][1] == []
    assert runs.collapse_runs(df.limit(0)).count() == 0 and runs.collapse_runs(df).count() == len(EDGE)
    spark.createDataFrame([(i, t) for i, t in EDGE if t is None or len(t) < 1000], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert as_rows(queries.op12_periodic_runs(spark, str(tmp_path))) == sorted((expected_row(*d) for d in EDGE if d[1] is None or len(d[1]) < 1000), key=repr)


def test_range_minima():
    r = np.random.default_rng(3)
    for n in (1, 15, 16, 17, 500):
        v = r.integers(0, 99, n)
        a, b = np.sort(r.integers(0, n, (2, 300)), axis=0)
        assert runs.RangeMinimum(v).least(a, b).tolist() == [v[x : y + 1].min() for x, y in zip(a, b)]


def whole_pairs(counts):
    alphabet, out = {c for w in counts for c in w}, set()
    for w in counts:
        near = {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in alphabet} | {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in alphabet} | {w[:k] + w[k + 1 :] for k in range(len(w))}
        out |= {(w, counts[w], x, counts[x]) for x in near - {w} if x in counts}
    return out


def whole_forms(counts, ratio=5):
    near: dict = {}
    for w, _, x, m in whole_pairs(counts):
        near.setdefault(w, []).append((-m, x))
    form = {w: min(x)[1] for w, x in near.items() if -min(x)[0] >= ratio * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near.get(w, [])), counts[form[w]] if w in form else None) for w, n in counts.items())


def as_forms(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def _words(seed, n, longest):
    r = random.Random(seed)
    return {"".join(r.choice("abé") for _ in range(r.randint(1, longest))): int(10 ** r.uniform(0.7, 6)) for _ in range(n)}


@pytest.mark.parametrize("shard,asking", [(1 << 16, 1 << 18), (20, 7)])
def test_variants_against_brute_force(spark, shard, asking):
    counts = _words(5, 400, 7) | {"inter" + "abc"[k % 3] * (k % 4) + "xy" * (k % 5): 5 + k**3 for k in range(60)}
    got = as_forms(spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), shard=shard, asking=asking))
    assert got == whole_forms(counts)
    assert len({r[2] for r in got if r[2] not in (r[0], r[1])}) > 3  # forms of forms


def test_variants_however_the_words_are_cut():
    from bisect import bisect_right

    for seed in range(60):
        counts, shards = _words(seed, 80, 6), 1 + seed % 5
        cut = lambda keys: [keys[i * len(keys) // shards] for i in range(1, shards)]
        f, b = cut(sorted((len(w), w) for w in counts)), cut(sorted((len(w), w[::-1]) for w in counts))
        points, asked = {}, {}
        for w, n in counts.items():
            points.setdefault((0, bisect_right(f, (len(w), w))), []).append((w, n))
            points.setdefault((1, bisect_right(b, (len(w), w[::-1]))), []).append((w, n))
            for (side, s, length), p in spelling.asked_shards(w, f, b).items():
                asked.setdefault((side, s), []).append((w, n, length, np.array(p)))
        got = [x for k, q in asked.items() for x in spelling.near_pairs(points.get(k, []), q)]
        assert len(got) == len(set(got)) and set(got) == whole_pairs(counts)


def test_word_counts_edges(spark):
    long = "abcdefghij" * 20_000
    docs = [(1, "Straße ÉCOLE école ÷×÷×÷× naïveté x1y2 " * 5), (2, None), (3, ""), (None, "naïveté " * 3), (5, f"{long} " * 5), (6, f"{long[1:]} " * 30), (1, "日本語" * 9)]
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id long, text string, n int, word string")
    for every in (None, 3):
        expected: Counter = Counter()
        for i, t in docs:
            for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
                run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                expected[run if not every or h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
        expected = {w: n for w, n in expected.items() if len(w) >= 6 and n >= 5}
        assert {r.word: r.n for r in spelling.word_counts(df, every=every).collect()} == expected
    got = {r.word: r for r in spelling.spelling_variants(spelling.word_counts(df)).collect()}
    assert got[long].form == long[1:] and got[long[1:]].n_near == 1
    assert spelling.spelling_variants(spelling.word_counts(df.limit(0))).count() == 0


def test_spelling_query_agrees_with_sql(spark, duck):
    got = queries.op13_spelling_variants(spark, SMALL)
    named = [tuple("" if r[c] is None else str(r[c]) for c in sorted(got.columns)) for r in got.collect()]  # null counts stay whole numbers
    assert sorted(named) == duck(queries.ORACLES["op13_spelling_variants"])

import random
from collections import Counter
from fractions import Fraction
from itertools import product

import pytest
from pyspark.sql import functions as F

from wordloom.functions import keys
from wordloom.operators import segmentation
from wordloom.plans.catalogue import QUERIES


def cuts(text, words):
    if not text:
        yield ()
    for k in range(1, len(text) + 1):
        if k == 1 or text[:k] in words:
            for rest in cuts(text[k:], words):
                yield (text[:k], *rest)


def brute(counts, passes):
    """Counts of the pieces: longest first from the left, then fewest and likeliest by the counts of the pass before."""
    words, got = {w for w, n in counts.items() if len(w) >= 2 and n >= 20}, None
    for _ in range(passes):

        def rate(c):
            x = Fraction(1)
            for p in c:
                x *= 2 * got.get(p, 0) + 1
            return -len(c), x, [len(p) for p in c[::-1]]

        new = Counter()
        for text, n in counts.items():
            for p in max(cuts(text, words), key=rate if got else lambda c: [len(p) for p in c]):
                new[p] += n
        got = new
    return got


def pieces(spark, folder, name, counts):
    texts = [(k, "en", " ".join(w for w, n in counts.items() if n > k)) for k in range(max(counts.values()))]
    spark.createDataFrame(texts, "doc_id long, lang string, text string").write.parquet(f"{folder}/documents.parquet")
    return {r.piece: r.n for r in QUERIES[name](spark, str(folder)).collect()}


@pytest.mark.parametrize("name", ["greedy_segmentation_counts", "min_word_segmentation_counts"])
def test_lexicon_is_whole(spark, tmp_path, name):
    counts = {"".join(w): 20 for w in product("abcdefghijkl", repeat=4)} | {"llllkkk": 3, "lllllab": 1}
    assert len(counts) > 20_002
    assert pieces(spark, tmp_path, name, counts) == brute(counts, 1 if name.startswith("greedy") else 2)


@pytest.mark.parametrize("name, passes", [("greedy_segmentation_counts", 1), ("min_word_segmentation_counts", 6)])
def test_counts_that_settle_late(spark, tmp_path, name, passes):
    r = random.Random(22)
    counts = {"".join(r.choice("abc") for _ in range(r.randint(2, 4))): r.randint(20, 30) for _ in range(14)}
    for _ in range(40):
        counts.setdefault("".join(r.choice("abc") for _ in range(r.randint(5, 8))), r.randint(1, 19))
    assert brute(counts, 3) != brute(counts, 6)
    assert pieces(spark, tmp_path, name, counts) == brute(counts, passes)


def _cases(seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abc" if seed % 2 else "abcdé") for _ in range(n))
    stretches = [(word(r.choice([1, 2, 5, 9, 30])), r.randint(1, 9)) for _ in range(80)] + [(word(700), 2), ("", 3)]
    words = {word(r.randint(2, 5)): r.randint(0, 30) for _ in range(12)} | {word(300): 5, stretches[-2][0][100:420]: 4}
    return stretches, words


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("passes", [1, 2, 4])
def test_a_lexicon_that_stays_a_table_gives_the_same_counts(spark, seed, passes):
    stretches, words = _cases(seed)
    s, w = spark.createDataFrame(stretches, "stretch string, n long"), spark.createDataFrame([(x,) for x in words], "text string")
    got = [{r.piece: r.n for r in segmentation.reestimated(s, w, passes, most).collect()} for most in (100, 1)]
    assert got[0] == got[1] and got[0]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mode", ["greedy", "likeliest", "nearest"])
def test_a_lexicon_that_stays_a_table_gives_the_same_cuts(spark, seed, mode):
    stretches, words = _cases(seed)
    s, w = spark.createDataFrame([x for x in stretches if len(x[0]) < 100 or mode != "nearest"], "stretch string, n long"), spark.createDataFrame(list(words.items()), "text string, n long")
    row = lambda r: (r.stretch, r["rank"], round(r.score, 6), r.pieces)
    got = [sorted(row(r) for r in segmentation.segmentations(s, w, mode, most_words=most).collect()) for most in (100, 1)]
    assert got[0] == got[1]


def test_a_lexicon_is_measured_in_words_and_bytes(spark):
    w = spark.createDataFrame([("abc", 1), ("日本", 2)], "text string, n long")
    assert segmentation.fits(w, 2, 9) and not segmentation.fits(w, 1, 9) and not segmentation.fits(w, 2, 8) and segmentation.fits(w.limit(0), 0, 0)
    s = spark.createDataFrame([("abcab", 2)], "stretch string, n long")
    assert {r.piece: r.n for r in segmentation.piece_counts_of(s, w, most_words=1).collect()} == {"abc": 2, "a": 2, "b": 2}
    assert {r.piece: r.n for r in segmentation.piece_counts_of(s, w.where("n > 5"), most_words=-1).collect()} == {"a": 4, "b": 4, "c": 2}


def test_pieces_overlap(spark):
    text = "".join(random.Random(1).choice("aé日\U00020000\n") for _ in range(1003))
    for piece, more in ((10, 0), (10, 3), (7, 7), (2000, 5)):
        got = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(keys.overlapping(F.col("t"), piece, more)).collect()
        assert [r[0] for r in got] == [[text[i : i + piece + more] for i in range(0, len(text), piece)], [], None]

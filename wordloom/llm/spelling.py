"""Grouping of spelling variants by two-dimensional range reporting.

Two words are near if one code point inserted, deleted or replaced turns one into the other.  Take the words of one length in
forward order (x) and in the order of the reversed words (y): a word is a point, the words with a given prefix are an interval of
x, those with a given suffix one of y.  For each edit position of a word, what stands before it and what stands behind it give two
intervals; the points in both are the words that differ there: a wavelet matrix over y in the order of x reports them.  Replacements look
among the words of the same length, insertions among those one longer; a deletion is an insertion the other way round.  Of the
positions that lead to the same word only the first differing one counts, so that each pair is found once.

At scale the words lie in shards of about ``SHARD`` by forward order, and again by reverse order, cut at sampled words.  A word asks,
for each edit position, the shards that its prefix's interval meets or those that its suffix's interval meets, whichever are fewer;
mostly that is one.  A shard that is asked by more than ``ASKING`` words is copied, and the words are dealt over the copies, so neither a common beginning nor
a common length makes a large task.  Intervals are narrowed one code point at a time, so that very long words cost no more than their length.

A word's form is its near word of the largest count (ties: the smallest in code-point order) if that is at least ``RATIO`` times
its own; forms are followed by doubling to the root.  Counts grow by ``RATIO`` along forms, which bounds the rounds.

Counts are partial sums a task, summed by word.  Null texts have no words; repeated rows count each time; a row without an id has the empty text for its id.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import id_and_text, read_table, saved

LENGTH, COUNT, RATIO, ALTERED = 6, 5, 5, 199
SHARD, ASKING, SAMPLE = 1 << 16, 1 << 18, 32
HELD, AT_ONCE = 1 << 18, 1 << 18
PAST = "\U0010ffff"


def runs_of_letters(text: str | None, least: int = 1) -> list[str]:
    """The maximal runs of Latin letters of at least ``least`` code points, only A-Z lower-cased."""
    return re.findall(f"[a-zÀ-ÿ]{{{least},}}", text.encode().lower().decode()) if text else []


def altered(run: str, start: int, every: int) -> str:
    """The run, without one code point if ``every`` divides its crc32 after that of the id (start)."""
    h = zlib.crc32(run.encode(), start)
    return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, count: int = COUNT, every: int | None = None) -> DataFrame:
    """word, n of the words of at least ``length`` code points and ``count`` occurrences; ``every`` plants misspellings, one run in so many."""

    def run(batches):
        held: Counter = Counter()

        def out():
            yield pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{'' if i is None else i}:".encode())
                for r, n in Counter(runs_of_letters(text, length)).items():  # a shorter run gives no word
                    w = altered(r, start, every) if every else r
                    if len(w) >= length:
                        held[w] += n
                if len(held) > HELD:
                    yield from out()
        yield from out()

    found = id_and_text(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


class WaveletMatrix:
    """A permutation y of 0..m-1, for reports of the values of a range of places within a range of values."""

    def __init__(self, y: np.ndarray):
        self.levels = []
        for bit in range(max(1, int(len(y) - 1).bit_length()) - 1, -1, -1):
            one = (y >> bit & 1).astype(bool)
            self.levels.append((bit, np.concatenate(([0], np.cumsum(~one)))))
            y = np.concatenate((y[~one], y[one]))

    def report(self, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, value) of the values in [low, high) at the places [left, right)."""
        query, value = np.arange(len(left)), np.zeros(len(left), dtype=np.int64)
        for bit, zeros in self.levels:
            a, b = zeros[left], zeros[right]
            none = zeros[-1]
            query, value = np.concatenate((query, query)), np.concatenate((value, value | 1 << bit))
            left, right = np.concatenate((a, left - a + none)), np.concatenate((b, right - b + none))
            go = (left < right) & (value < high[query]) & (value + (1 << bit) > low[query])
            query, value, left, right = query[go], value[go], left[go], right[go]
        return query, value


def narrowed(words: list[str], word: str, most: int) -> list[tuple[int, int]]:
    """The intervals of sorted words of one length that begin with the first 0, 1, ... code points of word, up to ``most``, while not empty."""
    low, high, out = 0, len(words), []
    for k in range(most + 1):
        out.append((low, high))
        if k == most:
            break
        at = lambda w: w[k]  # noqa: B023, E731
        low, high = bisect_left(words, word[k], low, high, key=at), bisect_right(words, word[k], low, high, key=at)
        if low == high:
            break
    return out


class Plane:
    """The words of one length as points."""

    def __init__(self, words: list[str]):
        self.forward = sorted(words)
        order = sorted(range(len(words)), key=lambda i: self.forward[i][::-1])
        self.point = np.array(order)  # of each y its x
        self.backward = [self.forward[i][::-1] for i in order]
        y = np.empty(len(words), dtype=np.int64)
        y[self.point] = np.arange(len(words))
        self.matrix = WaveletMatrix(y)

    def ranges(self, word: str, wide: int, positions: np.ndarray) -> np.ndarray:
        """left, right, low, high, position of the queries of a word whose intervals are not empty; ``wide`` is 1 for a replacement, 0 for an insertion."""
        before = narrowed(self.forward, word, int(positions.max()))
        behind = narrowed(self.backward, word[::-1], len(word) - wide - int(positions.min()))
        positions = positions[(positions < len(before)) & (len(word) - wide - positions < len(behind))]
        if not len(positions):
            return np.zeros((5, 0), dtype=np.int64)
        a, b = np.array(before), np.array(behind)
        return np.vstack((a[positions].T, b[len(word) - wide - positions].T, positions))


def near_pairs(points: list[tuple[str, int]], asking: list[tuple[str, int, int, np.ndarray]]) -> list[tuple[str, int, str, int]]:
    """(word, n, near, near_n) for the asking (word, n, length of the words looked among, positions); an insertion's pair both ways round."""
    counts = dict(points)
    by_length: dict[int, list[str]] = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    asked: dict[int, list] = {}
    for row in asking:
        if row[2] in by_length:
            asked.setdefault(row[2], []).append(row)
    out = []
    for length, rows in asked.items():
        plane, todo, owner, size = Plane(by_length[length]), [], [], 0
        for k, (word, _, _, positions) in enumerate(rows):
            r = plane.ranges(word, 1 - (length - len(word)), positions)
            if r.shape[1]:
                todo.append(r)
                owner.append(np.full(r.shape[1], k))
                size += r.shape[1]
            if todo and (size >= AT_ONCE or k == len(rows) - 1):
                out += _found(plane, rows, np.concatenate(todo, axis=1), np.concatenate(owner), counts)
                todo, owner, size = [], [], 0
        if todo:
            out += _found(plane, rows, np.concatenate(todo, axis=1), np.concatenate(owner), counts)
    return out


def _found(plane: Plane, rows: list, ranges: np.ndarray, owner: np.ndarray, counts: dict[str, int]):
    query, y = plane.matrix.report(*ranges[:4])
    for k, p, x in zip(owner[query].tolist(), ranges[4][query].tolist(), plane.point[y].tolist()):
        word, n = rows[k][:2]
        near = plane.forward[x]
        if word[p : p + 1] != near[p]:  # else the word itself, or an insertion that an earlier position stands for
            m = counts[near]
            yield word, n, near, m
            if len(near) > len(word):
                yield near, m, word, n


def _meeting(bounds: list[tuple[int, str]], length: int, word: str, most: int) -> list[tuple[int, int]]:
    """The first and the last shard that hold words of a length beginning with 0, 1, ... code points of word; the last pair stands for all longer beginnings."""
    out = []
    for k in range(most + 1):
        low, high = bisect_right(bounds, (length, word[:k])), bisect_right(bounds, (length, word[:k] + PAST))
        out.append((low, high))
        if low == high:
            break
    return out


def asked_shards(word: str, forward: list[tuple[int, str]], backward: list[tuple[int, str]]) -> dict[tuple[int, int, int], list[int]]:
    """{(side, shard, length): positions} of a word's questions."""
    out: dict[tuple[int, int, int], list[int]] = {}
    for wide in (1, 0):
        length, last = len(word) + 1 - wide, len(word) - wide
        before, behind = _meeting(forward, length, word, last), _meeting(backward, length, word[::-1], last)
        for p in range(last + 1):
            a, b = before[min(p, len(before) - 1)], behind[min(last - p, len(behind) - 1)]
            side, (low, high) = (0, a) if (a[1] - a[0], last - p) < (b[1] - b[0], p) else (1, b)
            for s in range(low, high + 1):
                out.setdefault((side, s, length), []).append(p)
    return out


def _bounds(words: DataFrame, shards: int, total: int) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
    """Where the shards of either order begin, from about ``SAMPLE`` words a shard by hash; results don't depend on it."""
    if shards < 2:
        return [], []
    share = min(1.0, SAMPLE * shards / total)
    taken = [r.word for r in words.where(F.pmod(F.xxhash64("word", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30))).select("word").collect()]
    out = []
    for step in (1, -1):
        keys = sorted((len(w), w[::step]) for w in taken)
        out.append([keys[i * len(keys) // shards] for i in range(1, shards)] if keys else [])
    return out[0], out[1]


def near_words(words: DataFrame, shard: int = SHARD, asking: int = ASKING) -> DataFrame:
    """word, n, near, near_n of all pairs of near words, both ways round; words (word, n) are distinct."""
    total = words.count()
    least = max(8, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shards = max(-(-total // shard), min(least, -(-total // 256)))
    forward, backward = _bounds(words, shards, total)
    cuts = words.sparkSession.sparkContext.broadcast((forward, backward))  # two words a shard

    def place(batches):
        f, b = cuts.value
        for batch in batches:
            found = [(side, bisect_right(cut, (len(w), w[::step])), w, n) for w, n in zip(*(c.to_pylist() for c in batch.columns)) for side, cut, step in ((0, f, 1), (1, b, -1))]
            yield pa.record_batch([pa.array([r[k] for r in found], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int64()))], names=["side", "shard", "word", "n"])

    def ask(batches):
        f, b = cuts.value
        for batch in batches:
            found = [(*k[:2], w, n, k[2], np.array(p, dtype="<i4").tobytes()) for w, n in zip(*(c.to_pylist() for c in batch.columns)) for k, p in asked_shards(w, f, b).items()]
            yield pa.record_batch([pa.array([r[k] for r in found], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.binary()))], names=["side", "shard", "word", "n", "length", "positions"])

    words = words.select("word", "n")
    points = words.mapInArrow(place, "side int, shard int, word string, n long")
    questions = words.mapInArrow(ask, "side int, shard int, word string, n long, length int, positions binary")
    copies = saved(questions.groupBy("side", "shard").agg(F.ceil(F.count("*") / asking).cast("int").alias("copies")))
    questions = questions.join(copies, ["side", "shard"]).withColumn("copy", F.pmod(F.xxhash64("word"), F.col("copies")).cast("int")).drop("copies")
    points = points.join(copies, ["side", "shard"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")

    def pairs(key, points, questions):
        found = near_pairs(
            list(zip(*(points.column(c).to_pylist() for c in ("word", "n")))),
            [(w, n, t, np.frombuffer(p, "<i4").astype(np.int64)) for w, n, t, p in zip(*(questions.column(c).to_pylist() for c in ("word", "n", "length", "positions")))],
        )
        return pa.table([pa.array([r[k] for r in found], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["word", "n", "near", "near_n"])

    by, parts = ("side", "shard", "copy"), min(1 << 16, max(least, 2 * shards))  # few bytes and much work: not for adaptive execution to put together
    return points.repartition(parts, *by).groupBy(*by).cogroup(questions.repartition(parts, *by).groupBy(*by)).applyInArrow(pairs, "word string, n long, near string, near_n long")


def followed(forms: DataFrame, steps: int) -> DataFrame:
    """word, root: the last word that forms (word, form) lead to, over at most ``steps`` of them, by doubling."""
    up = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        far = up.select(F.col("word").alias("via"), F.col("root").alias("far"))
        up = saved(up.join(far, up.root == far.via, "left").select("word", F.coalesce("far", "root").alias("root")))
    return up


def spelling_variants(words: DataFrame, ratio: int = RATIO, shard: int = SHARD, asking: int = ASKING) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words (word, n)."""
    words = saved(words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")))
    near = near_words(words, shard, asking).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    rows = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.m") >= ratio * F.col("n"), F.col("best")).alias("best"))
    rows = saved(rows.select("word", F.col("best.near").alias("form"), "n", "n_near", (-F.col("best.m")).alias("form_n")))
    forms = rows.where("form is not null").select("word", "form")
    top, low = rows.agg(F.max("n"), F.min("n")).first()
    steps = 1 + int(math.log(max(1, (top or 1) // max(1, low or 1)), ratio)) if top else 0
    roots = followed(forms, steps)
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(read_table(spark, sf_dir, "documents"), every=ALTERED))

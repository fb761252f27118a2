"""Repetitions of word sequences (runs) by the runs theorem, and their collapse.

A run is a stretch of consecutive words with smallest period q, at least 2 * q and ``LEAST`` words long, that no neighbouring word
extends with that period.  By the theorem every run holds, under one of the two orders of the words, a longest Lyndon word
of length q among the positions of its first period.  For a block of texts:

1. Words become numbers, and the suffixes of each text (each with an end mark that is smaller than every word) are sorted by prefix
   doubling; only suffixes that still tie are sorted on.
2. The longest Lyndon word at i ends before the next smaller value of the inverse suffix array; under the opposite order, before the next
   greater one.
3. A root (i, j = i + q) can belong to a run only if ``LEAST`` / 2 words in a row around i agree with those q further on.  In texts that keep a
   root, the common prefixes of the suffixes (LCP), a sparse table of their minima, and the same for the reversed texts tell how far
   each root's period reaches on both sides.  Roots of one run give the same stretch.

Nothing is shuffled: a text is one row of one task.  A task holds a block of ``SLICE_BYTES``, or one longer text, with about 250 bytes a word.
A null text has no words; an empty table gives an empty one; each row has its own result.  Rows without an id are treated like others.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import Words, id_and_text, read_table, slices

LEAST, BLOCK = 12, 16
SCHEMA = "doc_id long, text string, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>"


def numbered(words: Words) -> np.ndarray:
    """A number for each word, equal for equal words only (128 bits)."""
    _, at, number = np.unique(words.hash, return_index=True, return_inverse=True)
    if (words.check != words.check[at][number]).any():  # unlike words that share 64 bits
        _, number = np.unique(np.stack((words.hash, words.check)), axis=1, return_inverse=True)
    return number.ravel().astype(np.int64)


class Suffixes:
    """The sorted suffixes of texts that stand one after another, each ended by the mark -1; texts sort by place, so none are mixed."""

    def __init__(self, values: np.ndarray, text: np.ndarray):
        """text: the place of each value's text, rising."""
        n = len(values)
        self.values, self.text = values, text
        key = text * (int(values.max(initial=0)) + 2) + values + 1
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
        first = np.flatnonzero(new)
        self.rank = np.empty(n, dtype=np.int64)  # of the first of those that tie
        self.rank[order] = np.repeat(first, np.diff(np.append(first, n)))
        self.order = order
        tied = self._tied(new)
        active, k = order[tied], 1
        while len(active):
            group = self.rank[active]
            key = group * n + self.rank[active + k]
            by = np.argsort(key, kind="stable")
            active, key, group = active[by], key[by], group[by]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            at = np.arange(len(key))
            begins = np.concatenate(([True], group[1:] != group[:-1]))
            start = np.maximum.accumulate(np.where(begins, at, 0))
            self.order[group + at - start] = active
            self.rank[active] = group + np.maximum.accumulate(np.where(new, at, 0)) - start
            active, k = active[self._tied(new)], 2 * k

    @staticmethod
    def _tied(new: np.ndarray) -> np.ndarray:
        """Which of a sorted list share their key with a neighbour, from where new keys begin."""
        last = np.concatenate((new[1:], [True]))
        return ~(new & last)

    def next_unlike(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place the next one with a smaller, and with a greater rank; past the end: the number of places."""
        n = len(self.rank)
        rank = self.rank.tolist()
        smaller, greater = [n] * n, [n] * n
        down, up = [], []  # open places, by rising and by falling rank
        for i, r in enumerate(rank):
            while down and rank[down[-1]] > r:
                smaller[down.pop()] = i
            while up and rank[up[-1]] < r:
                greater[up.pop()] = i
            down.append(i)
            up.append(i)
        return np.array(smaller, dtype=np.int64), np.array(greater, dtype=np.int64)

    def common(self) -> RangeMinimum:
        """How many values each sorted suffix shares with the one before it, for queries of minima."""
        lcp = np.zeros(len(self.rank), dtype=np.int64)
        values, rank, h = self.values.tolist(), self.rank.tolist(), 0
        before = np.concatenate(([-1], self.order[:-1]))[self.rank]
        before[np.concatenate(([-1], self.text[self.order[:-1]]))[self.rank] != self.text] = -1
        for i, j in enumerate(before.tolist()):
            if j < 0:
                h = 0
                continue
            while values[i + h] == values[j + h] and values[i + h] >= 0:
                h += 1
            lcp[rank[i]] = h
            h = max(h - 1, 0)
        return RangeMinimum(lcp)

    def shared(self, minima: RangeMinimum, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values the suffixes at i and at j (other than i, in the same text) have in common."""
        a, b = self.rank[i], self.rank[j]
        return minima.least(np.minimum(a, b) + 1, np.maximum(a, b))


class RangeMinimum:
    """Minima of ranges: a sparse table over blocks of ``BLOCK`` values, whose ends are looked at one by one."""

    def __init__(self, values: np.ndarray):
        self.values = values
        whole = len(values) // BLOCK
        self.table = [values[: whole * BLOCK].reshape(whole, BLOCK).min(axis=1) if whole else np.zeros(0, np.int64)]
        while len(self.table[-1]) > 1 << (len(self.table) - 1):
            t, k = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(t[:-k], t[k:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least of the values from low to high, both included."""
        out = self.values[low].copy()
        for d in range(BLOCK):
            np.minimum(out, self.values[np.minimum(low + d, high)], out=out)
            np.minimum(out, self.values[np.maximum(high - d, low)], out=out)
        a, b = -(-low // BLOCK), (high + 1) // BLOCK
        level = np.frexp(np.maximum(b - a, 0).astype(np.float64))[1] - 1  # of the largest power of two blocks inside
        for k in np.unique(level[level >= 0]).tolist():
            at = np.flatnonzero(level == k)
            t = self.table[k]
            out[at] = np.minimum(out[at], np.minimum(t[a[at]], t[b[at] - (1 << k)]))
        return out


def _marked(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values with a mark after each text, and the place of each one's text."""
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count + 1)
    out = np.full(len(text), -1, dtype=np.int64)
    out[np.arange(len(values)) + np.repeat(np.arange(len(count)), count)] = values
    return out, text


def _agreeing(values: np.ndarray, i: np.ndarray, j: np.ndarray, least: int) -> np.ndarray:
    """Which of the roots (i, j) have ``least`` agreeing values in a row around i; marks agree with nothing else."""
    n = len(values)

    def reach(step: int) -> np.ndarray:
        far, going = np.zeros(len(i), dtype=np.int64), np.ones(len(i), dtype=bool)
        for d in range(least):
            a, b = (i + d, j + d) if step > 0 else (i - 1 - d, j - 1 - d)
            inside = (a >= 0) & (b < n)
            x, y = values[np.where(inside, a, 0)], values[np.where(inside, b, 0)]
            going &= inside & (x == y) & (x >= 0)
            far += going
        return far

    right = reach(1)
    return (right > 0) & (right + reach(-1) >= least)


def runs_of(values: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start (place among all values), length, period of the runs of texts ``values[first[d]:first[d + 1]]``, by start and period."""
    none = (np.zeros(0, dtype=np.int64),) * 3
    if not len(values):
        return none
    marked, text = _marked(values, first)
    suffixes = Suffixes(marked, text)
    i = np.concatenate((np.arange(len(marked)),) * 2)
    j = np.concatenate(suffixes.next_unlike())
    fits = j < len(marked)
    i, j = i[fits], j[fits]
    fits = (text[i] == text[j]) & (marked[i] == marked[j]) & (marked[i] >= 0)
    i, j = i[fits], j[fits]
    fits = _agreeing(marked, i, j, -(-least // 2))
    i, j = i[fits], j[fits]
    if not len(i):
        return none
    # from here on only the texts that keep a root
    own = np.zeros(len(first) - 1, dtype=bool)
    own[text[i]] = True
    if not own.all():
        moved = np.cumsum(own[text]) - 1
        count = np.where(own, np.diff(first), 0)
        kept = np.repeat(own, np.diff(first))
        i, j = moved[i], moved[j]
        marked, text = _marked(values[kept], np.concatenate(([0], np.cumsum(count[own]))))
        suffixes = Suffixes(marked, text)
    right = suffixes.shared(suffixes.common(), i, j)
    # reversed, each text's mark stays behind it
    ends = np.flatnonzero(marked < 0)
    begin = np.concatenate(([0], ends[:-1] + 1))
    mirror = (begin + ends - 1)[text] - np.arange(len(marked))
    mirror[ends] = ends
    back = Suffixes(marked[mirror], text)
    # the value before a text's first one is its mark, which agrees with nothing
    a, b = np.where(i > begin[text[i]], mirror[np.maximum(i - 1, 0)], ends[text[i]]), mirror[j - 1]
    left = np.where(a == b, 0, back.shared(back.common(), a, np.where(a == b, a - 1, b)))
    period, start, length = j - i, i - left, j + right - (i - left)
    fits = length >= np.maximum(least, 2 * period)
    found = np.unique(np.stack((start[fits], period[fits], length[fits])), axis=1)
    start = found[0]
    which = np.flatnonzero(own)[text[start]]  # the place among all values: marks and texts left out count again
    return start - begin[text[start]] + np.asarray(first)[which], found[2], found[1]


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, tails: Callable[[int | None, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """doc_id, text (words outside a run or of its first period, joined by one space), n_words, runs of every row.

    ``tails``, from an id and a number of words, may tell (a, p): the words from a on are then read as the first p of them, repeated.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column(1))
                first = words.first
                source = np.arange(len(words.start))
                for d, (i, n) in enumerate(zip(part.column(0).to_pylist(), np.diff(first).tolist())):
                    tail = tails(i, n) if tails else None
                    if tail:
                        a, p = tail
                        source[first[d] + a : first[d + 1]] = first[d] + a + np.arange(n - a) % p
                start, length, period = runs_of(numbered(words)[source], first, least)
                cover = np.zeros(len(source) + 1, dtype=np.int64)
                np.add.at(cover, start + period, 1)
                np.add.at(cover, start + length, -1)
                keep = np.cumsum(cover[:-1]) <= 0
                at = np.searchsorted(start, first)
                raw = words.data.tobytes()
                texts = []
                for a, b in zip(first, first[1:]):
                    own = source[a:b][keep[a:b]]
                    texts.append(b" ".join([raw[s:e] for s, e in zip(words.start[own].tolist(), words.end[own].tolist())]).decode())
                begin = np.repeat(first[:-1], np.diff(at))
                runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - begin, length, period)], names=["start", "length", "period"])
                runs = pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(np.diff(first), pa.int64()), runs], names=["doc_id", "text", "n_words", "runs"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def planted_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The repeated tail that the query reads into one text of ten: h = crc32 of the decimal id; a text without words or id has none."""
    if doc_id is None or not n:
        return None
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    a = g % n
    return None if rest else (a, 1 + (n - a) // (3 + g % 8))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(read_table(spark, sf_dir, "documents"), tails=planted_tail)
    top = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    found = found.withColumn("top", top)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n"))))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    exponent = F.expr("(1000 * top.length) div (-top.period)").cast("long")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"), exponent.alias("exponent_milli"), digest(lines).alias("runs_sha256"), digest(F.col("text")).alias("collapsed_sha256"))

"""Dictionary segmentation.

Segmenting is sequential, so it runs in Arrow batches; counting what it yields is a grouped aggregate.
A lexicon of at most ``MOST_WORDS`` words and ``MOST_BYTES`` bytes, which is checked, travels by broadcast.  A larger one stays a table: each distinct stretch
gets the words that occur in it, with their counts, by a join of its substrings, and is segmented with those alone.  Both give the same.
"""

from __future__ import annotations

import heapq
import math
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.bounded import read_bounded, settled
from wordloom.functions.keys import overlapping

FEWER = 1000.0
MOST_WORDS, MOST_BYTES = 2_000_000, 64 << 20
CHARACTERS = 0x110000


class Lexicon:
    """Words of two units or more with the ends of each that exist, and costs."""

    def __init__(self, words: dict[str, int], chars: dict[str, int] | None = None):
        self.prefixes = {w[:k] for w in words for k in range(1, len(w) + 1)}
        self.words = words
        total = sum(words.values()) + sum((chars or {}).values()) or 1
        cost = lambda n: math.log((n + 0.5) / total) - FEWER
        self.cost = {w: cost(n) for w, n in words.items()}
        self.char_cost = {c: cost(n) for c, n in (chars or {}).items()}
        self.unknown = cost(0)

    def ends(self, text: str, at: int):
        """Ends of the lexicon words that start at a place, rising."""
        for end in range(at + 2, len(text) + 1):
            part = text[at:end]
            if part not in self.prefixes:
                return
            if part in self.words:
                yield end

    def greedy(self, text: str) -> list[str]:
        """Longest word first, from the left; else a single unit."""
        out, at = [], 0
        while at < len(text):
            end = max(self.ends(text, at), default=at + 1)
            out.append(text[at:end])
            at = end
        return out

    def likeliest(self, text: str) -> list[str]:
        """Fewest pieces, then highest product of probabilities; of equal ones the longest last piece."""
        value: list[tuple[float, int]] = [(0.0, 0)] + [(-math.inf, 0)] * len(text)
        for at in range(len(text)):
            so_far = value[at][0]
            steps = [(at + 1, self.char_cost.get(text[at], self.unknown)), *((e, self.cost[text[at:e]]) for e in self.ends(text, at))]
            for end, c in steps:
                if so_far + c > value[end][0]:
                    value[end] = (so_far + c, at)
        out, end = [], len(text)
        while end:
            out.append(text[value[end][1] : end])
            end = value[end][1]
        return out[::-1]

    def nearest(self, text: str, k: int, margin: float) -> list[tuple[float, list[str]]]:
        """The k best segmentations within a margin of the best, best first."""
        kept: list[list[tuple[float, tuple[str, ...]]]] = [[(0.0, ())]] + [[] for _ in text]
        for at in range(len(text)):
            kept[at] = heapq.nlargest(k, kept[at])
            for score, path in kept[at]:
                for end in (at + 1, *self.ends(text, at)):
                    part = text[at:end]
                    c = self.cost[part] if end - at > 1 else self.char_cost.get(part, self.unknown)
                    kept[end].append((score + c, (*path, part)))
        best = heapq.nlargest(k, kept[len(text)])
        return [(s, list(p)) for s, p in best if s >= best[0][0] - margin]


class Held(Lexicon):
    """The lexicon words that occur in one stretch: (place, length, count) of each occurrence."""

    def __init__(self, text: str, found, cost, char_cost: dict[str, float]):
        self.by_start: dict[int, list[int]] = {}
        self.cost, self.char_cost, self.unknown = {}, char_cost, cost(0)
        for at, k, n in sorted(found):
            self.by_start.setdefault(at, []).append(at + k)
            self.cost[text[at : at + k]] = cost(n)

    def ends(self, text: str, at: int):
        return self.by_start.get(at, ())


_LAST: dict[str, Lexicon] = {}


def _lexicon(key: str, words: dict[str, int], chars: dict[str, int] | None) -> Lexicon:
    """The lexicon of a broadcast, built once for a worker and not for each of its tasks."""
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = Lexicon(words, chars)
    return _LAST[key]


def _cut(lex: Lexicon, text: str, mode: str, k: int, margin: float) -> list[tuple[float, list[str]]]:
    return lex.nearest(text, k, margin) if mode == "nearest" else [(0.0, lex.greedy(text) if mode == "greedy" else lex.likeliest(text))]


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.float64(), pa.list_(pa.string()))
    return pa.record_batch([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=["stretch", "rank", "score", "pieces"])


SEGMENTS = "stretch string, rank int, score double, pieces array<string>"


def segmented(stretches: DataFrame, words: dict[str, int], chars: dict[str, int] | None = None, mode: str = "likeliest", k: int = 4, margin: float = 3.0) -> DataFrame:
    """stretch, rank, score, pieces of each distinct stretch (column stretch); other columns are dropped."""
    shared = stretches.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, words, chars))

    def run(batches):
        lex = _lexicon(*shared.value)
        for batch in batches:
            yield _segments([(s, i, score, p) for s in batch.column(0).to_pylist() for i, (score, p) in enumerate(_cut(lex, s, mode, k, margin), 1)])

    return stretches.select("stretch").mapInArrow(run, SEGMENTS)


def occurrences(once: DataFrame, words: DataFrame, piece: int = 256) -> DataFrame:
    """stretch, at, word of every lexicon word (text) of two units or more in distinct stretches: their substrings of the words' lengths, joined."""
    words = words.where(F.length("text") >= 2).select(F.col("text").alias("word")).distinct()
    lengths = sorted(r.k for r in words.select(F.length("word").alias("k")).distinct().collect())  # no more than the longest word has units
    if not lengths:
        return once.select("stretch", F.lit(0).alias("at"), F.lit("").alias("word")).limit(0)
    piece = max(piece, lengths[-1])
    cut = once.where(F.length("stretch") >= 2).select("stretch", F.posexplode(overlapping(F.col("stretch"), piece, lengths[-1] - 1)).alias("b", "t"))
    cut = cut.select("stretch", "b", "t", F.explode(F.array(*[F.lit(k) for k in lengths])).alias("k")).where(F.length("t") >= F.col("k"))
    at = F.sequence(F.lit(0), F.least(F.lit(piece - 1), F.length("t") - F.col("k")))
    spans = cut.select("stretch", "b", F.posexplode(F.transform(at, lambda i: F.substring("t", i + 1, F.col("k")))).alias("i", "word"))
    return spans.join(words, "word", "left_semi").select("stretch", (F.col("b") * piece + F.col("i")).alias("at"), "word")


def segmented_joined(once: DataFrame, found: DataFrame, counts: DataFrame | None = None, total: int | None = None, mode: str = "likeliest", k: int = 4, margin: float = 3.0) -> DataFrame:
    """As segmented, of distinct stretches; found: their occurrences; counts (piece, n): of words and single units; nothing is sent but counts of single units."""
    chars: dict[str, int] = {}
    if counts is not None:
        chars = {r.piece: r.n for r in read_bounded(counts.where(F.length("piece") == 1), CHARACTERS)}  # no more than there are code points
        total = counts.agg(F.sum("n")).first()[0] if total is None else total
        found = found.join(counts.where(F.length("piece") > 1).withColumnRenamed("piece", "word"), "word", "left")
    else:
        found = found.withColumn("n", F.lit(0))
    held = found.groupBy("stretch").agg(F.collect_list(F.struct("at", F.length("word").alias("k"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))).alias("held"))
    total = total or 1
    cost = lambda n: math.log((n + 0.5) / total) - FEWER
    shared = once.sparkSession.sparkContext.broadcast({c: cost(n) for c, n in chars.items()})

    def run(batches):
        for batch in batches:
            rows = []
            for s, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lex = Held(s, [(x["at"], x["k"], x["n"]) for x in found or ()], cost, shared.value)
                rows += [(s, i, score, p) for i, (score, p) in enumerate(_cut(lex, s, mode, k, margin), 1)]
            yield _segments(rows)

    return once.select("stretch").join(held, "stretch", "left").mapInArrow(run, SEGMENTS)


def fits(words: DataFrame, most_words: int = MOST_WORDS, most_bytes: int = MOST_BYTES) -> bool:
    """Whether a lexicon (text) may travel by broadcast."""
    n, size = words.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    return n <= most_words and (size or 0) <= most_bytes


def segmentations(stretches: DataFrame, words: DataFrame, mode: str = "likeliest", k: int = 4, margin: float = 3.0, most_words: int = MOST_WORDS) -> DataFrame:
    """stretch, rank, score, pieces of each distinct stretch by a lexicon (text, n) of any size."""
    once = stretches.select("stretch").distinct()
    if fits(words, most_words):
        return segmented(once, {r.text: r.n for r in read_bounded(words.select("text", "n"), most_words)}, None, mode, k, margin)
    once, counts = settled(once), settled(words.select(F.col("text").alias("piece"), "n"))
    return segmented_joined(once, occurrences(once, words), counts.where(F.length("piece") > 1), counts.agg(F.sum("n")).first()[0], mode, k, margin)


def piece_counts(stretches: DataFrame, words: dict[str, int], chars=None, mode: str = "likeliest") -> DataFrame:
    """piece, n over stretches (stretch, n): each distinct stretch is segmented once, and a batch's pieces are added up before they leave it."""
    return _piece_counts(stretches.groupBy("stretch").agg(F.sum("n").alias("n")), words, chars, mode)


def _piece_counts(once: DataFrame, words: dict[str, int], chars: dict[str, int] | None, mode: str) -> DataFrame:
    shared = once.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, words, chars))

    def run(batches):
        lex = _lexicon(*shared.value)
        cut = lex.greedy if mode == "greedy" else lex.likeliest
        for batch in batches:
            counts: dict[str, int] = {}
            for stretch, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for piece in cut(stretch):
                    counts[piece] = counts.get(piece, 0) + n
            yield pa.record_batch([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], names=["piece", "n"])

    return once.select("stretch", F.col("n").cast("long")).mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def piece_counts_of(stretches: DataFrame, words: DataFrame, mode: str = "greedy", most_words: int = MOST_WORDS) -> DataFrame:
    """As piece_counts by a lexicon (text, n) of any size."""
    if fits(words, most_words):
        return piece_counts(stretches, {r.text: r.n for r in read_bounded(words.select("text", "n"), most_words)}, mode=mode)
    once = settled(stretches.groupBy("stretch").agg(F.sum("n").alias("n")))
    return _added(segmentations(once, words, mode, most_words=most_words), once)


def _added(cut: DataFrame, once: DataFrame) -> DataFrame:
    pieces = cut.join(once, "stretch").select(F.explode("pieces").alias("piece"), "n")
    return pieces.groupBy("piece").agg(F.sum("n").alias("n"))


def reestimated(stretches: DataFrame, words: DataFrame, passes: int = 6, most_words: int = MOST_WORDS) -> DataFrame:
    """piece, n after so many passes: the longest-first cut starts, then counts of each pass weigh the next one's cut."""
    words = words.select("text").distinct()
    once = settled(stretches.groupBy("stretch").agg(F.sum("n").alias("n")))  # read in every pass
    if not fits(words, most_words):
        return _reestimated_joined(once, words, passes)
    lexicon = {r.text: 1 for r in read_bounded(words, most_words)}
    counts = _piece_counts(once, lexicon, None, "greedy")
    for _ in range(passes - 1):
        got = {r.piece: r.n for r in read_bounded(counts, most_words + CHARACTERS)}
        counts = _piece_counts(once, {w: got.get(w, 0) for w in lexicon}, {p: n for p, n in got.items() if len(p) == 1}, "likeliest")
    return counts


def _reestimated_joined(once: DataFrame, words: DataFrame, passes: int) -> DataFrame:
    """The occurrences are found once; a pass joins them with the counts of the pass before."""
    found = settled(occurrences(once, words))
    counts = _added(segmented_joined(once, found, mode="greedy"), once)
    for _ in range(passes - 1):
        counts = settled(counts)
        counts = _added(segmented_joined(once, found, counts), once)
    return counts

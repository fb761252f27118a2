"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text of that language.  A text is parsed
against an automaton from left to right into the longest phrases that occur in the language's text (a
character that doesn't occur is a phrase of its own).  The number of phrases, times the logarithm of
the language's text length, is the cross-parsing entropy; the language that needs least wins.

A text is read as its words (runs of letters and marks, lower-cased) with one space before, between and after them; digits and
signs tell nothing and are left out.  Phrases cross the edges of words.  Many texts are parsed in step, against all
languages at once, through one double array of transitions, whose size follows the arcs and not the alphabets: see README for figures.

The automata are fitted on a bounded sample: at most ``chars`` characters of whole documents for each
language, drawn by a hash of the id until the characters are full or the documents end; where all documents of a language are longer, a window of that
many characters of the shortest one.  Every value of lang with a letter in its sample is learned; over ``most`` (1,000) of them is an error.  Null texts and texts without a letter are ``und`` with score 0;
so is every text when there is nothing to learn from.  Equal costs go to the first language by name.
"""

from __future__ import annotations

import math
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.bounded import read_bounded
from wordloom.llm.common import id_and_text, read_table, remainder, slices

#: Bytes of text that are parsed in step, and the characters beyond which a text is parsed by itself.
IN_STEP, LONG = 16 << 20, 1 << 18


@lru_cache(maxsize=1)
def _word_pattern():
    """Runs of letters and marks that begin with a letter, by Unicode category: not ``½``, ``²``, ``①`` or Roman numerals."""
    import regex

    return regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    if text.isascii():
        return text.lower().translate(_PLAIN).split()
    return _word_pattern().findall(text.lower())


#: ASCII characters that are no letters, as spaces.
_PLAIN = {c: " " for c in range(128) if unicodedata.category(chr(c))[0] != "L"}


class SuffixAutomaton:
    """All substrings of a text as paths from state 0; ``arcs`` is {state * 2**21 + code point: state}."""

    def __init__(self, text: str):
        arcs: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(arcs)
            arcs.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in arcs[p]:
                arcs[p][c] = cur
                p = link[p]
            if p >= 0:
                q = arcs[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    twin = len(arcs)
                    arcs.append(dict(arcs[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and arcs[p].get(c) == q:
                        arcs[p][c] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur
        self.size = len(text)
        self.arcs = {(s << 21) + ord(c): t for s, out in enumerate(arcs) for c, t in out.items()}

    def flat(self) -> tuple[np.ndarray, np.ndarray, int]:
        return np.fromiter(self.arcs, np.int64, len(self.arcs)), np.fromiter(self.arcs.values(), np.int32, len(self.arcs)), self.size


class Arcs:
    """The arcs of all automata as one double array: state s goes by character c to the second half of ``cells[base[s] + c]`` if its first half is s.

    States are placed by falling number of arcs: many at a time at random places, of those that want a cell the first gets it, until all have theirs.
    Half of the cells stay free; so an arc takes 16 bytes and a state 4, whatever the alphabets.
    """

    def __init__(self, state: np.ndarray, column: np.ndarray, to: np.ndarray, states: int, width: int):
        order = np.argsort(state, kind="stable")
        state, column, to = state[order], column[order], to[order].astype(np.int64)
        begin, arity = np.searchsorted(state, np.arange(states)), np.bincount(state, minlength=states)
        size = max(64, 2 * len(state))
        self.base = np.zeros(states, dtype=np.int32)
        self.cells = np.full(size + width, -1, dtype=np.int64)
        r = np.random.default_rng(1)
        for n in np.unique(arity[arity > 0])[::-1].tolist():
            todo, vain = np.flatnonzero(arity == n), 0
            while len(todo):
                if vain > 64:  # too full for so many arcs at once
                    self.cells = np.concatenate((self.cells, np.full(size // 4, -1, dtype=np.int64)))
                    size, vain = size + size // 4, 0
                some = todo[: max(1, size // (2 * n))]
                at = r.integers(0, size, len(some))
                arcs = begin[some][:, None] + np.arange(n)
                cells = at[:, None] + column[arcs]
                free = (self.cells[cells] < 0).all(axis=1)
                _, first = np.unique(np.where(free[:, None], cells, -1 - np.arange(len(some))[:, None]), return_index=True)
                own = np.zeros(cells.size, dtype=bool)
                own[first] = True
                fits = free & own.reshape(cells.shape).all(axis=1)
                self.base[some[fits]] = at[fits]
                self.cells[cells[fits]] = some[fits].astype(np.int64)[:, None] << 32 | to[arcs[fits]]
                vain = 0 if 20 * fits.sum() > len(some) else vain + 1
                todo = np.concatenate((some[~fits], todo[len(some) :]))

    def follow(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The states that the arcs lead to; -1 where there is none."""
        cell = self.cells.take(self.base.take(state) + column)
        return np.where(cell >> 32 == state, cell & 0xFFFFFFFF, -1)


class Parser:
    """The numbers of phrases of texts for several automata (keys, targets, size) at once.

    A state is one of one automaton; a column stands for a character that any of them knows, column 0 for all others.  Roots, which
    have an arc for most characters, have a row each.
    """

    def __init__(self, automata: list[tuple[np.ndarray, np.ndarray, int]]):
        code = (1 << 21) - 1
        known = np.unique(np.concatenate([k & code for k, _, _ in automata]))
        self.column = np.zeros(0x110000, dtype=np.int32)
        self.column[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        states = [int(max(k.max() >> 21, t.max())) + 1 for k, t, _ in automata]
        self.root = np.concatenate(([0], np.cumsum(states)[:-1]))
        # a character that doesn't occur is a phrase of its own: it leads to the root
        self.first = np.repeat(self.root[:, None], self.width, axis=1)
        parts = []
        for n, ((k, t, _), r) in enumerate(zip(automata, self.root.tolist())):
            s, c = k >> 21, self.column[k & code]
            self.first[n, c[s == 0]] = t[s == 0] + r
            parts.append((s[s > 0] + r, c[s > 0], t[s > 0] + r))
        self.arcs = Arcs(*(np.concatenate(x) for x in zip(*parts)), sum(states), self.width)

    def counts(self, texts: list[str]) -> np.ndarray:
        """A row for each text, a column for each automaton."""
        out = np.zeros((len(texts), len(self.root)), dtype=np.int64)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        for i in np.flatnonzero(size > LONG).tolist():
            out[i] = self._alone(texts[i])
        order = np.flatnonzero(size <= LONG)
        order = order[np.argsort(-size[order], kind="stable")]
        if not len(order):
            return out
        codes = self.column[np.frombuffer("".join([texts[i] for i in order]).encode("utf-32-le"), dtype="<u4")]
        size = size[order]
        start = np.cumsum(size) - size
        active = len(size) - np.searchsorted(size[::-1], np.arange(int(size[0])), side="right")  # texts longer than each place
        state = np.broadcast_to(self.root, (len(order), len(self.root))).copy()
        n, first, row = np.zeros(state.shape, dtype=np.int64), self.first.ravel(), np.arange(len(self.root)) * self.width
        for t, m in enumerate(active.tolist()):
            a = codes[start[:m] + t][:, None]
            now = state[:m]
            to = self.arcs.follow(now, a)
            opens = to < 0  # at the root, too: its arcs are not among the cells
            n[:m] += opens
            np.copyto(now, np.where(opens, first.take(row + a), to))
        out[order] = n
        return out

    def _alone(self, text: str) -> list[int]:
        """One text against one automaton after another."""
        base, cells, out = memoryview(self.arcs.base), memoryview(self.arcs.cells), []
        codes = self.column[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")]
        for root, first in zip(self.root.tolist(), self.first):
            state, n = root, 0
            for c, top in zip(memoryview(codes), memoryview(first[codes])):
                cell = cells[base[state] + c]
                if cell >> 32 == state:
                    state = cell & 0xFFFFFFFF
                else:
                    state, n = top, n + 1
            out.append(n)
        return out


def _drawn(docs: DataFrame, chars: int, most: int) -> dict[str, list[str]]:
    """For each lang the texts of whole documents by the hash of the id, each that still fits in ``chars``, until 95 % are full; a language whose
    documents are all longer gives the first ``chars`` of the shortest.  All languages are drawn in the same passes, and about four times ``chars`` of each reach the driver."""
    top = (1 << 63) - 1
    rows = docs.where("text <> ''").select("lang", F.xxhash64("doc_id").bitwiseAND(F.lit(top)).alias("h"), F.col("doc_id").alias("i"), F.length("text").alias("n"), "text")
    fits = F.col("n") <= chars
    size = {r.lang: r.n for r in read_bounded(rows.groupBy("lang").agg(F.sum(F.when(fits, F.col("n"))).alias("n")), most)}
    share = {k: min(1.0, 4 * chars / n) for k, n in size.items() if n}
    out = {}
    while share:
        limits = docs.sparkSession.createDataFrame([(k, min(top, int(f * top))) for k, f in share.items()], "lang string, limit long")
        got: dict[str, list] = {k: [] for k in share}
        for r in rows.join(F.broadcast(limits), "lang").where(fits & (F.col("h") <= F.col("limit"))).select("lang", "h", "i", "text").collect():
            got[r.lang].append((r.h, r.i is not None, r.i or 0, r.text))
        for k, found in got.items():
            texts, n = [], 0
            for *_, t in sorted(found):
                if n + len(t) <= chars:
                    texts.append(t)
                    n += len(t)
                if n > 0.95 * chars:
                    break
            if n > 0.95 * chars or share[k] == 1.0:
                out[k] = texts
        share = {k: min(1.0, 8 * f) for k, f in share.items() if k not in out}
    long = [k for k, n in size.items() if not n]
    if long:
        shortest = rows.where(F.col("lang").isin(long)).groupBy("lang").agg(F.min(F.struct("n", "h", "i", F.substring("text", 1, chars).alias("text"))).alias("m"))
        out |= {r.lang: [r.m.text] for r in shortest.collect()}
    return out


def fit(docs: DataFrame, chars: int = 60_000, most: int = 1000) -> dict[str, tuple[np.ndarray, np.ndarray, int]]:
    """An automaton for each value of lang in docs (doc_id, text, lang), at most ``most`` values."""
    use = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = {k: [w for t in texts for w in words_of(t)] for k, texts in sorted(_drawn(use, chars, most).items())}
    return {k: SuffixAutomaton(" " + " ".join(w) + " ").flat() for k, w in words.items() if w}


def languages(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1: the margin's probability) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages and ``chars``

    def run(batches):
        names = sorted(shared.value)
        parser = Parser([shared.value[k] for k in names]) if names else None
        bits = np.array([math.log2(shared.value[k][2] + 2) for k in names])
        for batch in batches:
            for part in slices(batch, limit=IN_STEP):
                words = [words_of(t) for t in part.column(1).to_pylist()]
                pred, score = np.full(len(words), "und", dtype=object), np.zeros(len(words))
                at = [k for k, w in enumerate(words) if w] if names else []
                texts = [f" {' '.join(words[k])} " for k in at]
                if at:
                    rate = parser.counts(texts) * bits / (np.array([len(t) for t in texts]) - 1)[:, None]
                    best = np.argmin(rate, axis=1)
                    e = np.exp(-4 * (rate - rate[np.arange(len(at)), best][:, None]))
                    pred[at], score[at] = np.array(names, dtype=object)[best], 1 / e.sum(axis=1)
                yield pa.record_batch([part.column(0), pa.array(pred.tolist(), pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    learn = docs.where(F.coalesce(remainder(F.col("doc_id"), 3) != 1, F.lit(False)))
    found = languages(docs, fit(learn))
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")

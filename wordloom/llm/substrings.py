"""Removal of repeated word passages by recompression.

Texts are compressed by the same rules everywhere.  Each round first names maximal runs of one symbol, then
pairs: a symbol's name puts it on the left or the right side, and a left one followed by a right one becomes one symbol.
A name is 128 bits of what it stands for, so names are global without being handed out: equal passages have
equal symbols inside, in whatever task they are named.  Near its ends, a passage's symbols may depend on
its surroundings; each symbol therefore carries the range of words that its existence depends on.

1. Blocks of documents name their texts.  Two kinds of symbols go to shards of the name space, in packed arrays: small ones
   of round ``LOCAL``, each together with the words that it depends on; and long ones (``LONG`` words or more) of the
   rounds ``HIGH``, with their smallest id.  The shards answer, in order, whether a small one occurs more
   than once anywhere, and whether a smaller id has the long one.
2. A window of ``width`` words can only repeat if each small symbol that lies, with all that it depends on, inside it
   is shared.  A window inside a long symbol that a smaller id has does repeat.  All others that may
   are asked about: of equal ones in a block that with the smallest id, for all of them, is sent as 128 bits to a
   shard, which answers whether a smaller id has the same window.
   Windows that a long symbol settles need no asking: the smallest id that has the window is never settled and asks.
3. Words covered by repeated windows go.  Windows are judged on the input, not on what is left.

Equality is judged by two independent 64-bit hashes.  A word of up to sixteen bytes is a number, which a bijection mixes; a longer one has a
BLAKE2b digest.  Windows have two sums of the words' two hashes, long symbols two names; shards compare all 128 bits.  All hashes
depend on a seed that each run draws, so no text can be made to collide with another.  For 10**12 different windows the
expected number of false matches is below 10**-14.

Runs longer than a window hold no symbol inside it, so the windows within them always pass the first test of step 2.
All that is sent is packed arrays, one for each block and shard that occurs in it: a passage that every document
holds costs what any other passage costs.  A null or empty text has no words; rows that share an id don't count as
smaller than each other, and a null id is smaller than every other.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wordloom.llm.common import U64, Words, blocked, blocks_for, dealt, mix, new_seed, read_table, released, saved, unpacked, window_hash

WIDTH, LOCAL, HIGH, LONG = 13, 1, (11, 13), 20
NO_ID = -(1 << 63)
FAR = 1 << 40


class Symbols:
    """The symbols of a block of texts, round by round: name, first word, end word, and what they depend on."""

    def __init__(self, words: Words):
        n = len(words.hash)
        self.name, self.check = words.hash.copy(), words.check.copy()
        self.start = np.arange(n)
        self.end = self.start + 1
        self.low, self.high = self.start.copy(), self.end.copy()
        self.doc = words.document_of()

    def round(self, r: int) -> None:
        self._runs(r)
        self._pairs(r)

    def _edges(self) -> np.ndarray:
        """Whether a symbol is the first of its text."""
        return np.concatenate(([True], self.doc[1:] != self.doc[:-1]))

    def _seen(self, left: np.ndarray, right: np.ndarray) -> None:
        """Symbols that look at a neighbour depend on what it depends on; at a text's edge nothing is known."""
        first = self._edges()
        last = np.concatenate((first[1:], [True]))
        low = np.where(first, -FAR, np.concatenate(([0], self.low[:-1])))
        high = np.where(last, FAR, np.concatenate((self.high[1:], [0])))
        self.low = np.where(left, np.minimum(self.low, low), self.low)
        self.high = np.where(right, np.maximum(self.high, high), self.high)

    def _joined(self, begins: np.ndarray, name: np.ndarray, check: np.ndarray) -> None:
        """Symbols between one begin and the next become one."""
        at = np.flatnonzero(begins)
        stop = np.append(at[1:], len(begins)) - 1
        self.name, self.check = name, check
        self.start, self.end = self.start[at], self.end[stop]
        self.low = np.minimum.reduceat(self.low, at)
        self.high = np.maximum.reduceat(self.high, at)
        self.doc = self.doc[at]

    def _runs(self, r: int) -> None:
        if not len(self.name):
            return
        begins = self._edges() | np.concatenate(([True], (self.name[1:] != self.name[:-1]) | (self.check[1:] != self.check[:-1])))
        ends = np.concatenate((begins[1:], [True]))
        self._seen(begins, ends)
        at = np.flatnonzero(begins)
        length = np.diff(np.append(at, len(begins)))
        long = length > 1
        names = []
        for name in (self.name[at], self.check[at]):
            name[long] = mix(name[long] + length[long].astype(U64) * U64(0xA24BAED4963EE407) + U64(2 * r + 1))
            names.append(name)
        self._joined(begins, *names)

    def _pairs(self, r: int) -> None:
        if not len(self.name):
            return
        left = (mix(self.name + U64(0x9FB21C651E98DF25 + r)) & U64(1)).astype(bool)
        first = self._edges()
        second = ~left & ~first & np.concatenate(([False], left[:-1]))
        head = np.concatenate((second[1:], [False]))
        self._seen(~left & ~second, left & ~head)
        begins = ~second
        at = np.flatnonzero(head)
        names = []
        for old in (self.name, self.check):
            name = old.copy()
            name[at] = mix(old[at] * U64(0xD1342543DE82EF95) + mix(old[at + 1] + U64(0xAF251AF3B0F025B5)) + U64(2 * r))
            names.append(name[begins])
        self._joined(begins, *names)


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _owners(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Ids and how many hashes each has, compressed: steps between ids, one byte plane after another."""
    both = np.concatenate((np.diff(ids, prepend=0), counts)).astype("<i8")
    return zlib.compress(both.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _owned(raw: bytes) -> np.ndarray:
    """The id of each hash."""
    both = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()
    ids, counts = np.split(both, 2)
    return np.repeat(np.cumsum(ids), counts)


def _collected(answers, shards: dict[int, np.ndarray], n: int) -> np.ndarray:
    """The flags of n hashes from the shards' packed answers."""
    out = np.zeros(n, dtype=bool)
    for s, raw in answers:
        at = shards[s]
        out[at] = np.unpackbits(np.frombuffer(raw, np.uint8), count=len(at)).astype(bool)
    return out


def _alike(hashes: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal ones (both hashes) side by side, the smallest id first, and where new ones begin in it."""
    order = np.lexsort((ids, hashes))
    h, c = hashes[order], checks[order]
    same = h[1:] == h[:-1]
    if (same & (c[1:] != c[:-1])).any():
        order = np.lexsort((ids, checks, hashes))
        h, c = hashes[order], checks[order]
        same = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
    return order, np.concatenate((np.ones(min(1, len(h)), dtype=bool), ~same))


class _Asked:
    """128-bit hashes with the ids of their owners; of equal ones that with the smallest id stands for all when shards are asked."""

    def __init__(self, hashes: np.ndarray, checks: np.ndarray, ids: np.ndarray, shards: int):
        order, new = _alike(hashes, checks, ids)
        self.stands = np.empty(len(hashes), dtype=np.int64)
        self.stands[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        heads = np.sort(order[new])
        self.ids, self.heads, self.hashes = ids, heads, np.stack((hashes[heads], checks[heads]))
        self.shards = dealt((self.hashes[0] >> U64(20)) % U64(shards))

    def packets(self) -> dict[int, tuple[bytes, bytes]]:
        """For each shard the owners and the hashes, all first halves before all second ones."""
        ids, out = self.ids[self.heads], {}
        for s, k in self.shards.items():
            begins = np.flatnonzero(np.concatenate(([True], ids[k[1:]] != ids[k[:-1]])))
            out[s] = _owners(ids[k[begins]], np.diff(np.append(begins, len(k)))), self.hashes[:, k].tobytes()
        return out

    def earlier(self, answers) -> np.ndarray:
        """Which of the hashes a smaller id has, here or, by the shards' answers, elsewhere."""
        told = np.zeros(len(self.ids), dtype=bool)
        told[self.heads] = _collected(answers, self.shards, len(self.heads))
        return told[self.stands] | (self.ids[self.stands] < self.ids)


def _earlier(packets: list[bytes], ids: list[np.ndarray]) -> list[bytes]:
    """For each packet of hashes its flags: whether a smaller id has it too."""
    parts = [np.frombuffer(x, "<u8").reshape(2, -1) for x in packets]
    (h, c), d = np.concatenate(parts, axis=1), np.concatenate(ids)
    if not len(h):
        return [b""] * len(parts)
    order, new = _alike(h, c, d)
    first = np.flatnonzero(new)
    least = np.repeat(d[order][first], np.diff(np.append(first, len(h))))
    flag = np.empty(len(h), dtype=bool)
    flag[order] = least < d[order]
    return _flags(flag, [p[0] for p in parts])


def _recurs(hashes: list[np.ndarray]) -> list[bytes]:
    """For each packet the flags of its hashes: whether it occurs more than once."""
    h = np.concatenate(hashes)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    flag, none = np.empty(len(h), dtype=bool), np.zeros(min(1, len(h)), dtype=bool)
    flag[order] = np.concatenate((same, none)) | np.concatenate((none, same))
    return _flags(flag, hashes)


def _flags(flag: np.ndarray, parts: list[np.ndarray]) -> list[bytes]:
    ends = np.cumsum([len(p) for p in parts])
    return [_bits(flag[a:b]) for a, b in zip([0, *ends[:-1]], ends)]


class _Block:
    """A block's words, symbols and windows; the same in every step."""

    def __init__(self, table: pa.Table, shards: int, width: int, seed: int):
        self.docs, self.shards, self.width, self.seed = unpacked(table), shards, width, seed
        self.words = Words(self.docs.column("text"), seed=seed)
        ids = np.array([NO_ID if i is None else i for i in self.docs.column("doc_id").to_pylist()], dtype="<i8")
        self.ids = np.repeat(ids, np.diff(self.words.first))  # of each word
        self.prefix, self.back = self.words.word_prefixes()
        s = Symbols(self.words)
        starts, ends, names, checks = [], [], [], []
        for r in range(max(LOCAL, *HIGH) + 1):
            s.round(r)
            if r == LOCAL:
                k = (s.end - s.start >= 2) & (s.low >= 0) & (s.high - s.low <= width)
                self.low, self.high = s.low[k], s.high[k]
                self.names = mix(self._content(self.low, self.high) + s.name[k])
            if r in HIGH:
                k = s.end - s.start >= max(LONG, width)
                starts.append(s.start[k])
                ends.append(s.end[k])
                names.append(s.name[k])
                checks.append(s.check[k])
        self.start, self.end = np.concatenate(starts), np.concatenate(ends)
        self.long = _Asked(np.concatenate(names), np.concatenate(checks), self.ids[self.start], shards)
        self.small = dealt(mix(self.names ^ U64(0x5851F42D4C957F2D)) % U64(shards))

    def _content(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A hash of the words from a to b, for the filter of small symbols only."""
        return (self.prefix[b] - self.prefix[a]) * self.back[a]

    def windows(self, small, long) -> tuple[np.ndarray, np.ndarray, _Asked]:
        """From the answers: first words of the windows that repeat for certain, and of those asked about, with what is asked."""
        n, w = len(self.words.hash), self.width
        count = np.diff(self.words.first)
        last = np.repeat(self.words.first[1:], count) - w  # the last window of each word's text
        spoilt = np.zeros(n + 1, dtype=np.int64)  # windows over an unshared symbol
        gone = ~_collected(small, self.small, len(self.names))
        np.add.at(spoilt, np.maximum(self.high[gone] - w, 0), 1)
        np.add.at(spoilt, np.minimum(self.low[gone] + 1, n), -1)
        sure = np.zeros(n + 1, dtype=np.int64)  # windows within a repeated long symbol
        found = self.long.earlier(long)
        np.add.at(sure, self.start[found], 1)
        np.add.at(sure, self.end[found] - w + 1, -1)
        sure = np.cumsum(sure[:n]) > 0
        at = np.flatnonzero((np.cumsum(spoilt[:n]) == 0) & (np.arange(n) <= last) & ~sure)
        both = (window_hash(h, w, self.seed + k)[at] for k, h in ((1, self.words.hash), (2, self.words.check)))
        return np.flatnonzero(sure), at, _Asked(*both, self.ids[at], self.shards)


def substring_dedup(docs: DataFrame, width: int = WIDTH, carry: list[str] | None = None, blocks: int | None = None, untouched: bool = False) -> DataFrame:
    """doc_id, text (kept words joined by one space), n_words, n_removed; ``carry`` names other columns to keep.

    With ``untouched``, texts that lose nothing keep their white space.
    """
    carry = list(carry or [])
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    blocks = blocks or max(8, blocks_for(docs, 3 << 20))
    shards, seed = max(8, blocks), new_seed()
    held = blocked(base, blocks, tuple(carry))
    by_block = held.groupBy("b")

    def empty(fields):
        return pa.table([pa.array([], f[1]) for f in fields], names=[f[0] for f in fields])

    binary = pa.binary()

    def symbols(key, table):
        block = _Block(table, shards, width, seed)
        long = block.long.packets()
        rows = [(key[0].as_py(), s, block.names[block.small[s]].tobytes() if s in block.small else b"", *long.get(s, (_owners(np.zeros(0, "<i8"), np.zeros(0, "<i8")), b""))) for s in sorted({*block.small, *long})]
        kinds = (("b", pa.int32()), ("shard", pa.int32()), ("names", binary), ("owners", binary), ("long", binary))
        return pa.table([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], names=[k for k, _ in kinds])

    def shared(key, table):
        small = [np.frombuffer(x.as_py(), "<u8") for x in table.column("names")]
        bits = _earlier([x.as_py() for x in table.column("long")], [_owned(x.as_py()) for x in table.column("owners")])
        return pa.table([table.column("b"), table.column("shard"), pa.array(_recurs(small), binary), pa.array(bits, binary)], names=["b", "shard", "bits", "long"])

    names = by_block.applyInArrow(released(symbols), "b int, shard int, names binary, owners binary, long binary")
    answers = saved(names.groupBy("shard").applyInArrow(released(shared), "b int, shard int, bits binary, long binary"))

    def opened(table, told):
        """The block, and its windows by the answers of the first step."""
        block = _Block(table, shards, width, seed)
        first = [(s, x, y) for s, x, y, k in zip(*(told.column(c).to_pylist() for c in ("shard", "bits", "long", "step"))) if k == 1]
        return block, *block.windows([(s, x) for s, x, _ in first if s in block.small], [(s, y) for s, _, y in first if s in block.long.shards])

    def windows(key, table, told):
        if not table.num_rows:
            return empty([("b", pa.int32()), ("shard", pa.int32()), ("owners", binary), ("hashes", binary)])
        rows = [(key[0].as_py(), s, *x) for s, x in opened(table, told)[-1].packets().items()]
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), *(pa.array([r[c] for r in rows], binary) for c in (2, 3))], names=["b", "shard", "owners", "hashes"])

    def earlier(key, table):
        bits = _earlier([x.as_py() for x in table.column("hashes")], [_owned(x.as_py()) for x in table.column("owners")])
        return pa.table([table.column("b"), table.column("shard"), pa.array(bits, binary)], names=["b", "shard", "bits"])

    told = answers.withColumn("step", F.lit(1))
    found = by_block.cogroup(told.groupBy("b")).applyInArrow(released(windows), "b int, shard int, owners binary, hashes binary")
    found = found.groupBy("shard").applyInArrow(released(earlier), "b int, shard int, bits binary")
    told = told.unionByName(found.select("b", "shard", "bits", F.lit(None).cast("binary").alias("long"), F.lit(2).alias("step")))
    schema = T.StructType([*base.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    empty_like = pa.schema([(f.name, f.type) for f in to_arrow_schema(schema)]).empty_table()

    def cut(key, table, told):
        if not table.num_rows:
            return empty_like
        block, sure, at, asked = opened(table, told)
        second = [(s, x) for s, x, k in zip(*(told.column(c).to_pylist() for c in ("shard", "bits", "step"))) if k == 2]
        repeated = np.concatenate((sure, at[asked.earlier(second)]))
        n = len(block.words.hash)
        cover = np.zeros(n + 1, dtype=np.int64)
        np.add.at(cover, repeated, 1)
        np.add.at(cover, repeated + width, -1)
        gone = np.cumsum(cover[:n]) > 0
        first = block.words.first
        before = np.concatenate(([0], np.cumsum(gone)))
        texts = [block.words.kept_text(d, ~gone[first[d] : first[d + 1]]).decode() for d in range(len(first) - 1)]
        if untouched:
            old = block.docs.column("text").to_pylist()
            texts = [t if before[b] > before[a] else o for t, o, a, b in zip(texts, old, first, first[1:])]
        cols = {c: block.docs.column(c) for c in block.docs.column_names} | {"text": pa.array(texts, pa.string())}
        cols |= {"n_words": pa.array(np.diff(first), pa.int64()), "n_removed": pa.array(before[first[1:]] - before[first[:-1]], pa.int64())}
        return pa.table(cols)

    return by_block.cogroup(told.groupBy("b")).applyInArrow(released(cut), schema)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))

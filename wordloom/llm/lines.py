"""Removal of lines that many documents share, through a sharded minimal perfect hash.

1. Each block of documents counts its distinct line keys (128-bit hashes) and finds the largest id that
   holds each; blocks send packed arrays, one for each shard of the hash space, so a line that
   every document holds is a few entries a block and not one for each document.
2. Each shard adds the counts up, keeps the keys found in ``min_docs`` documents or more (no document loses any
   other) and builds a minimal perfect hash over them: levels of bit arrays, where a key sits at the first level at
   which no other key shares its bit, and its index is the number of bits before it.  Compact arrays
   beside it hold fingerprint, count and largest id.
3. Documents probe the arrays; lines are never joined.  Every task holds one such index of the most frequent keys, as many as fit in
   ``broadcast_bytes``.  Probes of the others (hashes only) go to their shards and the answers come back by document; no such
   key is frequent, so no shard gets many probes of one.

A key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, with A-Z lower-cased; keys under ``min_chars``
code points are left alone.  A null or empty text is one empty line.  Rows that share an id
count as documents of their own, and all of them are the largest if that id is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import U64, blocks_for, dealt, id_and_text, mix, read_table, saved, slices

WHITE = " \t\n\v\f\r"
MIN_CHARS, MIN_DOCS = 40, 5
BROADCAST_BYTES = 64 << 20
NO_ID = -(1 << 63)
TIERS = 4 * 32 + 1
RECORD = np.dtype([("a", "<u8"), ("b", "<u8"), ("id", "<i8"), ("n", "<u4")])


def key_hash(line: str, min_chars: int) -> bytes | None:
    key = line.strip(WHITE)
    return hashlib.blake2b(key.encode().lower(), digest_size=16).digest() if len(key) >= min_chars else None


# --- minimal perfect hash ------------------------------------------------------------------------


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    turn = U64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return ((mix(a ^ turn) + mix(b + turn)) % U64(size)).astype(np.int64)


class PerfectHash:
    """Maps each of a set of distinct 128-bit keys (a, b) to an index of its own below their number."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = []
        before = 0
        for bits in levels:
            r = np.cumsum(bits, dtype=np.int64) - bits + before
            self.ranks.append(r)
            before += int(bits.sum())

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        """Repeated keys would never part: they are an error."""
        order = np.lexsort((b, a))
        if ((a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])).any():
            raise ValueError("repeated keys")
        levels = []
        while len(a):
            size = 2 * len(a) + 1
            place = _place(a, b, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            left = ~alone[place]
            a, b = a[left], b[left]
        return cls(levels)

    def index(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The index of each key; -1, or that of some other key, for one that is not of the set."""
        out, left = np.full(len(a), -1, dtype=np.int64), np.arange(len(a))
        for k, bits in enumerate(self.levels):
            if not len(left):
                break
            place = _place(a[left], b[left], k, len(bits))
            hit = bits[place]
            out[left[hit]] = self.ranks[k][place[hit]]
            left = left[~hit]
        return out


def shard_bytes(records: np.ndarray) -> bytes:
    """A shard as bytes: level sizes, level bits, then fingerprints, counts and largest ids by index."""
    h = PerfectHash.of(records["a"], records["b"])
    order = np.empty(len(records), dtype=np.int64)
    order[h.index(records["a"], records["b"])] = np.arange(len(records))
    r = records[order]
    sizes = np.array([len(r), len(h.levels), *map(len, h.levels)], dtype="<i8")
    return b"".join([sizes.tobytes(), *(np.packbits(x).tobytes() for x in h.levels), r["b"].tobytes(), r["id"].tobytes(), r["n"].tobytes()])


class Shard:
    def __init__(self, raw: bytes):
        n, depth = np.frombuffer(raw, "<i8", 2).tolist()
        sizes = np.frombuffer(raw, "<i8", depth, 16).tolist()
        at, levels = 16 + 8 * depth, []
        for size in sizes:
            k = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, k, at), count=size).astype(bool))
            at += k
        self.hash = PerfectHash(levels)
        self.mark = np.frombuffer(raw, "<u8", n, at)
        self.largest = np.frombuffer(raw, "<i8", n, at + 8 * n)
        self.count = np.frombuffer(raw, "<u4", n, at + 16 * n)

    def lost(self, a: np.ndarray, b: np.ndarray, mine: np.ndarray, min_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are of the set, and which of all a document of id ``mine`` loses."""
        if not len(self.mark):
            return np.zeros(len(a), dtype=bool), np.zeros(len(a), dtype=bool)
        k = self.hash.index(a, b)
        known = (k >= 0) & (self.mark[k] == b)
        return known, known & (self.count[k] >= min_docs) & (self.largest[k] != mine)


def _shard_of(a: np.ndarray, shards: int) -> np.ndarray:
    return ((a >> U64(20)) % U64(shards)).astype(np.int64)


def _tier(n: np.ndarray) -> np.ndarray:
    """Quarter powers of two of the counts."""
    return np.floor(4 * np.log2(np.maximum(n, 1))).astype(np.int64)


# --- steps ---------------------------------------------------------------------------------------


def _summed(records: np.ndarray) -> np.ndarray:
    """One record for each key: counts added, largest id."""
    r = records[np.lexsort((records["b"], records["a"]))]
    if not len(r):
        return r
    first = np.flatnonzero(np.concatenate(([True], (r["a"][1:] != r["a"][:-1]) | (r["b"][1:] != r["b"][:-1]))))
    out = r[first].copy()
    out["n"] = np.minimum(np.add.reduceat(r["n"].astype(np.int64), first), (1 << 32) - 1)
    out["id"] = np.maximum.reduceat(r["id"], first)
    return out


def line_index(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shards: int | None = None) -> tuple[DataFrame, int]:
    """(shard, index bytes) for docs (doc_id, text), in the shared folder; and the number of shards."""
    shards = shards or max(8, 2 * blocks_for(docs, 16 << 20))

    def count(batches):
        for batch in batches:
            for part in slices(batch, limit=16 << 20):
                seen: dict[bytes, list[int]] = {}
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    i = NO_ID if i is None else i
                    for h in {key_hash(line, min_chars) for line in (t or "").split("\n") if len(line) >= min_chars} - {None}:
                        if (x := seen.get(h)) is None:
                            seen[h] = [1, i]
                        else:
                            x[0] += 1
                            if i > x[1]:
                                x[1] = i
                r = np.zeros(len(seen), dtype=RECORD)
                ab = np.frombuffer(b"".join(seen), "<u8").reshape(-1, 2)
                r["a"], r["b"] = ab[:, 0], ab[:, 1]
                r["n"], r["id"] = [x[0] for x in seen.values()], [x[1] for x in seen.values()]
                parts = [(k, r[at].tobytes()) for k, at in dealt(_shard_of(r["a"], shards)).items()]
                yield pa.record_batch([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], names=["shard", "packed"])

    def build(key, table):
        records = np.concatenate([np.frombuffer(x.as_py(), dtype=RECORD) for x in table.column("packed")])
        records = _summed(records)
        records = records[records["n"] >= min_docs]
        sizes = np.bincount(_tier(records["n"]), minlength=TIERS).tolist()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([shard_bytes(records)], pa.binary()), pa.array([records.tobytes()], pa.binary()), pa.array([sizes], pa.list_(pa.int64()))], names=["shard", "raw", "records", "sizes"])

    return saved(docs.mapInArrow(count, "shard int, packed binary").groupBy("shard").applyInArrow(build, "shard int, raw binary, records binary, sizes array<long>")), shards


def frequent(index: DataFrame, most_bytes: int) -> tuple[np.ndarray, bool]:
    """The records of the most frequent keys, as many tiers of them as stay under ``most_bytes``; and whether those are all."""
    tiers = index.select(F.posexplode("sizes").alias("tier", "k")).groupBy("tier").agg(F.sum("k").alias("k")).collect()
    sizes = np.zeros(TIERS, dtype=np.int64)
    for r in tiers:
        sizes[r.tier] = r.k
    over = np.cumsum(sizes[::-1])[::-1] * RECORD.itemsize
    least = next((k for k in range(TIERS) if over[k] <= most_bytes), TIERS)

    def chosen(batches):
        for batch in batches:
            for raw in batch.column(0):
                r = np.frombuffer(raw.as_py(), dtype=RECORD)
                yield pa.record_batch([pa.array([r[_tier(r["n"]) >= least].tobytes()], pa.binary())], names=["records"])

    parts = [bytes(r.records) for r in index.select("records").mapInArrow(chosen, "records binary").collect()]
    return np.frombuffer(b"".join(parts), dtype=RECORD), not sizes[:least].any()


class _Cut:
    """Cuts texts, given the line keys that they lose."""

    def __init__(self, min_chars: int):
        self.min_chars = min_chars

    def lines(self, text: str | None):
        lines = (text or "").split("\n")
        return lines, [key_hash(x, self.min_chars) if len(x) >= self.min_chars else None for x in lines]

    @staticmethod
    def batch(part: pa.RecordBatch, texts: list[str], n_lines: list[int], n_dropped: list[int]) -> pa.RecordBatch:
        """The columns of part with its texts replaced, and the two counts."""
        cols = {name: part.column(i) for i, name in enumerate(part.schema.names)} | {"text": pa.array(texts, pa.string())}
        cols |= {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
        return pa.record_batch(list(cols.values()), names=list(cols))


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, carry: list[str] | None = None, broadcast_bytes: int = BROADCAST_BYTES, shards: int | None = None) -> DataFrame:
    """doc_id, text without the lines that go, n_lines (before), n_dropped; ``carry`` names other columns to keep."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(carry or []))
    schema = T.StructType([*base.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    index, shards = line_index(id_and_text(docs), min_docs, min_chars, shards)
    records, whole = frequent(index, broadcast_bytes)
    shared = spark.sparkContext.broadcast(shard_bytes(records))  # at most broadcast_bytes and the level bits
    cut = _Cut(min_chars)

    def probed(part, hot):
        """The lines and keys of each text, the distinct (text, key) pairs as arrays, and what the index of frequent keys says of them."""
        both = [cut.lines(t) for t in part.column(1).to_pylist()]
        pairs = [(d, k) for d, (_, ks) in enumerate(both) for k in {*ks} - {None}]
        ab = np.frombuffer(b"".join([k for _, k in pairs]), "<u8").reshape(-1, 2)
        ids = np.asarray(pc.fill_null(part.column(0), NO_ID), dtype="<i8")
        mine = ids[np.array([d for d, _ in pairs], dtype=np.int64)]
        return both, pairs, ab, mine, *hot.lost(ab[:, 0], ab[:, 1], mine, min_docs)

    def drop(batches):
        """Cuts texts; where not all keys are frequent, the last column has the other keys that a text loses."""
        hot = Shard(shared.value)
        for batch in batches:
            for part in slices(batch):
                gone: dict[int, set[bytes]] = {}
                if not whole:
                    gone = {d: set(x) for d, x in enumerate(part.column(part.num_columns - 1).to_pylist()) if x}
                    part = part.select(part.schema.names[:-1])
                both, pairs, _, _, _, lost = probed(part, hot)
                for i in np.flatnonzero(lost).tolist():
                    gone.setdefault(pairs[i][0], set()).add(pairs[i][1])
                kept = [[x for x, k in zip(ls, ks) if k not in gone[d]] if d in gone else ls for d, (ls, ks) in enumerate(both)]
                yield cut.batch(part, ["\n".join(x) for x in kept], [len(ls) for ls, _ in both], [len(ls) - len(x) for (ls, _), x in zip(both, kept)])

    if whole:
        return base.mapInArrow(drop, schema)

    def ask(batches):
        hot = Shard(shared.value)
        for batch in batches:
            for part in slices(batch):
                _, _, ab, mine, known, _ = probed(part, hot)
                ab, mine = ab[~known], mine[~known]
                at = dealt(_shard_of(ab[:, 0], shards))
                yield pa.record_batch([pa.array(list(at), pa.int32()), pa.array([mine[x].tobytes() for x in at.values()], pa.binary()), pa.array([ab[x].tobytes() for x in at.values()], pa.binary())], names=["shard", "ids", "hashes"])

    def answer(key, asked, index):
        ids, hashes = [np.zeros(0, "<i8")], []
        if asked.num_rows and index.num_rows:
            shard = Shard(index.column("raw")[0].as_py())
            for i, h in zip(asked.column("ids"), asked.column("hashes")):
                mine, ab = np.frombuffer(i.as_py(), "<i8"), np.frombuffer(h.as_py(), "<u8").reshape(-1, 2)
                _, lost = shard.lost(ab[:, 0], ab[:, 1], mine, min_docs)
                ids.append(mine[lost])
                hashes += [x.tobytes() for x in ab[lost]]
        return pa.table([pa.array(np.concatenate(ids)), pa.array(hashes, pa.binary())], names=["k", "hash"])

    asked = base.select("doc_id", "text").mapInArrow(ask, "shard int, ids binary, hashes binary")
    lost = asked.groupBy("shard").cogroup(index.select("shard", "raw").groupBy("shard")).applyInArrow(answer, "k long, hash binary")
    lost = lost.groupBy("k").agg(F.collect_set("hash").alias("lost_keys"))
    return base.join(lost, F.coalesce(base["doc_id"], F.lit(NO_ID)) == lost["k"], "left").drop(lost["k"]).mapInArrow(drop, schema)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))

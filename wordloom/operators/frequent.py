"""Marks of frequent n-grams: where a gram that is rarer than asked for need not move.

Most n-grams of a corpus occur once or twice.  Texts are read once to count hashes of 32 to 40 bits of their grams (sorted packets of a block's distinct hashes, as their
steps, go to the shard of their first bits), and what comes back is a bitmap for each size, at most ``BITMAP_BITS`` bits, of the hashes found ``least`` times.  Then only grams whose bit is set
are written out.  A gram with ``least`` occurrences always has its bit, so counts over what is left are exact for it; rarer grams may be left, with whole counts or none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP_BITS, SHARD_BITS, HELD, LARGEST = 28, 8, 1 << 22, 7
_STEP = pa.schema([("size", pa.int32()), ("shard", pa.int32()), ("count", pa.int32()), ("packet", pa.binary())])


def _keys(words: np.ndarray, size: int) -> np.ndarray:
    """The 40-bit hash of the gram of ``size`` words at each place, from the words' hashes."""
    h = words[: max(0, len(words) - size + 1)].copy()
    for k in range(1, size):
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= words[k : k + len(h)]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h >> np.uint64(24)


def _whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes of a column of lists, and the number of words of each row (null: none)."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), sizes


def _inside(sizes: np.ndarray, size: int) -> np.ndarray:
    """Whether the gram at each place ends in the row in which it begins."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row[: max(0, len(row) - size + 1)] == row[size - 1 :]


def hashed(words: str):
    return F.transform(words, lambda w: F.xxhash64(w))


def marks(docs: DataFrame, sizes: tuple[int, ...], least: int, words: str = "words") -> dict[int, np.ndarray]:
    """size -> bitmap of the grams of docs (an array of words) with ``least`` (at most 255) occurrences."""
    if not 1 <= least <= 255 or not all(1 <= s <= LARGEST for s in sizes):
        raise ValueError("least must be 1 to 255, sizes 1 to 7")
    read = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # a bit for each byte of input or so: some sixteen for each frequent gram; shards have at most about 2**24 hashes
    bits = min(BITMAP_BITS, max(20, read.bit_length()))
    shard_bits = min(20, SHARD_BITS + max(0, (read >> 32).bit_length()))
    # five bits more than the bitmap of so large a table would need: a longer hash tells few more grams apart, and every bit of it moves
    key_bits = min(40, max(32, read.bit_length() + 5))
    low_bits = key_bits - shard_bits

    def packed(keys: list[np.ndarray], size: int) -> pa.RecordBatch:
        u, n = np.unique(np.concatenate(keys) >> np.uint64(40 - key_bits), return_counts=True)
        n = np.minimum(n, 255).astype(np.uint8)
        shards, at = np.unique(u >> np.uint64(low_bits), return_index=True)
        ends = np.append(at[1:], len(u))
        low = (u & np.uint64((1 << low_bits) - 1)).astype(np.uint32)
        # first bytes of all steps together, then the second ones, and the counts: what is alike compresses
        planes = [np.diff(low[a:b], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes() + n[a:b].tobytes() for a, b in zip(at, ends)]
        packets = [pa.compress(x, codec="zstd", asbytes=True) for x in planes]
        return pa.record_batch([pa.array([size] * len(shards), pa.int32()), pa.array(shards.astype(np.int32)), pa.array((ends - at).astype(np.int32)), pa.array(packets, pa.binary())], schema=_STEP)

    def pack(batches):
        held: dict[int, list] = {s: [] for s in sizes}
        count = 0
        for batch in batches:
            h, lengths = _whole(batch.column(0))
            for s in sizes:
                held[s].append(_keys(h, s)[_inside(lengths, s)])
            count += len(h)
            if count >= HELD:
                yield from (packed(held[s], s) for s in sizes)
                held, count = {s: [] for s in sizes}, 0
        if count:
            yield from (packed(held[s], s) for s in sizes)

    def merge(key, table):
        bytes_ = [np.frombuffer(pa.decompress(x, 5 * c, codec="zstd", asbytes=True), np.uint8) for x, c in zip(table["packet"].to_pylist(), table["count"].to_pylist())]
        low = np.concatenate([np.cumsum(x[: len(x) // 5 * 4].reshape(4, -1).T.copy().view(np.uint32).ravel(), dtype=np.uint32) for x in bytes_])
        n = np.concatenate([x[len(x) // 5 * 4 :] for x in bytes_])
        order = np.argsort(low, kind="stable")
        low = low[order]
        starts = np.flatnonzero(np.append(True, low[1:] != low[:-1])) if len(low) else np.zeros(0, np.int64)
        enough = np.add.reduceat(n[order].astype(np.int64), starts) >= least if len(low) else np.zeros(0, bool)
        part = np.zeros(1 << (bits - shard_bits), bool)
        part[low[starts][enough] >> np.uint32(key_bits - bits)] = True
        row = [key[0].as_py()], [key[1].as_py()], [np.packbits(part, bitorder="little").tobytes()]
        return pa.table([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.binary()))], names=["size", "shard", "part"])

    packets = docs.select(hashed(words).alias("h")).mapInArrow(pack, "size int, shard int, count int, packet binary")
    parts = packets.groupBy("size", "shard").applyInArrow(merge, "size int, shard int, part binary")
    out = {s: np.zeros(1 << (bits - 3), np.uint8) for s in sizes}
    each = 1 << (bits - shard_bits - 3)
    for r in parts.collect():  # the bitmaps' slices
        out[r.size][r.shard * each : (r.shard + 1) * each] = np.frombuffer(r.part, np.uint8)
    return out


def hits(hashes: pa.Array, size: int, bitmap: np.ndarray) -> np.ndarray:
    """Whether the bit of the gram of ``size`` words at each place is set; hashes: a column of lists."""
    slots = _keys(_whole(hashes)[0], size) >> np.uint64(40 - (len(bitmap) * 8).bit_length() + 1)
    return ((bitmap[(slots >> np.uint64(3)).astype(np.int64)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def with_places(docs: DataFrame, marked: dict[int, np.ndarray], words: str = "words") -> DataFrame:
    """docs with places: for each gram whose bit is in marked, as from marks(), eight times its place (from 0) plus its size."""
    sizes, shared = sorted(marked), docs.sparkSession.sparkContext.broadcast(marked)

    def places(h: pa.Array) -> pa.Array:
        lengths = _whole(h)[1]
        found = [np.flatnonzero(hits(h, s, shared.value[s]) & _inside(lengths, s)) * 8 + s for s in sizes]
        code = np.sort(np.concatenate(found))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        offsets = np.searchsorted(code, ends * 8)
        begun = np.repeat(ends[:-1], np.diff(offsets))
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array((code - begun * 8).astype(np.int32)))

    return docs.withColumn("places", F.arrow_udf(places, "array<int>")(hashed(words)))

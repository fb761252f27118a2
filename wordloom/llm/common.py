"""Shared pieces of the corpus operators: Arrow batches, word hashing, bounded memos, tables.

Conventions that hold for every operator of this subpackage:

* an operator reads the columns it is told to read (``id_col``, ``text_col``) and selects them first,
  so extra columns, whatever their names, never reach it;
* a null text counts as the empty text unless the operator says otherwise;
* rows that share an id are separate rows, and each gets its own result row;
* a row with a null id is scored or counted like any other; operators that compare ids treat it as
  smaller than every real id.
"""

from __future__ import annotations

import ctypes
import hashlib
import secrets
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sources.readers import columnar

SLICE_BYTES = 4 << 20
U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str, ordered: bool = False) -> DataFrame:
    """The table; one of under 64 MB and few files is dealt over the cores (see columnar), all others are read as they lie."""
    return columnar(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", most=64 << 20, ordered=ordered)


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def remainder(id_column, modulus: int):
    """crc32 of the id written as text, modulo ``modulus``: the split into learning and held-out rows."""
    return F.crc32(id_column.cast("string").cast("binary")) % F.lit(modulus)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of text (one row at least)."""
    col = batch.column(batch.schema.get_field_index(column))
    size = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
    cum = np.concatenate(([0], np.cumsum(size)))
    i, n = 0, len(size)
    while i < n:
        j = max(i + 1, int(np.searchsorted(cum, cum[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


class Memo(dict):
    """A bounded cache of a pure function: once full it still answers, but keeps no more results."""

    def __init__(self, compute: Callable, size: int = 1 << 19):
        super().__init__()
        self.compute, self.size = compute, size

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.size:
            self[key] = value
        return value


# --- words of a block of texts as arrays ---------------------------------------------------------

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2**64, and those of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(max(n, (1 << 20) + 4096), base, dtype=U64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits, so that any bits of the result may be used."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def new_seed() -> int:
    """A seed for the hashes of one run: no text can be made to collide before it is drawn."""
    return secrets.randbits(62)


#: The bytes of a 64-bit lane past a word of k bytes: 0xFF, which occurs in no UTF-8 text.
_PAST = np.array([(0xFFFFFFFFFFFFFFFF << 8 * k) & 0xFFFFFFFFFFFFFFFF for k in range(9)], dtype=U64)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a block of texts.

    ``start``/``end`` are byte positions in ``data``; ``first[d]:first[d + 1]`` are the words of text d.
    ``hash`` and ``check`` have 64 bits each for every word.  Words of up to sixteen bytes are numbers of 128 bits, mixed by a bijection:
    unlike ones are unlike.  Longer ones have a BLAKE2b digest of 128 bits.  Both depend on the seed.
    """

    def __init__(self, column: pa.Array, lower: bool = False, hashed: bool = True, seed: int = 0):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column, "").cast(pa.large_string())
        _, offsets, data = column.buffers()
        off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        base = int(off[0])
        self.data = np.frombuffer(data, dtype=np.uint8)[base : int(off[-1])] if data is not None else np.zeros(0, np.uint8)
        off = off - base
        if lower:
            self.data = _LOWER[self.data]
        n = len(self.data)
        word = np.zeros(n + 1, dtype=bool)
        np.logical_not(_WHITE[self.data], out=word[:n])
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True
        begins = word[:n].copy()
        begins[1:] &= ~word[: n - 1] | edge[1:n]
        ends = word[:n] & (~word[1:] | edge[1:])
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, off)
        if hashed:
            self.hash, self.check = self._hashes(seed)

    def _hashes(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        size = self.end - self.start
        padded = np.concatenate((self.data, np.full(16, 0xFF, dtype=np.uint8)))
        lanes = np.ndarray(len(self.data) + 9, dtype="<u8", buffer=padded, strides=(1,))
        keys = np.random.default_rng(seed).integers(1, 1 << 62, 4).astype(U64)
        one, two = lanes[self.start] | _PAST[np.minimum(size, 8)], lanes[self.start + 8] | _PAST[np.clip(size - 8, 0, 8)]
        for k in (0, 2):
            two ^= mix(one + keys[k])
            one ^= mix(two + keys[k + 1])
        long = np.flatnonzero(size > 16)
        if len(long):
            view, key = memoryview(padded), seed.to_bytes(8, "little")
            memo = Memo(lambda w: hashlib.blake2b(w, digest_size=16, key=key).digest(), 1 << 16)
            spans = zip(self.start[long].tolist(), self.end[long].tolist())
            raw = b"".join([memo[bytes(view[a:b])] if b - a <= 64 else memo.compute(view[a:b]) for a, b in spans])
            both = np.frombuffer(raw, dtype="<u8").reshape(-1, 2)
            one[long], two[long] = both[:, 0], both[:, 1]
        return one, two

    def word_prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of the words' hashes as polynomials, and the factors that shift a difference back to its start.

        Unlike passages may well agree here, some (Thue-Morse sequences) always do: a filter, no proof of equality.
        """
        up, down = _powers(len(self.hash) + 1)
        return np.concatenate((np.zeros(1, dtype=U64), np.cumsum(self.hash * up[:-1], dtype=U64))), down

    def document_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def kept_text(self, d: int, keep: np.ndarray) -> bytes:
        """The kept words of text d joined by single spaces; ``keep`` covers the words of d."""
        i, j = self.first[d], self.first[d + 1]
        buf = self.data
        s, e = self.start[i:j][keep].tolist(), self.end[i:j][keep].tolist()
        raw = buf[int(self.start[i]) : int(self.end[j - 1])].tobytes() if j > i else b""
        o = int(self.start[i]) if j > i else 0
        return b" ".join([raw[a - o : b - o] for a, b in zip(s, e)])


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: 0


def release() -> None:
    """Give freed memory back to the system: workers live on, and what a block's arrays took would stay with them."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def released(block: Callable) -> Callable:
    """The function of a group (key and one or two tables), with memory given back after each."""

    def one(key, table):
        try:
            return block(key, table)
        finally:
            release()

    def two(key, left, right):
        try:
            return block(key, left, right)
        finally:
            release()

    return two if block.__code__.co_argcount == 3 else one


def window_hash(h: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of every ``width`` consecutive entries of h (length len(h) - width + 1): a sum with odd factors drawn by the seed."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    rng = np.random.default_rng(seed)
    out = np.zeros(n, dtype=U64)
    for k in range(width):
        out += h[k : k + n] * U64(int(rng.integers(1, 1 << 62)) * 2 + 1)
    return mix(out)


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where none is set, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(where)
        return where
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wordloom-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def saved(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, no executor holds the only copy."""
    scratch(df.sparkSession)
    return df.checkpoint(eager=True)


def table_bytes(df: DataFrame, column: str) -> int:
    """About how large df is: Spark's own statistics where its leaves are files, which it doesn't read for that; else the measured column."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    if all(x.nodeName().startswith(("LogicalRelation", "RelationV2")) for x in leaves):
        return min(int(str(x)) for x in (plan.stats().sizeInBytes(), sum(int(str(x.stats().sizeInBytes())) for x in leaves)))
    return df.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0


def blocks_for(df: DataFrame, bytes_each: int = 8 << 20, column: str = "text") -> int:
    """A number of blocks for a table; it grows with the table, without an end."""
    return max(1, min((1 << 31) - 1, table_bytes(df, column) // bytes_each + 1))


def dealt(shard: np.ndarray) -> dict[int, np.ndarray]:
    """The places of each shard that occurs, in order: its size follows the entries, however many shards there are."""
    order = np.argsort(shard, kind="stable")
    values, first = np.unique(shard[order], return_index=True)
    return dict(zip(values.tolist(), np.split(order, first[1:])))


# --- documents in blocks -------------------------------------------------------------------------


def block_of(blocks: int):
    """The block of a row (doc_id, text); rows without an id are dealt by their text."""
    return F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text"))), F.lit(blocks)).cast("int")


def blocked(docs: DataFrame, blocks: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(b, packed): docs (doc_id, text, carried columns) dealt over blocks by id, compressed, in the shared folder, partitioned by b.

    Steps that ask other parts of the cluster about a block's contents get their answers by block, so
    the texts themselves move once.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=16 << 20):
                b = np.asarray(part.column(part.num_columns - 1))
                order = np.argsort(b, kind="stable")
                values, first = np.unique(b[order], return_index=True)
                table = part.select(part.schema.names[:-1]).take(pa.array(order))
                packed = []
                for i, j in zip(first, [*first[1:], len(order)]):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
                        w.write_batch(table.slice(i, j - i))
                    packed.append(sink.getvalue().to_pybytes())
                yield pa.record_batch([pa.array(values, pa.int32()), pa.array(packed, pa.binary())], names=["b", "packed"])
        release()

    rows = docs.select("doc_id", "text", *carry).withColumn("block", block_of(blocks)).mapInArrow(run, "b int, packed binary")
    # with fewer partitions than a shuffle has, the joins by block would deal the texts anew
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(blocks, max(4096, blocks // 256)))
    conf, name = docs.sparkSession.conf, "spark.sql.adaptive.enabled"
    adaptive = conf.get(name)
    conf.set(name, "false")  # an adaptive plan doesn't tell how its rows are partitioned; the table's readers want to know
    try:
        return saved(rows.repartition(parts, "b"))
    finally:
        conf.set(name, adaptive)


def unpacked(table: pa.Table) -> pa.Table:
    """A block's documents in a fixed order: by id, equal ids by text."""
    parts = [pa.ipc.open_stream(x.as_py()).read_all() for x in table.column("packed")]
    docs = pa.concat_tables(parts)
    return docs.take(pc.sort_indices(docs, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])).combine_chunks()

"""Groups of equal texts by composable polynomial fingerprints.

A text is normalised (A-Z lower-cased, null as empty) and cut into chunks of ``CHUNK`` bytes; a chunk's hash is
its polynomial in two bases modulo two primes.  Hashes of neighbouring chunks combine by
length-shifted arithmetic, hash(xy) = hash(x) * base**len(y) + hash(y), so the chunks of a huge text (over ``HUGE``
characters), which is cut once by bytes, are hashed by many tasks and combined afterwards, and any other text by one task.

Rows with the same fingerprint and length form a group.  Only texts that may be of a group move: a bitmap of the groups'
fingerprints (at most ``BITMAP_BITS`` bits) drops the others where they are read.  Equality is then shown chunk by chunk: a group's texts
are equal if at each place the smallest and the largest chunk are one.  That is an aggregate, so copies collapse
before they are shuffled and a group of any size costs one chunk a task and place.
Should texts differ in spite of equal fingerprints, the group falls apart by their SHA-256 digests.

Of equal texts the row with the largest id stays.  Rows that share that id all stay.  An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import id_and_text, read_table, saved, slices

CHUNK, HUGE = 1 << 16, 4 << 20
BITMAP_BITS = 1 << 29
PRIMES, BASES = (2147483647, 2147483629), (1000003, 998244353)
NO_ID = -(1 << 63)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_powers: list[np.ndarray] = []


def _descending() -> list[np.ndarray]:
    """base**(CHUNK - 1), ..., base, 1 for either prime."""
    if not _powers:
        for p, b in zip(PRIMES, BASES):
            x = [1]
            for _ in range(CHUNK - 1):
                x.append(x[-1] * b % p)
            _powers.append(np.array(x[::-1], dtype=np.int64))
    return _powers


def chunk_hash(chunk: bytes) -> tuple[int, int]:
    data = np.frombuffer(chunk, dtype=np.uint8).astype(np.int64) + 1
    return tuple(int(np.dot(data, w[CHUNK - len(data) :])) % p for w, p in zip(_descending(), PRIMES))


def combine(left: tuple[int, int], right: tuple[int, int], right_length: int) -> tuple[int, int]:
    """The hash of two texts put together, from their hashes and the length of the second."""
    return tuple((x * pow(b, right_length, p) + y) % p for x, y, b, p in zip(left, right, BASES, PRIMES))


def fingerprint(raw: bytes) -> tuple[int, int]:
    h = (0, 0)
    for i in range(0, len(raw), CHUNK):
        part = raw[i : i + CHUNK]
        h = combine(h, chunk_hash(part), len(part))
    return h


def _packed(h: tuple[int, int]) -> int:
    return h[0] << 31 | h[1]


def _pieces(docs: DataFrame, schema: str, size: int = CHUNK, at_once: int = 64) -> DataFrame:
    """The chunks of normalised texts: docs' columns but the last, text, then sha, k, chunk; each text is cut once, by bytes."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for i in range(batch.num_rows):
                raw = (texts[i].as_py() or "").encode().lower()
                sha = hashlib.sha256(raw).hexdigest()
                for k in range(0, max(1, len(raw)), size * at_once):
                    parts = [raw[j : j + size] for j in range(k, min(max(1, len(raw)), k + size * at_once), size)]
                    own = [batch.column(c).take(pa.array([i] * len(parts))) for c in range(batch.num_columns - 1)]
                    yield pa.RecordBatch.from_arrays([*own, pa.array([sha] * len(parts)), pa.array(range(k // size, k // size + len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=names)

    return docs.mapInArrow(run, schema)


def fingerprints(docs: DataFrame, huge: int = HUGE) -> DataFrame:
    """doc_id, fp, n_bytes, text_sha256 of the normalised texts of docs (doc_id, text)."""

    def plain(batches):
        for batch in batches:
            for part in slices(batch):
                raw = [(t or "").encode().lower() for t in part.column(1).to_pylist()]
                cols = [pa.array([_packed(fingerprint(r)) for r in raw], pa.int64()), pa.array([len(r) for r in raw], pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raw])]
                yield pa.record_batch([part.column(0), *cols], names=["doc_id", "fp", "n_bytes", "text_sha256"])

    def chunks(batches):
        for batch in batches:
            raw = batch.column(3).to_pylist()
            hs = [fingerprint(r) for r in raw]
            cols = [pa.array([h[k] for h in hs], pa.int64()) for k in (0, 1)] + [pa.array([len(r) for r in raw], pa.int64())]
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), *cols], names=["doc_id", "sha", "k", "h1", "h2", "n"])

    def joined(key, table):
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("k", "h1", "h2", "n"))))
        h, size = (0, 0), 0
        for _, a, b, n in rows:
            h, size = combine(h, (a, b), n), size + n
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([_packed(h)], pa.int64()), pa.array([size], pa.int64()), pa.array([key[1].as_py()]), pa.array(table.column("copies").to_pylist()[:1], pa.int64())], names=["doc_id", "fp", "n_bytes", "text_sha256", "copies"])

    schema = "doc_id long, fp long, n_bytes long, text_sha256 string"
    big = F.coalesce(F.length("text"), F.lit(0)) > huge
    small = docs.where(~big).mapInArrow(plain, schema)
    large = _pieces(docs.where(big).select("doc_id", "text"), "doc_id long, sha string, k int, chunk binary")
    large = large.repartition(F.col("doc_id"), F.col("k")).mapInArrow(chunks, "doc_id long, sha string, k int, h1 long, h2 long, n long")
    # a repeated row gives each of its chunks twice: one copy is combined, and the groups count rows of docs again
    large = large.groupBy("doc_id", "sha", "k").agg(F.min("h1").alias("h1"), F.min("h2").alias("h2"), F.min("n").alias("n"), F.count("*").alias("copies"))
    large = large.groupBy("doc_id", "sha").applyInArrow(joined, f"{schema}, copies long")
    large = large.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies")
    return small.unionByName(large)


def _slot(fp, bits: int):
    """The place of a fingerprint in a bitmap of a power of two bits: of a column, or of numbers."""
    mask = bits - 1
    return (fp ^ (fp // (1 << 31))) & mask if isinstance(fp, np.ndarray) else fp.bitwiseXOR(F.shiftright(fp, 31)).bitwiseAND(F.lit(mask))


def bitmap(groups: DataFrame) -> bytes:
    """The groups' fingerprints as a bitmap of at most ``BITMAP_BITS`` bits, about eight a group while it has room; built by the executors."""
    n = groups.count()
    bits = min(BITMAP_BITS, max(1 << 16, 1 << (8 * n).bit_length()))
    slots = groups.select((_slot(F.col("fp"), bits) + 1).alias("s")).select(F.bitmap_bucket_number("s").alias("bucket"), F.bitmap_bit_position("s").alias("bit"))
    out = bytearray(bits // 8)
    for r in slots.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("raw")).collect():  # bits / 32768 rows of 4 KiB
        at = (r.bucket - 1) * 4096
        out[at : at + 4096] = r.raw[: len(out) - at]
    return bytes(out)


def _members(docs: DataFrame, marks: bytes) -> DataFrame:
    """fp, n_bytes, doc_id, raw (normalised) of the texts whose fingerprint is marked; a text over ``HUGE`` isn't treated here."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part in slices(batch):
                raw = [(t or "").encode().lower() for t in part.column(1).to_pylist()]
                fp = np.array([_packed(fingerprint(r)) for r in raw], dtype=np.int64)
                at = _slot(fp, 8 * len(bits))
                keep = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                yield pa.record_batch([part.column(0).take(pa.array(keep)), pa.array(fp[keep]), pa.array([len(raw[k]) for k in keep], pa.int64()), pa.array([raw[k] for k in keep], pa.binary())], names=["doc_id", "fp", "n_bytes", "raw"])

    return docs.mapInArrow(run, "doc_id long, fp long, n_bytes long, raw binary")


def _chunked(df: DataFrame) -> DataFrame:
    last = F.floor(F.greatest(F.length("raw") - 1, F.lit(0)) / CHUNK)
    return df.select("fp", "n_bytes", F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda k: F.substring("raw", (k * CHUNK + 1).cast("int"), F.lit(CHUNK)))).alias("k", "chunk"))


def unlike_groups(docs: DataFrame, found: DataFrame, groups: DataFrame, huge: int = HUGE) -> DataFrame:
    """fp, n_bytes of the groups whose texts are not all equal, by comparing all chunks of all their texts."""
    big = F.coalesce(F.length("text"), F.lit(0)) > huge
    plain = _chunked(_members(docs.where(~big), bitmap(groups)))
    # the chunks of a huge text find their group by the text's digest, which the JVM computes
    large = docs.where(big).select(F.sha2(F.translate("text", UPPER, LOWER).cast("binary"), 256).alias("text_sha256"), "text")
    named = found.select("text_sha256", "fp", "n_bytes").where(F.col("n_bytes") > huge).distinct().join(groups.select("fp", "n_bytes"), ["fp", "n_bytes"])
    large = _pieces(large.join(named, "text_sha256").select("fp", "n_bytes", "text"), "fp long, n_bytes long, sha string, k int, chunk binary").drop("sha")
    # huge texts and others of one group don't meet place by place: they differ in kind, and count as unlike
    both = plain.withColumn("huge", F.lit(False)).unionByName(large.withColumn("huge", F.lit(True)))
    same = both.groupBy("fp", "n_bytes", "huge", "k").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    kinds = same.groupBy("fp", "n_bytes").agg(F.max(F.col("least") != F.col("most")).alias("differ"), F.count_distinct("huge").alias("kinds")).where(F.col("differ") | (F.col("kinds") > 1))
    return kinds.select("fp", "n_bytes").join(groups.select("fp", "n_bytes"), ["fp", "n_bytes"], "left_semi")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    docs = id_and_text(docs, id_col, text_col)
    found = saved(fingerprints(docs))
    order = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    sized = lambda *by: found.groupBy(*by).agg(F.max(order).alias("top"), F.count("*").alias("n")).where("n > 1")
    groups = saved(sized("fp", "n_bytes"))
    unlike = saved(unlike_groups(docs, found, groups))
    key = ["fp", "n_bytes"]
    if not unlike.isEmpty():
        # texts of equal fingerprints that differ are told apart by their whole digest, and grouped anew
        apart = unlike.withColumn("apart", F.lit(True))
        found = saved(found.join(apart, key, "left").withColumn("part", F.when(F.col("apart"), F.col("text_sha256")).otherwise("")).drop("apart"))
        key = [*key, "part"]
        groups = sized(*key)
    out = found.join(groups.withColumnRenamed("top", "keep").withColumnRenamed("n", "size"), key, "left")
    own = F.col("doc_id")
    keep = F.when(F.col("keep") == NO_ID, F.lit(None)).otherwise(F.col("keep"))
    keep = F.when(F.col("size").isNull(), own).otherwise(keep).cast("long")
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), own.eqNullSafe(keep).alias("kept"), "text_sha256")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))

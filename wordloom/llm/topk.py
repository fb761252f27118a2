"""Exact top-k search by term-at-a-time accumulation.

A vector's components, as integers floor(scale * x), are weighted terms.  Candidates are grouped into
blocks, and a block keeps a posting list for each term (the rows with a weight for it other than zero).  Queries are sparse
rows of terms, taken in blocks too; every query block visits every candidate block.  There, each term of
the block's queries scatters query weight times posting weight into a dense array of scores, a partial
selection finds each query's best k, and the selections of all candidate blocks are merged for each query block.

All scores are exact integers (64 bits; 32 where the weights' bounds allow; without a bound where 64 bits might not do).
A weight of 2**62 or more, or a score among the best that 64 bits can't hold, is an error.  Ties go to the smaller
id.  Rows whose vector is null, or has a null or non-finite component, take no part, neither do rows
without an id; of rows that share an id each is a candidate, but never for a query with that id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import blocks_for, read_table

SCALE, K, EVERY = 64, 20, 20
LIMIT = 1 << 62
QUERY_ROWS, SPAN, BLOCKS, TABLE_BYTES = 32, 2048, 12, 4 << 20
SCHEMA = "query_id long, rank int, vec_id long, score long"


def vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v (array of double) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.where(F.col(id_col).isNotNull() & v.isNotNull() & fine).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def weights(column: pa.Array, scale: int) -> np.ndarray:
    """Rows of integer weights; shorter vectors end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(size), int(size.max(initial=0))), dtype=np.int64)
    flat = np.floor(scale * np.asarray(column.flatten(), dtype=float))
    if np.abs(flat).max(initial=0) >= LIMIT:
        raise OverflowError("a component is too large for a 64-bit weight")
    flat = flat.astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


class Postings:
    """The posting lists of a block of candidates.

    A list that holds over half of the rows is kept as a row of weights, zeros included, which scatter as one span.
    """

    def __init__(self, ids: np.ndarray, w: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, w = ids[order], w[order].astype(np.int64)
        self.bound = int(np.abs(w).max(initial=0)) * max(1, w.shape[1])
        self.kind = np.int32 if self.bound < 1 << 31 else np.int64
        self.lists = []
        for column in np.ascontiguousarray(w.T).astype(self.kind):
            at = np.flatnonzero(column)
            self.lists.append((None, column) if 2 * len(at) > len(column) else (at, column[at]))

    def scores(self, q: np.ndarray) -> np.ndarray:
        """Dense scores of query rows q against all candidates, filled in spans that stay in a core's cache."""
        n = len(self.ids)
        most = self.bound * int(np.abs(q).max(initial=0))
        kind = self.kind if most < 1 << 31 else np.int64 if most < 1 << 63 else object
        acc = np.zeros((len(q), n), dtype=kind)
        terms = []
        for t in range(min(q.shape[1], len(self.lists))):
            rows, (at, pw) = np.flatnonzero(q[:, t]), self.lists[t]
            if len(rows) and len(pw):
                rows = None if 2 * len(rows) > len(q) else rows
                terms.append((rows, (q[:, t] if rows is None else q[rows, t]).astype(kind)[:, None], at, pw.astype(kind, copy=False)))
        for a in range(0, n, SPAN):
            b = min(n, a + SPAN)
            span, part = np.zeros((len(q), b - a), dtype=kind), np.empty((len(q), b - a), dtype=kind)
            for rows, qw, at, pw in terms:
                if at is None:
                    if rows is None:
                        np.multiply(qw, pw[a:b], out=part)
                        span += part
                    else:
                        span[rows] += qw * pw[a:b]
                    continue
                i, j = np.searchsorted(at, (a, b))
                if i < j:
                    where = np.arange(len(q)) if rows is None else rows
                    span[where[:, None], at[i:j] - a] += qw * pw[i:j]
            acc[:, a:b] = span
        return acc

    def best(self, query_ids: np.ndarray, q: np.ndarray, k: int):
        """(query row, vec_id, score) of each query's best k here."""
        acc = self.scores(q)
        own = np.searchsorted(self.ids, query_ids, "left"), np.searchsorted(self.ids, query_ids, "right")
        rows, ids, scores = [], [], []
        for i, (lo, hi) in enumerate(zip(own[0].tolist(), own[1].tolist())):
            s, names = acc[i], self.ids
            if lo < hi:
                s, names = np.concatenate((s[:lo], s[hi:])), np.concatenate((names[:lo], names[hi:]))
            at = np.arange(len(s))
            if len(s) > k:
                least = np.partition(s, len(s) - k)[len(s) - k]
                over, tied = np.flatnonzero(s > least), np.flatnonzero(s == least)
                at = np.concatenate((over, tied[: k - len(over)]))  # ids rise, so the first ties are the smallest
            rows.append(np.full(len(at), i))
            ids.append(names[at])
            scores.append(s[at].astype(np.int64))
        return np.concatenate(rows), np.concatenate(ids), np.concatenate(scores)


def _packed(w: np.ndarray) -> bytes:
    """Weights as the narrowest integers that hold them; the reader tells the width from the size."""
    top = int(np.abs(w).max(initial=0))
    return w.astype("<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8").tobytes()


def _unpacked(raw: bytes, rows: int, width: int) -> np.ndarray:
    each = len(raw) // max(1, rows * width) or 8
    return np.frombuffer(raw, f"<i{each}").reshape(rows, width)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", blocks: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the best k candidates of every query."""
    found, k_best = vectors(candidates, id_col, vector_col), k
    blocks = blocks or max(BLOCKS, blocks_for(candidates.select(vector_col), TABLE_BYTES, vector_col))
    asked = vectors(queries, id_col, vector_col)

    def pack(key, table):
        w = weights(table.column("v"), scale)
        ids = np.asarray(table.column("vec_id"), dtype="<i8")
        order = np.argsort(ids, kind="stable")
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([w.shape[1]], pa.int32()), pa.array([ids[order].tobytes()], pa.binary()), pa.array([_packed(w[order])], pa.binary())], names=["b", "width", "ids", "w"])

    packed = "b int, width int, ids binary, w binary"
    query_blocks = max(1, blocks_for(queries.select(vector_col), TABLE_BYTES, vector_col) // 2)
    c = found.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).groupBy("b").applyInArrow(pack, packed)
    q = asked.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")).groupBy("b").applyInArrow(pack, packed)
    # a block's candidates come to its task once, in front of all query blocks; nothing else holds more than a row of each
    width = T.StructType.fromDDL("b int, kind int, qb int, width int, ids binary, w binary")
    c = c.select("b", F.lit(0).alias("kind"), F.lit(-1).alias("qb"), "width", "ids", "w")
    q = q.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.lit(1).alias("kind"), F.col("b").alias("qb"), "width", "ids", "w")
    met = c.unionByName(q).repartition(blocks, "b").sortWithinPartitions("b", "kind", "qb").to(width)

    def search(batches):
        block, postings = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = np.frombuffer(row["ids"], "<i8")
                if not row["kind"]:
                    block, postings = row["b"], Postings(ids, _unpacked(row["w"], len(ids), row["width"]))
                    continue
                if row["b"] != block:
                    continue  # no candidate in this block
                w = _unpacked(row["w"], len(ids), row["width"]).astype(np.int64)
                for i in range(0, len(ids), QUERY_ROWS):
                    part = ids[i : i + QUERY_ROWS]
                    r, v, s = postings.best(part, w[i : i + QUERY_ROWS], k_best)
                    yield pa.record_batch([pa.array([row["qb"] << 20 | i // QUERY_ROWS], pa.int64()), pa.array([part[r].tobytes()], pa.binary()), pa.array([(np.arange(len(ids))[i : i + QUERY_ROWS][r]).astype("<i8").tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary()), pa.array([s.astype("<i8").tobytes()], pa.binary())], names=["part", "q", "row", "v", "s"])

    def merge(key, table):
        q, row, v, s = (np.concatenate([np.frombuffer(x.as_py(), "<i8") for x in table.column(c)]) for c in ("q", "row", "v", "s"))
        order = np.lexsort((v, -s, row))
        q, row, v, s = q[order], row[order], v[order], s[order]
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, int)
        rank = np.arange(len(row)) - np.repeat(first, np.diff(first, append=len(row))) + 1
        keep = rank <= k
        return pa.table([pa.array(q[keep]), pa.array(rank[keep].astype(np.int32)), pa.array(v[keep]), pa.array(s[keep])], names=["query_id", "rank", "vec_id", "score"])

    return met.mapInArrow(search, "part long, q binary, row binary, v binary, s binary").groupBy("part").applyInArrow(merge, SCHEMA)


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    return top_k(table.where(F.col("vec_id") % EVERY == 0), table)

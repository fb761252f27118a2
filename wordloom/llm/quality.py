"""A supervised quality classifier on subword embeddings.

Every word and every character n-gram (3 to 5, with word edges marked) hashes to one of ``BUCKETS``
learned vectors; so does the word pair whose second word repeats the first.  A document is the mean of
the vectors of all its features (with ``CALM`` features of vector zero, so that a few words don't decide
much), and a softmax over two outputs gives the probability of label 1.  The sample has as many rows
of either class as it can; the bias is then set back to the classes' true shares.  Vectors and outputs are trained together by stochastic
gradient descent in numpy, on a sample of at most ``per_class`` labelled rows of each class, drawn by
a hash of the id from the rows that may be learned from.  Whole texts are used for both.

Since the mean is linear, a trained model gives each feature one number (its vector times the
difference of the output rows), so a word's share of the score is a constant that workers memoise.

Null and empty texts have no features and get the prior (the bias alone).  With no label of one of
the two classes to learn from, every score is the share of label 1 among those known (0.5 if none).
Labels given more than once count with their largest value; null labels are not used.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import Memo, id_and_text, read_table, release, remainder, slices

BUCKETS, WIDTH, SHORT, LONG = 1 << 17, 8, 3, 5
AGAIN, CALM = 0, 60
PIECE, KEPT = 4096, 256
THRESHOLD = 0.7


def _pieces(word: str) -> Iterator[list[int]]:
    """features(), by pieces of a long word."""
    marked = f"<{word}>".encode()
    out = [zlib.crc32(marked[1:-1]) & (BUCKETS - 1)]
    for at in range(0, len(marked), PIECE):
        part = marked[at : at + PIECE + LONG - 1]
        for n in range(SHORT, LONG + 1):
            out += [zlib.crc32(part[i : i + n], n) & (BUCKETS - 1) for i in range(min(PIECE, len(part) - n + 1))]
        yield out
        out = []


def features(word: str) -> list[int]:
    """The buckets of a word and of its character n-grams."""
    return [b for piece in _pieces(word) for b in piece]


class _Words(Memo):
    """A memo that keeps nothing of long words."""

    def __init__(self, compute, long, size=1 << 19):
        super().__init__(compute, size)
        self.long = long

    def __missing__(self, word):
        return super().__missing__(word) if len(word) <= KEPT else self.long(word)


def _bags(batches):
    """doc_id, label, and the distinct features of the text with their counts."""
    memo = _Words(features, lambda w: chain.from_iterable(_pieces(w)), 1 << 16)
    for batch in batches:
        for part in slices(batch):
            ids, counts = [], []
            for t in part.column(1).to_pylist():
                words = (t or "").split()
                f = np.fromiter((b for w in words for b in memo[w]), dtype=np.int32)
                f = np.concatenate((f, np.full(sum(map(eq, words, words[1:])), AGAIN, dtype=np.int32)))
                u, c = np.unique(f, return_counts=True)
                ids.append(u.astype("<i4").tobytes())
                counts.append(c.astype("<i4").tobytes())
            yield pa.record_batch([part.column(0), part.column(2), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "label", "ids", "counts"])


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 4, rate: float = 2.0, seed: int = 7) -> tuple[np.ndarray, float]:
    """One weight a bucket, and the bias, of a model for (label, ids, counts) rows."""
    labels = [b[0] for b in bags]
    if len(set(labels)) < 2:
        share = sum(labels) / len(labels) if labels else 0.5
        return np.zeros(BUCKETS), math.log(max(share, 1e-4) / max(1 - share, 1e-4))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    outputs, bias = rng.normal(0, 1, (2, WIDTH)), np.zeros(2)
    steps, total = 0, epochs * len(bags)
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            label, ids, counts = bags[k]
            lr = rate * (1 - steps / total)
            steps += 1
            share = counts / (CALM + counts.sum())
            h = share @ vectors[ids]
            z = outputs @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ outputs
            outputs -= lr * 0.2 * np.outer(p, h)
            bias -= lr * 0.05 * p
            vectors[ids] -= lr * 4 * share[:, None] * back
    return vectors @ (outputs[1] - outputs[0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1200) -> tuple[np.ndarray, float]:
    """A model for docs (doc_id, text) from labels (doc_id, label); only a bounded sample reaches the driver."""
    known = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    drawn = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    shares = {r.label: r.n for r in known.where(F.col("label").isin(0, 1)).groupBy("label").agg(F.count("*").alias("n")).collect()}
    ids = [(r.doc_id, int(r.label)) for part in drawn for r in part.collect()]
    if not ids:
        return train([])
    sample = docs.sparkSession.createDataFrame(ids, "doc_id long, label int")
    rows = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label").mapInArrow(_bags, "doc_id long, label int, ids binary, counts binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.ids)))
    bags = [(r.label, np.frombuffer(r.ids, "<i4"), np.frombuffer(r.counts, "<i4").astype(float)) for r in rows]
    weights, bias = train(bags)
    ones = sum(b[0] for b in bags)
    if 0 < ones < len(bags):
        bias += math.log(shares[1] / shares[0]) - math.log(ones / (len(bags) - ones))
    return weights, bias


def quality_scores(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc_id, the columns named by ``carry``, and score (0 to 1, higher: label 1 likelier) of every row."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("scored_text"), *(carry or []))
    schema = T.StructType([f for f in base.schema.fields if f.name != "scored_text"] + [T.StructField("score", T.DoubleType())])
    shared = spark.sparkContext.broadcast((model[0].astype(np.float32), model[1]))  # BUCKETS numbers, whatever the corpus

    def run(batches):
        weights, bias = shared.value
        weights = weights.astype(float).tolist()

        def word(w):
            return sum((complex(sum(map(weights.__getitem__, f)), len(f)) for f in _pieces(w)), 0j)

        memo, again = _Words(word, word, 1 << 18), complex(weights[AGAIN], 1)

        def text(t):
            words = (t or "").split()
            return sum(map(memo.__getitem__, words), sum(map(eq, words, words[1:])) * again)

        for batch in batches:
            for part in slices(batch, "scored_text"):
                sums = np.array([text(t) for t in part.column(1).to_pylist()], dtype=complex)
                z = sums.real / (sums.imag + CALM) + bias
                cols = {f: part.column(k) for k, f in enumerate(part.schema.names) if f != "scored_text"}
                yield pa.record_batch([*cols.values(), pa.array(1 / (1 + np.exp(-np.clip(z, -60, 60))))], names=[*cols, "score"])
        memo.clear()
        release()

    return base.mapInArrow(run, schema)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    return labels.where(remainder(F.col("doc_id"), 4) != 2)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_and_text(read_table(spark, sf_dir, "documents"))
    scored = quality_scores(docs, fit(docs, labelled(spark, sf_dir)))
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Counts within blocks of rows, before anything moves.

A block's words become numbers in the order of its sorted words; equal keys are found by sorting numbers.  A task sends a row for each key of a block, with what it
counted, and in the order of the keys, so that neighbours begin alike and compress.  A source must have one row: then its occurrences are all in one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.keys import PATH_MARK
from wordloom.operators.frequent import hashed, hits

BLOCK, SENT = 1 << 21, 1 << 16


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    """The rows of batches (first column: lists of words) by about BLOCK words."""
    held, count = [], 0
    for batch in batches:
        ends = np.cumsum(batch.column(0).value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            base = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK - count, side="right")))
            held.append(batch.slice(start, stop - start))
            count, start = count + int(ends[stop - 1]) - base, stop
            if count >= BLOCK or start < len(ends):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _numbered(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a column of lists, in order; each place's number among them, and its row."""
    coded = column.flatten().dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy().astype(np.int64)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return coded.dictionary.take(pa.array(order)), number[coded.indices.to_numpy()], np.repeat(np.arange(len(sizes)), sizes)


def _counted(key: np.ndarray, row: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each distinct key, in order: its first place, occurrences, and named rows that have it; then the rows by key, and where each key's begin."""
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    new = np.append(True, key[1:] != key[:-1])
    starts = np.flatnonzero(new)
    first = (new | np.append(True, row[1:] != row[:-1])) & named[row]
    return order[starts], np.diff(np.append(starts, len(key))), np.add.reduceat(first.astype(np.int64), starts), row, starts


def _flags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


def gram_counts(docs: DataFrame, source: str, bit: Column, sizes: tuple[int, ...], words: str = "words", marked: dict[int, np.ndarray] | None = None) -> DataFrame:
    """gram (words joined by |), n, s (named sources), bits (or of the rows' ``bit``) of each block's grams; of ``marked`` ones only, as from frequent.marks()."""
    shared = docs.sparkSession.sparkContext.broadcast(marked) if marked is not None else None

    def count(batches):
        for block in _blocks(batches):
            text, at, row = _numbered(block.column(0))
            named, bits = _flags(block.column(1)), block.column(2).to_numpy(zero_copy_only=False)
            for size in sizes:
                inside = row[: max(0, len(row) - size + 1)] == row[size - 1 :]
                if shared is not None:
                    inside &= hits(block.column(3), size, shared.value[size])
                places = np.flatnonzero(inside)
                if not len(places):
                    continue
                key, span = at[places], len(text)
                for k in range(1, size):
                    if span * len(text) >= 1 << 62:
                        key = np.unique(key, return_inverse=True)[1]
                        span = int(key.max()) + 1
                    key, span = key * len(text) + at[places + k], span * len(text)
                first, n, s, rows, starts = _counted(key, row[places], named)
                begun = places[first]
                grams = pc.binary_join_element_wise(*(text.take(pa.array(at[begun + k])) for k in range(size)), PATH_MARK)
                out = pa.table([grams, pa.array(n.astype(np.int64)), pa.array(s), pa.array(np.bitwise_or.reduceat(bits[rows], starts))], names=["gram", "n", "s", "bits"])
                yield from out.to_batches(max_chunksize=SENT)

    columns = [F.col(words), F.col(source).isNotNull().alias("named"), bit.alias("bit")] + [hashed(words).alias("h")] * (marked is not None)
    return docs.select(*columns).mapInArrow(count, "gram string, n long, s long, bits long")


def context_counts(docs: DataFrame, source: str, most: int, words: str = "words") -> DataFrame:
    """context (the last 0 to ``most`` units of the word before, as far as it has them), text, n, s of each block's words."""

    def count(batches):
        for block in _blocks(batches):
            text, at, row = _numbered(block.column(0))
            named, length = _flags(block.column(1)), pc.utf8_length(text).to_numpy()
            for width in range(most + 1):
                places = np.arange(len(at)) if width == 0 else np.flatnonzero((row[1:] == row[:-1]) & (length[at[:-1]] >= width)) + 1
                if not len(places):
                    continue
                ends = pc.utf8_slice_codeunits(text, start=-width) if width else pa.array([""] * len(text), pa.string())
                ends, end, _ = _numbered(pa.ListArray.from_arrays(pa.array([0, len(text)], pa.int32()), ends))
                before = end[at[places - 1]] if width else np.zeros(len(places), np.int64)
                first, n, s, _, _ = _counted(before * len(text) + at[places], row[places], named)
                out = [ends.take(pa.array(before[first])), text.take(pa.array(at[places[first]])), pa.array(n.astype(np.int64)), pa.array(s)]
                yield from pa.table(out, names=["context", "text", "n", "s"]).to_batches(max_chunksize=SENT)

    return docs.select(F.col(words), F.col(source).isNotNull().alias("named")).mapInArrow(count, "context string, text string, n long, s long")

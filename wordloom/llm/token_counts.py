"""Token counts of whole texts under a subword vocabulary, by heap-and-linked-list pair merging.

The count of a text is its number of initial symbols, less the merges made, with characters outside
the vocabulary counted as their UTF-8 bytes.  No identifiers are made.  Because no piece of the
vocabulary holds a space mark after another character (checked when the vocabulary is loaded), a
text falls apart before each run of space marks; chunk counts are memoised, so a frequent word is
merged once for each worker.

Null and empty texts count no tokens.  Ids may repeat or be null; each row gives a row.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import Memo, id_and_text, read_table, slices
from wordloom.llm.merging import merged

SPACE = "▁"
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


class PieceCounter:
    """Counts pieces as a byte-fallback BPE model of the sentencepiece format does."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        ids = [i for i in range(model.get_piece_size()) if not any(f(i) for f in special)]
        place = {s: k for k, s in enumerate(sorted({model.get_score(i) for i in ids}, reverse=True))}
        rank = {model.id_to_piece(i): place[model.get_score(i)] for i in ids}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in rank):
            raise ValueError("a piece of this vocabulary crosses the start of a word")
        known = lambda s: len(s) == 1 or s in rank
        self.pairs = {(p[:i], p[i:]): r for p, r in rank.items() for i in range(1, len(p)) if known(p[:i]) and known(p[i:])}
        self.pieces = frozenset(rank)
        self.lines_apart = not any("\n" in p for p in rank)
        self.memo = Memo(self._chunk, 1 << 20)

    def merged_count(self, text: str) -> int:
        pieces = self.pieces
        return sum([1 if s in pieces else len(s.encode()) for s in merged(text, self.pairs.get)])

    def _chunk(self, key: str) -> int:
        """A key that starts with a line end stands for itself, any other has a space mark before it."""
        return self.merged_count(key if key[:1] == "\n" else SPACE + key)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.lines_apart and SPACE not in text:
            marked = text.replace("\n", " \n")
            if "  " not in marked and marked[0] != " " and marked[-1] != " ":
                return sum(map(self.memo.__getitem__, marked.split(" ")))
        text = SPACE + text.replace(" ", SPACE)
        return sum(map(self.merged_count, re.findall(f"{SPACE}+[^{SPACE}]*", text)))


@lru_cache(maxsize=4)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens of every row of docs."""

    def run(batches):
        c = counter(model_path)
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part.column(1).to_pylist()]
                size = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
                n = np.fromiter(map(c.count, texts), dtype=np.int64, count=len(texts))
                yield pa.record_batch([part.column(0), size, pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    counts = token_counts(read_table(spark, sf_dir, "documents"), path)
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)

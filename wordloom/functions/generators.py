"""Row generators as table functions, for SQL with LATERAL: stretches, fragments, near-best segmentations.

Each is plain Python over one value and so the slower form of an operator of this library that stays in the JVM or in Arrow batches; they serve
queries written in SQL.  ``register`` makes them known to a session.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from wordloom.operators.segmentation import Lexicon


class Stretches:
    """stretches(text, letters): at (code points from 0), stretch of the maximal runs of the letters."""

    def eval(self, text: str, letters: str) -> Iterator[tuple[int, str]]:
        if text and letters:
            for m in re.finditer(f"[{re.escape(letters)}]+", text):
                yield m.start(), m.group()


class Fragments:
    """fragments(run, least, most, overlap): part, fragment of a run of units, in pieces of at most ``most`` that overlap; runs under ``least`` have none."""

    def eval(self, run: str, least: int, most: int, overlap: int) -> Iterator[tuple[int, str]]:
        if run is None or len(run) < least:
            return
        step = max(1, most - overlap)
        last = 0 if len(run) <= most else len(run) - least
        for k, at in enumerate(range(0, last + 1, step)):
            yield k, run[at : at + most]


def segmentations(words: dict[str, int]):
    """A table function segmentations(stretch, k, margin): rank, score, pieces, by a lexicon that travels with it."""

    class Segmentations:
        def __init__(self):
            self.lexicon = Lexicon(words)

        def eval(self, stretch: str, k: int, margin: float) -> Iterator[tuple[int, float, list[str]]]:
            if stretch:
                for i, (score, pieces) in enumerate(self.lexicon.nearest(stretch, k, margin), 1):
                    yield i, score, pieces

    return udtf(Segmentations, returnType="rank int, score double, pieces array<string>")


def register(spark: SparkSession, words: dict[str, int] | None = None) -> None:
    """stretches and fragments, and with words (at most a few million) segmentations."""
    spark.udtf.register("stretches", udtf(Stretches, returnType="at int, stretch string"))
    spark.udtf.register("fragments", udtf(Fragments, returnType="part int, fragment string"))
    if words is not None:
        spark.udtf.register("segmentations", segmentations(words))

"""Syllables of readings written without marks."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_WAYS = 1 << 62


def parse(reading: str, table: frozenset[str]) -> list[str] | None:
    """The syllables of a reading: fewest, and of those the longest first ones; marks are kept as edges.  None if it can't be read."""
    out: list[str] = []
    for part in reading.split("'"):
        found = _parse(part, table)
        if not found:
            return None
        out += found
    return out


@lru_cache(maxsize=1 << 16)
def _parse(part: str, table: frozenset[str]) -> tuple[str, ...] | None:
    longest = max(map(len, table), default=0)
    best: list[tuple[str, ...] | None] = [None] * len(part) + [()]
    for at in range(len(part) - 1, -1, -1):
        for end in range(min(len(part), at + longest), at, -1):  # longest first: it stays among equals
            rest = best[end]
            if rest is not None and part[at:end] in table and (best[at] is None or len(rest) + 1 < len(best[at])):
                best[at] = (part[at:end], *rest)
    return best[0] or None


@lru_cache(maxsize=1 << 16)
def ways(reading: str, table: frozenset[str]) -> tuple[int, int]:
    """In how many ways a reading can be read as syllables, and in how many of the fewest; marks are edges; at most ``MOST_WAYS`` are counted."""
    longest, every, fewest = max(map(len, table), default=0), 1, 1
    for part in reading.split("'"):
        n = len(part)
        lattice = [(0, 0, 0)] * n + [(1, 0, 1)]  # of the rest from each place: ways, fewest syllables, ways of the fewest
        for at in range(n - 1, -1, -1):
            after = [lattice[end] for end in range(at + 1, min(n, at + longest) + 1) if part[at:end] in table and lattice[end][0]]
            if after:
                least = min(x[1] for x in after)
                lattice[at] = min(MOST_WAYS, sum(x[0] for x in after)), least + 1, min(MOST_WAYS, sum(x[2] for x in after if x[1] == least))
        every, fewest = (min(MOST_WAYS, every * lattice[0][0]), min(MOST_WAYS, fewest * lattice[0][2])) if n else (0, 0)
    return every, fewest


def parsed(reading: Column, table: list[str]) -> Column:
    """struct(syllables, ways, fewest): the reading as parse() reads it (null if it can't be), and how ambiguous that is.

    A reading with over one way has another boundary somewhere; one with over one of the fewest is undecided by length too.
    The table goes with the function; tables of syllables are a few thousand entries.
    """
    known = frozenset(table)

    @F.pandas_udf("struct<syllables: array<string>, ways: bigint, fewest: bigint>")
    def read(column: pd.Series) -> pd.DataFrame:
        # equal readings of a batch are read once
        values = {r: (parse(r, known), *ways(r, known)) for r in column.dropna().unique()}
        rows = [values.get(r, (None, None, None)) for r in column]
        counts = {c: pd.array([x[k] for x in rows], dtype="Int64") for k, c in ((1, "ways"), (2, "fewest"))}
        return pd.DataFrame({"syllables": [x[0] for x in rows], **counts})

    return read(reading)

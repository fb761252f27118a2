"""Byte-pair merging with a heap of adjacent pairs and a doubly linked list of symbols."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from heapq import heapify, heappop, heappush


def merged(symbols: Sequence[str], rank: Callable[[tuple[str, str]], int | None]) -> list[str]:
    """The symbols left when the adjacent pair of lowest rank, leftmost first, is merged until none has a rank.

    ``rank`` gives the integer rank of a pair of symbols, or None.  A heap entry holds rank and position
    in one integer; it is stale when the pair at that position has another rank by now.
    """
    text: list = list(symbols)
    n = len(text)
    if n < 2:
        return text
    ranks = list(map(rank, zip(text, text[1:])))
    shift = n.bit_length()
    heap = [(r << shift) + i for i, r in enumerate(ranks) if r is not None]
    if not heap:
        return text
    heapify(heap)
    ranks.append(None)
    after, before, low = list(range(1, n + 1)), list(range(-1, n - 1)), (1 << shift) - 1
    while heap:
        top = heappop(heap)
        i = top & low
        if ranks[i] != top >> shift:
            continue
        j = after[i]
        whole = text[i] = text[i] + text[j]
        text[j] = ranks[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = ranks[i] = rank((whole, text[k]))
            if r is not None:
                heappush(heap, (r << shift) + i)
        else:
            ranks[i] = None
        h = before[i]
        if h >= 0:
            r = ranks[h] = rank((text[h], whole))
            if r is not None:
                heappush(heap, (r << shift) + h)
    return [s for s in text if s is not None]

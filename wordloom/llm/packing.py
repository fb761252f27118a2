"""Order-preserving packing of token sequences into windows, by dynamic programming.

The texts of a partition, tokenised and each closed by an end id, form one stream in table order.
Windows of at most ``window`` tokens cover it.  A window may end at a document's end (free), at the
end of a sentence or line (``SENTENCE``), or, in stretches without those, every ``STRIDE`` tokens
(``BROKEN``).  The cheapest cuts minimise padding plus those penalties:

    cost(k) = penalty(k) + window + min(cost(j) for j < k if position(k) - position(j) <= window)

where a window counts in full, since its tokens are the same for every choice of cuts.  The minimum over
the sliding range is kept by a queue of rising costs, so the transitions take constant time each.  The end of a partition's stream may
be one padded window or sequences whose lengths are powers of two, which need no padding; the program chooses the
last window's start together with the cheaper of the two.

A stream is cut as it grows, and yet as a whole: a cut is final once all cuts that a later window could start from descend from it,
so the cuts don't depend on how the texts come in batches.  What isn't final stays in memory, as a rule a few windows.
Sequence ids are unique over partitions.  Null and empty texts are one end id; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from wordloom.llm.bpe_codec import byte_characters
from wordloom.llm.common import Memo, id_and_text, read_table, slices

WINDOW, END_ID = 2048, 1
SENTENCE, BROKEN, STRIDE = 2, 12, 16
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ODD = re.compile(r"[^\S \n]|  | \n|\n\n|<\|")
_WIDE = re.compile("[^\x00-ɏ]")


class ByteTokenizer:
    """Identifiers of whole texts as the tokenizer file's library gives them, with words memoised.

    A text whose only white space is single spaces and single line ends falls apart before each of
    them; any other text, and any with a special string, goes to the library whole.
    """

    def __init__(self, path: str):
        import tiktoken
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        names = self.library.get_vocab(with_added_tokens=False)
        merged = [names[a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in json.loads(self.library.to_str())["model"]["merges"])]
        if merged != sorted(merged):
            raise ValueError("the order of the merges isn't that of their ids")
        self.ends = np.zeros(self.library.get_vocab_size() + 1, dtype=bool)
        for s, i in names.items():
            self.ends[i] = s[-1] in ".!?" or "Ċ" in s
        # single words of Latin letters: the same merges by a smaller library, over the same vocabulary as ranks
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes([byte_of[c] for c in s]): i for s, i in names.items() if all(c in byte_of for c in s)}
        self.fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.memo = Memo(self._key)

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _key(self, key: str) -> bytes:
        return array("I", self.fast.encode_ordinary(key if key[:1] == "\n" else " " + key)).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if _ODD.search(text) or _WIDE.search(text):
            return self.whole(text)
        head, *rest = text.replace("\n", " \n").split(" ")
        return (self.whole(head) if head else b"") + b"".join(map(self.memo.__getitem__, rest))


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


class Cutter:
    """The cheapest cuts of a stream that grows at its end; positions count from the stream's start."""

    def __init__(self, window: int):
        self.window, self.base = window, 0  # base: the index of the first cut that is kept
        self.position, self.cost, self.back, self.penalty = [0], [0], [0], [0]
        self.queue: deque = deque([(0, 0, 0)])  # cost, position, index, by rising cost

    def extend(self, position: list[int], penalty: list[int]) -> None:
        """More allowed cuts, in order; no two neighbours are over ``window`` apart."""
        queue, window, k = self.queue, self.window, self.base + len(self.position)
        for p, e in zip(position, penalty):
            while queue[0][1] < p - window:
                queue.popleft()
            c = queue[0][0] + window + e
            self.cost.append(c)
            self.back.append(queue[0][2])
            while queue and queue[-1][0] >= c:
                queue.pop()
            queue.append((c, p, k))
            k += 1
        self.position += position
        self.penalty += penalty

    def _path(self, k: int) -> list[int]:
        """The positions of the cuts that lead to cut k, after the first one kept, its own included."""
        out = []
        while k > self.base:
            out.append(self.position[k - self.base])
            k = self.back[k - self.base]
        return out[::-1]

    def final(self) -> list[int]:
        """The cuts that no later one can change any more; they are forgotten but for the last."""
        least = int(np.searchsorted(self.position, self.position[-1] - self.window))  # windows to come start here or later
        k = self.base + len(self.position) - 1
        live = set(range(self.base + least, k + 1))
        while len(live) > 1:
            if k in live:
                live.remove(k)
                live.add(max(self.base, self.back[k - self.base]))
            k -= 1
        k = live.pop()
        out = self._path(k)
        drop = k - self.base
        for x in (self.position, self.cost, self.back, self.penalty):
            del x[:drop]
        self.base = k
        return out

    def _tail(self, t: int, end: int, penalty: dict[int, int]) -> tuple[int, list[int]]:
        """What the last t tokens cost, and their cuts: one sequence, or powers of two."""
        one = (t if t & (t - 1) == 0 else self.window, [end])
        p, cost, ends = end - t, t, []
        while p < end:
            p += 1 << ((end - p).bit_length() - 1)
            ends.append(p)
            cost += penalty.get(p, BROKEN)
        return min(one, (cost, ends))

    def finish(self) -> list[int]:
        """The rest of the cuts; the stream ends at the last allowed one."""
        end = self.position[-1]
        known = dict(zip(self.position, self.penalty)) | {end: 0}
        best = (self.cost[-1], -len(self.position) + 1, [])
        for i in range(len(self.position) - 2, -1, -1):
            t = end - self.position[i]
            if t > self.window:
                break
            cost, ends = self._tail(t, end, known)
            best = min(best, (self.cost[i] + cost, -i, ends))
        return self._path(self.base - best[1]) + best[2]


class Packer:
    """Takes documents in order and gives pieces (doc, start, length, crc, tokens of the doc, sequence, offset)."""

    def __init__(self, ends: np.ndarray, window: int, first_sequence: int):
        self.ends, self.window, self.sequence = ends, window, first_sequence
        self.docs: list[tuple[int | None, int, int]] = []  # id, its tokens, how many of them are out
        self.ids, self.out, self.cutter = np.zeros(0, dtype="<u4"), 0, Cutter(window)

    def add(self, docs: list[tuple[int | None, bytes]]) -> list[tuple]:
        end = END_ID.to_bytes(4, "little")
        raw = [ids + end for _, ids in docs]
        self.docs += [(i, len(r) // 4, 0) for (i, _), r in zip(docs, raw)]
        new = np.frombuffer(b"".join(raw), dtype="<u4")
        if len(new):
            at, penalty = self._allowed(new, np.cumsum([len(r) // 4 for r in raw]))
            self.cutter.extend((at + self.out + len(self.ids)).tolist(), penalty.tolist())
            self.ids = np.concatenate((self.ids, new))
        return self._emit(self.cutter.final())

    def _allowed(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The allowed cuts of whole documents, which end at ``ends``, and their penalties."""
        pen = np.full(len(ids) + 1, -1, dtype=np.int64)
        pen[1:][self.ends[ids]] = SENTENCE
        pen[ends] = 0
        pen[0] = 0
        at = np.flatnonzero(pen >= 0)
        gap = np.diff(at)
        wide = gap > STRIDE
        for a, g in zip(at[:-1][wide].tolist(), gap[wide].tolist()):
            pen[a + STRIDE : a + g : STRIDE] = BROKEN
        at = np.flatnonzero(pen[1:] >= 0) + 1
        return at, pen[at]

    def finish(self) -> list[tuple]:
        return self._emit(self.cutter.finish())

    def _emit(self, ends: list[int]) -> list[tuple]:
        rows, d, p = [], 0, 0
        docs, ids = self.docs, self.ids
        for e in ends:
            e, offset = e - self.out, 0
            while p < e:
                i, total, out = docs[d]
                k = min(e - p, total - out)
                rows.append((i, out, k, zlib.crc32(ids[p : p + k].tobytes()), total, self.sequence, offset))
                p, offset = p + k, offset + k
                docs[d] = (i, total, out + k)
                d += out + k == total
            self.sequence += 1
        self.docs, self.ids, self.out = docs[d:], ids[p:], self.out + p
        return rows


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def batch(rows):
        return pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(names))], names=names)

    def run(batches):
        t = tokenizer(tokenizer_path)
        packer = Packer(t.ends, window, TaskContext.get().partitionId() << 36)
        for b in batches:
            for part in slices(b):
                texts = part.column(1).to_pylist()
                yield batch(packer.add([(i, t.encode(x or "")) for i, x in zip(part.column(0).to_pylist(), texts)]))
        yield batch(packer.finish())

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ordered=True)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))

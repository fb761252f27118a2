"""Exact subword encoding and decoding of whole texts through a minimal acyclic transducer.

The frequent words of the corpus and their identifiers are compiled into a minimal acyclic automaton:
states with the same right language are shared, and each arc carries an additive output, so that the
outputs along an accepted word sum to the word's row in a table of identifiers.  The automaton is
one flat buffer of integers; each Python worker memory-maps the file in which Spark keeps the
broadcast on its executor, so the workers of an executor share one copy.  The buffer's size is
bounded by ``lexicon_size`` words.  Words that the automaton does not accept are merged exactly, pair
by pair, so the lexicon changes the speed and never the result.

Counting: every text of the corpus is counted; a word enters the count of a block of texts when it
occurs ``BLOCK_COUNT`` times in it, and the block counts are summed.

Null and empty texts encode to no identifiers and decode to the empty text.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import unicodedata
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import Memo, id_and_text, read_table, slices
from wordloom.llm.merging import merged

BLOCK_COUNT = 8
MAGIC = b"ACYCLIC-TRANSDUCER-1 "  # 21 bytes, then 3 of padding
_WIDE = re.compile("[^\\x00-\\u036f]")  # beyond Latin letters, versions of Unicode may differ
_ODD_SPACE = re.compile("[\\x1c-\\x1f]")  # white space to Python alone


# --- the automaton -------------------------------------------------------------------------------


class Transducer:
    """Built from sorted distinct byte words; afterwards ``arcs`` is {state * 256 + byte: (target, output)}."""

    def __init__(self, words: list[bytes]):
        register: dict[tuple, int] = {}
        children: list[dict[int, int]] = [{}]
        final, path = [False], [0]

        def settle(depth: int) -> None:
            """Replace the unshared states below ``depth`` on the current path by equal registered ones."""
            while len(path) > depth + 1:
                state = path.pop()
                key = (final[state], tuple(children[state].items()))
                same = register.setdefault(key, state)
                if same != state:
                    children[path[-1]][previous[len(path) - 1]] = same

        previous = b""
        for word in words:
            shared = 0
            for a, b in zip(word, previous):
                if a != b:
                    break
                shared += 1
            settle(shared)
            for byte in word[shared:]:
                children.append({})
                final.append(False)
                children[path[-1]][byte] = len(children) - 1
                path.append(len(children) - 1)
            final[path[-1]] = True
            previous = word
        settle(0)
        accepted: dict[int, int] = {}
        number: dict[int, int] = {}

        def count(root: int) -> None:
            stack = [root]
            while stack:
                s = stack[-1]
                todo = [t for t in children[s].values() if t not in accepted]
                if todo:
                    stack.extend(todo)
                    continue
                stack.pop()
                accepted[s] = final[s] + sum(accepted[t] for t in children[s].values())
                number.setdefault(s, len(number))

        count(0)
        self.root, self.states = number[0], len(number)
        self.final = {number[s] for s in number if final[s]}
        self.arcs: dict[int, tuple[int, int]] = {}
        for s, k in number.items():
            passed = int(final[s])
            for byte, t in children[s].items():
                self.arcs[k * 256 + byte] = (number[t], passed)
                passed += accepted[t]


def compiled(entries: dict[str, tuple[int, ...]]) -> bytes:
    """The flat form of a lexicon {word: ids}."""
    words = sorted((w.encode(), ids) for w, ids in entries.items() if w)
    t = Transducer([w for w, _ in words])
    size = 1 << max(4, (2 * len(t.arcs)).bit_length())
    key, target, output = (np.full(size, -1, dtype=np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32))
    for k, (to, out) in t.arcs.items():
        slot = (k * 0x9E3779B1 >> 7) & (size - 1)
        while key[slot] >= 0:
            slot = (slot + 1) & (size - 1)
        key[slot], target[slot], output[slot] = k, to, out
    ends = np.zeros(t.states + 8, dtype=np.uint8)
    ends[list(t.final)] = 1
    ends = ends[: len(ends) // 8 * 8]
    ids = np.array([i for _, x in words for i in x], dtype="<u4")
    where = np.cumsum([0, *(len(x) for _, x in words)]).astype("<i4")
    head = np.array([size, t.root, len(ends), len(where), len(ids), len(words)], dtype="<i8")
    return MAGIC.ljust(24, b".") + b"".join(x.tobytes() for x in (head, key, target, output, ends, where, ids))


class Lexicon:
    """Lookups in the flat form, which may be a memory map."""

    def __init__(self, buffer):
        m = memoryview(buffer)
        head = m[24:72].cast("q")
        self.mask, self.root, n_ends, n_where, n_ids, self.words = head[0] - 1, *head[1:6]
        at = 72

        def take(n: int, kind: str, width: int):
            nonlocal at
            part = m[at : at + n * width].cast(kind)
            at += n * width
            return part

        size = head[0]
        self.key, self.target, self.output = take(size, "q", 8), take(size, "i", 4), take(size, "i", 4)
        self.ends, self.where, self.ids = take(n_ends, "B", 1), take(n_where, "i", 4), take(n_ids, "I", 4)

    def find(self, word: str) -> list[int] | None:
        state, row, mask, key = self.root, 0, self.mask, self.key
        if not self.words:
            return None
        for byte in word.encode():
            k = state * 256 + byte
            slot = (k * 0x9E3779B1 >> 7) & mask
            while key[slot] != k:
                if key[slot] < 0:
                    return None
                slot = (slot + 1) & mask
            row += self.output[slot]
            state = self.target[slot]
        return self.ids[self.where[row] : self.where[row + 1]].tolist() if self.ends[state] else None


def mapped(broadcast) -> mmap.mmap:
    """A memory map of the bytes that a broadcast holds."""
    path = getattr(broadcast, "_path", None)
    if path:
        try:
            with open(path, "rb") as f:
                m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            if (at := m.find(MAGIC)) >= 0:
                return memoryview(m)[at:]
        except OSError:
            pass
    value = broadcast.value  # the file is compressed or encrypted: an anonymous map has the same layout
    m = mmap.mmap(-1, len(value))
    m.write(value)
    return m


# --- the tokenizer's rules -----------------------------------------------------------------------


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordCodec:
    """Normalises, splits, merges and names as the tokenizer file says; works on one word at a time."""

    def __init__(self, path: str):
        import tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.library = spec["model"], tokenizers.Tokenizer.from_file(path)
        self.vocabulary = model["vocab"]
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: s for s, i in self.vocabulary.items()} | {i: s for s, i in self.special.items()}
        self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.bytes = byte_characters()
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def words(self, text: str) -> list[str]:
        """The normalised words of a text without special strings."""
        if text.isascii():
            text = text.lower()
        elif _WIDE.search(text):
            return self.library.normalizer.normalize_str(text).split(" ")
        else:
            text = unicodedata.normalize("NFC", text).lower()
        return text.split() if not _ODD_SPACE.search(text) else [w for w in regex.split(r"[\t-\r \x85\xa0\p{Z}]+", text) if w]

    def encode(self, word: str) -> list[int]:
        """The identifiers of a normalised word, merged pair by pair."""
        ids, to, vocabulary = [], self.bytes, self.vocabulary
        if _WIDE.search(word):
            parts = [list(p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(word)]
        else:
            parts = [[to[b] for b in part.encode()] for part in self.cut.findall(word)]
        for symbols in parts:
            symbols[-1] += self.end
            ids += [vocabulary[s] for s in merged(symbols, self.rank.get) if s in vocabulary]
        return ids


@lru_cache(maxsize=4)
def codec(path: str) -> WordCodec:
    return WordCodec(path)


class Encoder:
    def __init__(self, path: str, lexicon: Lexicon):
        self.codec, self.lexicon = codec(path), lexicon
        self.memo = Memo(self._word, 1 << 20)

    def _word(self, word: str) -> tuple[bytes, str]:
        ids = self.lexicon.find(word)
        if ids is None:
            ids = self.codec.encode(word)
        return array("I", ids).tobytes(), " ".join([self.codec.text_of[i] for i in ids])

    def encode(self, text: str) -> tuple[bytes, str]:
        """The identifiers as little-endian 32-bit integers, and the decoded text."""
        c = self.codec
        if "<|" not in text:
            parts = list(map(self.memo.__getitem__, c.words(text)))
        else:
            parts = []
            for piece in c.specials.split(text):
                if piece in c.special:
                    parts.append((c.special[piece].to_bytes(4, "little"), piece))
                else:
                    parts += map(self.memo.__getitem__, c.words(piece))
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts if p[0]])


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder_of(path: str, name: str, broadcast) -> Encoder:
    """The worker's encoder for a lexicon of that name: a worker's tasks share its memo, and it keeps one lexicon's only."""
    if (path, name) not in _encoders:
        _encoders.clear()
        _encoders[path, name] = Encoder(path, Lexicon(mapped(broadcast)))
    return _encoders[path, name]


def frequent_words(docs: DataFrame, path: str, lexicon_size: int) -> list[str]:
    """The ``lexicon_size`` most frequent words of docs (doc_id, text), at the driver: bounded by that parameter."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=16 << 20):
                c = codec(path)
                seen: Counter = Counter()
                for t in part.column(part.schema.get_field_index("text")).to_pylist():
                    seen.update(c.words(t or ""))
                kept = {w: n for w, n in seen.items() if n >= BLOCK_COUNT and len(w) <= 64}
                yield pa.record_batch([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], names=["word", "n"])

    counts = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in counts.orderBy(F.desc("n"), "word").limit(lexicon_size).collect()]


def bpe_encode(docs: DataFrame, tokenizer_path: str, lexicon_size: int = 32768, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """doc_id, ids (little-endian 32-bit), decoded text of every row; with ``digest`` their SHA-256 and the count."""
    docs = id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    c = codec(tokenizer_path)
    lexicon = compiled({w: tuple(c.encode(w)) for w in frequent_words(docs, tokenizer_path, lexicon_size)})
    shared, name = spark.sparkContext.broadcast(lexicon), hashlib.sha256(lexicon).hexdigest()

    def run(batches):
        encoder = encoder_of(tokenizer_path, name, shared)
        for batch in batches:
            for part in slices(batch):
                done = [encoder.encode(t or "") for t in part.column(1).to_pylist()]
                if digest:
                    n = pa.array([len(ids) // 4 for ids, _ in done], pa.int64())
                    sha = [pa.array([hashlib.sha256(x).hexdigest() for x in xs]) for xs in ([d[0] for d in done], [d[1].encode() for d in done])]
                    yield pa.record_batch([part.column(0), n, *sha], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    yield pa.record_batch([part.column(0), pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["doc_id", "ids", "decoded"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids binary, decoded string"
    return docs.mapInArrow(run, schema)


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digest=True)

"""Occurrences of many patterns in texts: by an automaton in every task, by joins of substrings, or by rare anchors.

The anchored form holds for any number of patterns.  A pattern's anchor is the rarest, over all texts, of its stretches of q units (8, or the largest power of
two that fits).  Texts are read twice: once to count the stretches that patterns have, once to send what stands around each anchor to where
its patterns are; there the whole pattern is compared.  What travels to every task is a bitmap of at most ``BITMAP_BITS`` bits,
which only saves work.  A pattern with a stretch that no text has, has no occurrence.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.bounded import read_bounded, settled

GRAM, BITMAP_BITS, HELD = 8, 1 << 27, 1 << 17


def support_joined(texts: DataFrame, patterns: DataFrame, piece: int = 256) -> DataFrame:
    """pattern, n, sources, domains of texts (text, source, domain): all overlapping matches, by equality of substrings.

    Texts fall into pieces that overlap by the longest pattern, pieces into substrings.
    """
    lengths = sorted(r.k for r in read_bounded(patterns.select(F.length("pattern").alias("k")).distinct(), 1000) if r.k)
    most = max(lengths, default=1)
    piece = max(piece, most)
    # the pieces are a column of their own: inside the transform they would be cut anew for each of them
    parts = texts.select("source", "domain", F.regexp_extract_all("text", F.lit(f"(?s)(.{{1,{piece}}})"), F.lit(1)).alias("_p"))
    whole = F.transform("_p", lambda x, i: F.concat(x, F.left(F.coalesce(F.get("_p", i + 1), F.lit("")), F.lit(most - 1))))
    cut = parts.select("source", "domain", F.explode(whole).alias("t"))
    found = None
    while lengths:  # lengths of less than twice the least meet by what they have in common, one substring for each place
        q, own = lengths[0], [k for k in lengths if k < 2 * lengths[0]]
        lengths = lengths[len(own) :]
        at = F.sequence(F.lit(1), F.least(F.lit(piece), F.length("t") - (q - 1)))
        part = cut.where(F.length("t") >= q).select("source", "domain", F.explode(F.transform(at, lambda i: F.substring("t", i, F.lit(own[-1])))).alias("_a"))
        p = patterns.where(F.length("pattern").isin(own)).select("pattern").distinct().withColumn("_q", F.left("pattern", F.lit(q)))
        part = part.withColumn("_q", F.left("_a", F.lit(q))).join(p, "_q").where(F.startswith("_a", "pattern")).select("source", "domain", "pattern")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = cut.where("false").select("source", "domain", F.col("t").alias("pattern"))
    return _counted(found, patterns)


def support_scanned(texts: DataFrame, patterns: DataFrame, most: int = 500_000) -> DataFrame:
    """The same with an automaton of at most ``most`` patterns in every task; matches are counted by text before they move."""
    words = [r.pattern for r in read_bounded(patterns.select("pattern").distinct(), most)]
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        machine = ahocorasick.Automaton()
        for w in shared.value:
            machine.add_word(w, w)
        machine.make_automaton()
        for batch in batches:
            rows: dict = {}
            for t, s, d in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for _, w in machine.iter(t or "") if len(machine) else ():
                    rows[s, d, w] = rows.get((s, d, w), 0) + 1
            keys = list(rows)
            yield pa.record_batch([pa.array([k[2] for k in keys], pa.string()), pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(rows.values()), pa.int64())], names=["pattern", "source", "domain", "k"])

    hits = texts.select("text", F.col("source").cast("string"), F.col("domain").cast("string")).mapInArrow(run, "pattern string, source string, domain string, k long")
    return _counted(hits, patterns, "k")


def _slots(codes: np.ndarray, q: int, bits: int) -> np.ndarray:
    """The bitmap's places of the stretches of q code points, in order."""
    n = len(codes) - q + 1
    h = np.zeros(max(0, n), dtype=np.uint64)
    for k in range(q if n > 0 else 0):
        h = (h ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h & np.uint64(bits - 1)).astype(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def _bitmap(grams: DataFrame) -> np.ndarray:
    """The places of the distinct stretches (column gram) as a bitmap, put together by the executors: at most 4,096 rows of 4 KiB come back."""
    n = grams.count()
    bits = min(BITMAP_BITS, max(1 << 15, 1 << (16 * n).bit_length()))

    def run(batches):
        for batch in batches:
            found = np.unique(np.concatenate([np.zeros(0, np.int64), *(_slots(_codes(g), len(g), bits) for g in batch.column(0).to_pylist())]))
            yield pa.record_batch([pa.array(found + 1, pa.int64())], names=["s"])

    slots = grams.select("gram").mapInArrow(run, "s long").select(F.bitmap_bucket_number("s").alias("bucket"), F.bitmap_bit_position("s").alias("bit"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in slots.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("raw")).collect():
        at = (r.bucket - 1) * 4096
        part = np.frombuffer(r.raw, np.uint8)[: len(out) - at]
        out[at : at + len(part)] = part
    return out


def _at(text: str, q: int, marks: np.ndarray) -> list[int]:
    """Where stretches of q begin that the bitmap may hold."""
    slots = _slots(_codes(text), q, 8 * len(marks))
    return np.flatnonzero(marks[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).tolist()


def support_anchored(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """The same as support_joined for any number of patterns, of any lengths."""
    patterns = settled(patterns.where("pattern <> ''").select("pattern").distinct())
    # a class holds the lengths from a power of two to the next, so what stands around an anchor is no longer than twice a pattern
    cls = F.floor(F.log2(F.length("pattern"))).cast("int")
    sized = patterns.select("pattern", cls.alias("c"), F.least(F.lit(GRAM), F.pow(F.lit(2), cls).cast("int")).alias("q"))
    classes = {r.c: r.q for r in sized.select("c", "q").distinct().collect()}  # one for each power of two up to the longest
    parts = F.posexplode(F.transform(F.sequence(F.lit(1), F.length("pattern") - F.col("q") + 1), lambda i: F.substring("pattern", i, F.col("q"))))
    grams = settled(sized.select("pattern", "c", "q", parts.alias("off", "gram")))
    texts = texts.select("text", F.col("source").cast("string").alias("source"), F.col("domain").cast("string").alias("domain"))
    context = texts.sparkSession.sparkContext

    by_q = {q: _bitmap(grams.where(F.col("q") == q).select("gram").distinct()) for q in sorted(set(classes.values()))}
    shared = context.broadcast(by_q)

    def counted(batches):
        held: dict[str, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for q, marks in shared.value.items():
                    for i in _at(text or "", q, marks):
                        g = text[i : i + q]
                        held[g] = held.get(g, 0) + 1
                    if len(held) > HELD:
                        yield pa.record_batch([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], names=["gram", "n"])
                        held = {}
        yield pa.record_batch([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], names=["gram", "n"])

    counts = texts.select("text").mapInArrow(counted, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rated = grams.join(counts, "gram", "left").groupBy("pattern", "c", "q")
    best = rated.agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "gram")).alias("b")).where("b.n > 0")
    anchors = settled(best.select("pattern", "c", "q", F.length("pattern").alias("len"), "b.off", "b.gram"))
    reach = {r.c: (r.q, r.before, r.after) for r in anchors.groupBy("c", "q").agg(F.max("off").alias("before"), F.max(F.col("len") - F.col("off") - F.col("q")).alias("after")).collect()}
    near = context.broadcast({c: (*x, _bitmap(anchors.where(F.col("c") == c).select("gram").distinct())) for c, x in reach.items()})

    def around(batches):
        for batch in batches:
            rows: list = []
            for text, s, d in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for c, (q, before, after, marks) in near.value.items():
                    for i in _at(text or "", q, marks):
                        a = max(0, i - before)
                        rows.append((c, text[i : i + q], text[a : i + q + after], i - a, s, d))
                    if len(rows) > HELD:
                        yield _rows(rows)
                        rows = []
            yield _rows(rows)

    def _rows(rows):
        kinds = (pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string())
        return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["c", "gram", "around", "at", "source", "domain"])

    hits = texts.mapInArrow(around, "c int, gram string, around string, at int, source string, domain string")
    whole = F.expr("at >= off AND substring(around, at - off + 1, len) = pattern")
    hits = hits.join(anchors.select("pattern", "c", "gram", "off", "len"), ["c", "gram"]).where(whole).select("pattern", "source", "domain")
    return _counted(hits, patterns)


def _counted(hits: DataFrame, patterns: DataFrame, weight: str | None = None) -> DataFrame:
    n = F.sum(weight) if weight else F.count("*")
    by_source = hits.groupBy("pattern", "source", "domain").agg(n.alias("n"))
    out = by_source.groupBy("pattern").agg(F.sum("n").alias("n"), F.count_distinct("source").alias("sources"), F.count_distinct("domain").alias("domains"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return patterns.select("pattern").distinct().join(out, "pattern", "left").select("pattern", F.least(F.coalesce("n", F.lit(0)), F.lit(1_000_000)).cast("long").alias("n"), F.least(F.coalesce("sources", F.lit(0)), F.lit(255)).cast("long").alias("sources"), zero("domains"))

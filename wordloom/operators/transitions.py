"""Word transitions with independent evidence, and the paths that they assemble to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.bounded import stored
from wordloom.functions.keys import PATH_MARK, broad_gate, gated_evidence, strict_gate
from wordloom.operators import blocks, frequent
from wordloom.operators.counting import one_row_each, sorted_marks

PAIR_LEAST, LM_LEAST, VISIBLE_LEAST, BROAD_MOST = 560, 350, 430, 559
PAIR_SOURCES, PATH_LOSS = 12, 36


def ngrams(sentences: DataFrame, n: int, keep: list[str], words: str = "words") -> DataFrame:
    """keep, gram (array of n words) of every position of a row's word array.

    Short rows have no places: a filter by size would split the texts once more, where they are scanned.
    """
    at = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
    return sentences.select(*keep, F.explode(F.transform(at, lambda i: F.slice(words, i, n))).alias("gram"))


def _known(docs: DataFrame, domain: str) -> list:
    """Up to 61 domains."""
    return [r[0] for r in docs.select(domain).where(F.col(domain).isNotNull()).distinct().limit(61).collect()]


def _bit(known: list, domain: str) -> Column:
    bit = F.lit(0).cast("long")
    for k, v in enumerate(known):
        bit = F.when(F.col(domain) == F.lit(v), F.lit(1 << k).cast("long")).otherwise(bit)
    return bit


def _capped(counts: DataFrame, most_n: int, most_sources: int) -> DataFrame:
    return counts.select("gram", F.least("n", F.lit(most_n)).cast("long").alias("n"), F.least("s", F.lit(most_sources)).cast("long").alias("sources"), "domains")


def evidence(docs: DataFrame, source: str, domain: str, grams: str = "grams", most_n: int = 1_000_000, most_sources: int = 255) -> DataFrame:
    """gram, n, sources, domains of docs (source, domain, grams: an array of texts).

    As long as no source has two rows, a row counts its own sources: its grams are sorted, and the first of equal ones is marked.  Then only one row a gram
    leaves a task.  Domains are bits; beyond 60 of them, all are counted by their values.
    """
    known = _known(docs, domain)
    rows = sorted_marks(docs, [source, domain], grams).withColumnRenamed("item", "gram")
    if len(known) > 60:
        out = rows.groupBy("gram").agg(F.count("*").alias("n"), F.count_distinct(source).alias("s"), F.count_distinct(domain).alias("domains"))
    else:
        rows = rows.withColumn("bit", _bit(known, domain))
        if one_row_each(docs, source):
            out = rows.groupBy("gram").agg(F.count("*").alias("n"), F.count_if(F.col("first") & F.col(source).isNotNull()).alias("s"), F.bit_or("bit").alias("bits"))
        else:
            rows = rows.groupBy("gram", source).agg(F.count("*").alias("n"), F.bit_or("bit").alias("bit"))
            out = rows.groupBy("gram").agg(F.sum("n").alias("n"), F.count(source).alias("s"), F.bit_or("bit").alias("bits"))
        out = out.withColumn("domains", F.bit_count("bits").cast("long"))
    return _capped(out, most_n, most_sources)


def gram_evidence(docs: DataFrame, source: str, domain: str, sizes: tuple[int, ...], marked: dict | None = None, words: str = "words", most_n: int = 1_000_000, most_sources: int = 255) -> DataFrame:
    """The same of the n-grams of these sizes (words joined by |) of docs (source, domain, words: an array); of ``marked`` ones only, as from frequent.marks().

    As long as no source has two rows and domains are at most 60, blocks of rows count them before anything moves.
    """
    known = _known(docs, domain)
    if len(known) <= 60 and one_row_each(docs, source):
        counts = blocks.gram_counts(docs, source, _bit(known, domain), sizes, words, marked)
        out = counts.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.bit_or("bits").alias("bits"))
        return _capped(out.withColumn("domains", F.bit_count("bits").cast("long")), most_n, most_sources)
    joined = lambda at, size: F.concat_ws(PATH_MARK, F.slice(words, at, size))
    if marked is not None:
        docs = frequent.with_places(docs, marked, words)
        made = F.transform("places", lambda p: joined(F.shiftright(p, 3) + 1, p.bitwiseAND(7)))
    else:
        def grams(n: int) -> Column:
            places = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda i: joined(i, F.lit(n)))

        made = F.flatten(F.array(*map(grams, sizes)))
    return evidence(docs.withColumn("grams", made), source, domain, "grams", most_n, most_sources)


def scored(paths: DataFrame) -> DataFrame:
    """Paths (words, syl, weight, n, sources, domains) with evidence, source_count, strict, visible."""
    n, s, d = F.col("n"), F.col("sources"), F.col("domains")
    e = gated_evidence(F.col("weight"), n, s, d)
    visible = strict_gate(n, s, d) & (F.col("weight") >= VISIBLE_LEAST)
    out = F.when(e.isNull(), F.least(F.lit(BROAD_MOST), F.col("weight"))).when(visible, e).otherwise(F.least(F.lit(BROAD_MOST), e))
    return paths.withColumn("visible", visible).withColumn("evidence", out.cast("int")).withColumn("source_count", F.when(broad_gate(n, s, d), s).otherwise(1).cast("int"))


def read_paths(transitions: DataFrame, readings: DataFrame, options: int = 4) -> DataFrame:
    """Transitions (query, words, weight) of two or three words with every reading of their words (text, syllables, rank)
    that spells the query; ``options`` readings a word at most, chosen before they are compared."""
    r = readings.where(F.col("rank") <= options)
    t = transitions.where((F.col("weight") >= LM_LEAST) & F.size("words").isin(2, 3)).withColumn("syl", F.array().cast("array<array<string>>"))
    out = None
    for size in (2, 3):
        part = t.where(F.size("words") == size)
        for k in range(size):
            w = r.select(F.col("text").alias("_w"), F.col("syllables").alias("_s"))
            part = part.join(w, F.element_at("words", k + 1) == F.col("_w")).withColumn("syl", F.concat("syl", F.array("_s"))).drop("_w", "_s")
        out = part if out is None else out.unionByName(part)
    return out.where(F.concat_ws("", F.flatten("syl")) == F.col("query"))


def pair_backed(trigrams: DataFrame, pairs: DataFrame, options: int = 4) -> DataFrame:
    """Trigrams (words, syl, evidence) both of whose halves are pairs (words, syl, evidence), read alike in the middle."""
    w = Window.partitionBy("words").orderBy(F.desc("evidence"), "syl")
    p = pairs.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= options)
    left = p.select(F.col("words").alias("lw"), F.col("syl").alias("ls"), F.col("evidence").alias("le"))
    right = p.select(F.col("words").alias("rw"), F.col("syl").alias("rs"), F.col("evidence").alias("re"))
    t = trigrams.where(F.size("words") == 3)
    out = t.join(left, F.slice("words", 1, 2) == F.col("lw")).join(right, F.slice("words", 2, 2) == F.col("rw"))
    out = out.where((F.col("ls")[1] == F.col("rs")[0]) & (F.concat("ls", F.slice("rs", 2, 1)) == F.col("syl")))
    e = F.least("le", "re") + F.greatest(F.lit(0), F.col("evidence") - 360)
    return out.groupBy("words", "syl").agg(F.max(e).cast("int").alias("evidence")).withColumn("source_count", F.lit(PAIR_SOURCES))


def four_words(trigrams: DataFrame, options: int = 6) -> DataFrame:
    """Trigrams joined where the last two words of one are the first two of another; each side is cut first.

    No trigram too weak for a path is moved: it would stand after all others.  Readings are compared after the join: as keys they would deal both sides anew.
    """
    strong = trigrams.where(F.col("evidence") >= PAIR_LEAST + PATH_LOSS)

    def side(at: int, outer: int, p: str, *ties: str) -> DataFrame:
        t = strong.select(F.slice("words", at, 2).alias("mid"), F.slice("syl", at, 2).alias(f"{p}m"), F.get("words", F.lit(outer)).alias(f"{p}w"), F.get("syl", F.lit(outer)).alias(f"{p}s"), F.col("evidence").alias(f"{p}e"))
        w = Window.partitionBy("mid").orderBy(F.desc(f"{p}e"), f"{p}w", *ties)
        return t.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= options).drop("_k")

    out = side(2, 0, "l", "ls", "lm").join(side(1, 2, "r", "rm", "rs"), "mid")
    syl = F.when(F.col("lm") == F.col("rm"), F.concat(F.array("ls"), "lm", F.array("rs")))
    out = out.select(F.concat(F.array("lw"), "mid", F.array("rw")).alias("words"), syl.alias("syl"), (F.least("le", "re") - PATH_LOSS).alias("evidence"))
    return out.where(F.col("syl").isNotNull()).withColumn("source_count", F.lit(PAIR_SOURCES))


def completions(paths: DataFrame, most: int, suffix_words: int = 3, suffix_units: int = 6) -> DataFrame:
    """anchor, suffix, syllables, evidence, sources: each path cut after one to three words; best of each key, top ``most`` of each anchor.

    Rows move once, to their anchor, where both are found.
    """
    df = paths.withColumn("a", F.explode(F.sequence(F.lit(1), F.least(F.lit(3), F.size("words") - 1))))
    df = df.select(
        F.slice("words", F.lit(1), F.col("a")).alias("anchor"),
        F.slice("words", F.col("a") + 1, F.size("words")).alias("suffix"),
        F.flatten(F.slice("syl", F.col("a") + 1, F.size("words"))).alias("syllables"),
        (F.col("evidence") + (F.col("a") - 1) * 18 - (F.size("words") - F.col("a") - 1) * 14).cast("int").alias("evidence"),
        F.col("source_count").alias("sources"),
    )
    df = df.where((F.size("suffix") <= suffix_words) & (F.size("syllables").between(1, suffix_units)))
    one = F.struct("evidence", F.negate(F.size("suffix")).alias("fewer"), "sources", "suffix")
    df = df.repartition("anchor").groupBy("anchor", F.concat_ws("", "suffix").alias("text"), "syllables").agg(F.max(one).alias("m"))
    df = df.select("anchor", "m.suffix", "syllables", "m.evidence", "m.sources")
    w = Window.partitionBy("anchor").orderBy(F.desc("evidence"), F.desc("sources"), F.size("syllables"), "suffix", "syllables")
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most).drop("_k")


def completion_index(pairs: DataFrame, lm_paths: DataFrame, most_visible: int = 8, most_recall: int = 24) -> DataFrame:
    """The index of continuations: recall rows, each flagged visible if the strict evidence alone shows it.

    pairs (words, syl, evidence); lm_paths as from scored().
    """
    cols = ["words", "syl", "evidence", "source_count"]
    known = pairs.where(F.col("evidence") >= PAIR_LEAST).withColumn("source_count", F.lit(PAIR_SOURCES)).select(*cols)
    seen = lm_paths.where("visible").select(*cols)
    backed = pair_backed(seen, pairs).select(*cols)

    def strongest(*frames):
        df = frames[0]
        for f in frames[1:]:
            df = df.unionByName(f)
        return df.groupBy("words", "syl").agg(F.max(F.struct("evidence", "source_count")).alias("m")).select("words", "syl", "m.*")

    strict = stored(strongest(seen, backed))  # each is read for its rows and either side of the four-word paths
    accepted = stored(strongest(strict, lm_paths.where(~F.col("visible")).select(*cols)))

    def rows(lm, most):
        return completions(known.unionByName(lm).unionByName(four_words(lm.where(F.size("words") == 3)).select(*cols)), most)

    shown = rows(strict, most_visible).select("anchor", "suffix", "syllables").withColumn("visible", F.lit(True))
    return rows(accepted, most_recall).join(shown, ["anchor", "suffix", "syllables"], "left").withColumn("visible", F.coalesce("visible", F.lit(False)))


def next_lines(manifest: DataFrame) -> DataFrame:
    """Editorial continuations (line, mark, next, reading): a reading has a syllable for each character, or the job fails."""
    syl = F.split("reading", "'")
    fine = F.when(F.size(syl) == F.length("next"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("reading does not match: "), "next")).cast("boolean"))
    return manifest.where(fine).select(F.array("line").alias("anchor"), F.array(F.concat("mark", "next")).alias("suffix"), syl.alias("syllables"), F.lit(900).alias("evidence"), F.lit(9).alias("sources"), F.lit(True).alias("visible"))


def independent_pairs(pairs: DataFrame, lexicon: DataFrame, least_sources: int = 4, per_reading: int = 1, lead: float = 2.0) -> DataFrame:
    """Pairs (text, reading, n, sources) that no lexicon entry of their reading rivals: enough sources, not a
    lexicon text, one for each reading, and the runner-up too if it has over 1/lead of the first's count."""
    p = pairs.where(F.col("sources") >= least_sources).join(lexicon.select("text").distinct(), "text", "left_anti")
    w = Window.partitionBy("reading").orderBy(F.desc("n"), "text")
    p = p.withColumn("k", F.row_number().over(w)).withColumn("first", F.first("n").over(w))
    return p.where((F.col("k") <= per_reading) | ((F.col("k") == per_reading + 1) & (F.col("n") * lead > F.col("first")))).drop("first")


def kept_weights(base: DataFrame, new: DataFrame) -> DataFrame:
    """New transitions with the base's weight wherever the base has one; base rows stay."""
    b, n = base.select("reading", "path", F.col("weight").alias("old")), new.select("reading", "path", F.col("weight").alias("now"))
    return b.join(n, ["reading", "path"], "full").select("reading", "path", F.coalesce("old", "now").alias("weight"))


def nbest_priors(segmentations: DataFrame, n: int = 2) -> DataFrame:
    """path, weight: word n-grams of the segmentations (stretch, n, score, pieces) of a corpus; near-best ones count by their share of the probability."""
    total = F.log(F.sum(F.exp(F.col("score") - F.col("best"))).over(Window.partitionBy("stretch")))
    rows = segmentations.withColumn("best", F.max("score").over(Window.partitionBy("stretch"))).withColumn("share", F.exp(F.col("score") - F.col("best") - total))
    grams = ngrams(rows, n, ["n", "share"], "pieces")
    return grams.groupBy(F.concat_ws("|", "gram").alias("path")).agg(F.sum(F.col("n") * F.col("share")).alias("weight"))


def guarded_pairs(pairs: DataFrame, lexicon: DataFrame, tails: DataFrame | None = None, least_sources: int = 4, least_contexts: int = 2, homophone_lead: float = 2.0, extension_share: float = 0.9) -> DataFrame:
    """Pairs (left, right, reading, n, sources, lefts, rights) that may stand as transitions of their own.

    lefts, rights: how many different words stand before and after, or ``least_contexts`` for any more.  A pair stays if it has the sources and, on either
    side, the contexts; if its whole is no lexicon text; if its right word is not of a barred kind (``tails``: text); if no
    homophone has over 1/``homophone_lead`` of its count but the strongest of its reading; and if no longer word of the lexicon
    that begins with it accounts for ``extension_share`` of its occurrences (lexicon: text, n).
    """
    p = pairs.withColumn("text", F.concat("left", "right")).where((F.col("sources") >= least_sources) & (F.col("lefts") >= least_contexts) & (F.col("rights") >= least_contexts))
    p = p.join(lexicon.select("text").distinct(), "text", "left_anti")
    if tails is not None:
        p = p.join(tails.select(F.col("text").alias("right")).distinct(), "right", "left_anti")
    longer = lexicon.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("text") - 1), lambda k: F.substring("text", F.lit(1), k))).alias("text"))
    longer = longer.groupBy("text").agg(F.sum("n").alias("inside"))
    p = p.join(longer, "text", "left").where(F.coalesce("inside", F.lit(0)) < extension_share * F.col("n"))
    w = Window.partitionBy("reading").orderBy(F.desc("n"), "text", "left")  # one text can be two pairs
    p = p.withColumn("k", F.row_number().over(w)).withColumn("first", F.first("n").over(w))
    return p.where((F.col("k") == 1) | (F.col("n") * homophone_lead > F.col("first"))).select("left", "right", "reading", "n", "sources", "k")


def strong_single_pairs(pairs: DataFrame, lexicon: DataFrame, crossing: DataFrame, least_sources: int = 4, share: float = 0.5) -> DataFrame:
    """Pairs of single units (left, right, reading, n, sources) outside the lexicon whose occurrences (crossing: left, right, n) seldom cross the edge of words:
    at most 1 - ``share`` of them; one for each reading, and the runner-up if it has over half of its count."""
    p = pairs.where((F.length("left") == 1) & (F.length("right") == 1)).withColumn("text", F.concat("left", "right"))
    c = crossing.select("left", "right", F.col("n").alias("across"))
    p = p.join(c, ["left", "right"], "left").where(F.coalesce("across", F.lit(0)) <= (1 - share) * F.col("n"))
    return independent_pairs(p.select("text", "reading", "n", "sources"), lexicon, least_sources)

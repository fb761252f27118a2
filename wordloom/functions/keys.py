"""Column expressions: reading keys, runs of units, scores.  All stay in the JVM."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_MARK, SYLLABLE_MARK = "|", "'"


@dataclass(frozen=True)
class UnitProfile:
    """What a writing system counts as a unit, and where its sentences end."""

    unit: str  # a regular expression class
    sentence_split: str = r"[。！？!?；;，,、：:…\n\r\t ]+"
    min_units: int = 4
    max_units: int = 40
    overlap: int = 4

    @property
    def run(self) -> str:
        return f"[{self.unit}]+"


CJK = UnitProfile(r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3134f}")
LATIN = UnitProfile(r"\p{L} ", sentence_split=r"[.!?;,:|\n\r\t]+", min_units=8, max_units=40)


def trimmed(c: Column) -> Column:
    """Without any Unicode white space at both ends (trim() knows spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def exact_key(c: Column) -> Column:
    """A reading as its letters and syllable marks."""
    return F.regexp_replace(F.translate(F.lower(trimmed(c)), "‘’ʼ`", "''''"), "[^a-z']", "")


def compact_key(c: Column) -> Column:
    return F.replace(exact_key(c), F.lit("'"), F.lit(""))


def lookup_key(c: Column) -> Column:
    """With explicit syllable marks a reading is a key of its own."""
    return F.when(exact_key(c).contains("'"), exact_key(c)).otherwise(compact_key(c))


def latin_reading(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+)"), F.lit(1))


def repetitive(c: Column, least: int = 8, percent: int = 55) -> Column:
    """Whether one character makes up ``percent`` (over 50) of a text of ``least`` characters or more.

    A character with over half of the places has the middle one too once they are sorted: no other needs counting.
    """
    if percent <= 50:
        raise ValueError("percent must be over 50")
    middle = F.element_at(F.sort_array(F.array_remove(F.split(c, ""), "")), F.floor((F.length(c) / 2) + 1).cast("int"))
    return F.when(F.length(c) >= least, (F.length(c) - F.length(F.replace(c, middle, F.lit("")))) * 100 >= F.length(c) * percent).otherwise(F.length(c) < 0)


def log_score(n: Column) -> Column:
    return F.round(100 * F.log10(1 + n)).cast("long")


def length_weight(c: Column) -> Column:
    return F.when(F.length(c) <= 4, 40).otherwise(20)


def link_hint(n: Column) -> Column:
    """The tier of a candidate by its number of links."""
    return F.when(n >= 100, 0.80).when(n >= 50, 0.78).when(n >= 25, 0.76).when(n >= 12, 0.74).otherwise(0.72)


def strict_gate(n: Column, sources: Column, domains: Column) -> Column:
    return (n >= 12) & (sources >= 5) & (domains >= 2)


def broad_gate(n: Column, sources: Column, domains: Column) -> Column:
    return (n >= 3) & (sources >= 2) & (domains >= 1)


def gated_evidence(evidence: Column, n: Column, sources: Column, domains: Column) -> Column:
    """Null below the broad gate; capped below the prompt's threshold under the strict one."""
    bonus = F.least(F.lit(96), F.bround(F.log2(n + 1) * 12).cast("int")) + F.least(F.lit(60), 4 * sources) + F.least(F.lit(36), 12 * domains)
    score = evidence + bonus
    return F.when(strict_gate(n, sources, domains), score).when(broad_gate(n, sources, domains), F.least(F.lit(559), score)).cast("int")


def record_text(value: Column) -> Column:
    """The texts of a JSON record: text, else content, else the contents of its messages; bad records give none."""
    r = F.from_json(value, "text STRING, content STRING, messages ARRAY<STRUCT<role: STRING, content: STRING>>")
    said = F.transform(r["messages"], lambda m: m["content"])
    one = F.coalesce(r["text"], r["content"])
    return F.filter(F.when(one.isNotNull(), F.array(one)).otherwise(F.coalesce(said, F.array().cast("array<string>"))), lambda t: t.isNotNull() & (t != ""))


def mapped_chars(c: Column, pairs: dict[str, str], least: int = 2) -> Column:
    """One-for-one form conversion of texts of ``least`` characters or more; a single character stays."""
    return F.when(F.length(c) >= least, F.translate(c, "".join(pairs), "".join(pairs.values()))).otherwise(c)


def mapped_path(c: Column, pairs: dict[str, str]) -> Column:
    """The same for the segments of a path, if the path has two characters or more in all."""
    return F.when(F.length(F.replace(c, F.lit(PATH_MARK), F.lit(""))) >= 2, F.translate(c, "".join(pairs), "".join(pairs.values()))).otherwise(c)


def mapped_weights(c: Column, pairs: dict[str, str]) -> Column:
    """A list ``word:weight|word:weight`` with its words converted; the last colon splits."""
    one = lambda x: F.concat(mapped_chars(F.regexp_replace(x, ":[^:]*$", ""), pairs), F.lit(":"), F.substring_index(x, ":", -1))
    return F.array_join(F.transform(F.split(c, r"\|"), one), "|")


def stretches(c: Column, alphabet: str) -> Column:
    """The longest runs of characters of an alphabet, such as that of a lexicon."""
    quoted = "".join(f"\\x{{{ord(x):x}}}" for x in sorted(set(alphabet)))
    return F.regexp_extract_all(c, F.lit(f"([{quoted}]+)"), F.lit(1))


def is_name(c: Column, profile: UnitProfile = CJK, least: int = 2, most: int = 8) -> Column:
    """Nothing but units, of bounded length."""
    return c.rlike(f"^[{profile.unit}]{{{least},{most}}}$")


def overlapping(text: Column, piece: int, more: int) -> Column:
    """The text in pieces of ``piece`` units, each with up to ``more`` (at most ``piece``) units of what follows; the text is read once, however long."""
    if more > piece:
        raise ValueError("a piece can only be followed by one piece")
    parts = F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{piece}}})"), F.lit(1))
    return F.transform(parts, lambda x, i: F.concat(x, F.left(F.coalesce(F.get(parts, i + 1), F.lit("")), F.lit(more))))

"""Personal data: exact patterns, and a semi-Markov conditional random field that finds what they miss.

Base spans are those of four patterns (email, ip, card, phone), each leftmost and not overlapping, found in time linear in the text; a match that
fails its check (parts, digits, Luhn) is dropped and not tried again.  So a phone number followed by a card number, two card numbers
side by side, or an address followed by a number are lost to them.  The random field adds those:

1. Islands of a text hold everything that a span could be made of: stretches of digits and the signs between them, and words with an @.  An island whose
   digits and @ all lie in base spans needs no more.
2. Tokens of an island are digit runs, letter runs and single signs.  Candidates are stretches of at most ``TOKENS`` of them; features look at the whole
   candidate: its groups of digits, their number, its signs, Luhn, parts, address grammar, both ends and both neighbours.
3. A dynamic programme over the island chooses boundaries and kinds together (with weights between neighbouring kinds); base spans are fixed in it.
4. What it adds must pass the check of its kind (``plausible``) and touches no base span.

The weights are learned from at most ``ISLANDS`` islands of each sort (with base spans and without), from about ``SAMPLE`` documents chosen by a
hash of the id, and from islands put together from base spans side by side, whose boundaries are known.  They are fitted by stochastic gradient on the
conditional likelihood.  No document is labelled by hand, and without a base span in the sample nothing is added.

Nothing is shuffled but the sample's islands.  Null texts have no spans; rows that share an id each have their own result; an empty table gives an empty one.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import Memo, id_and_text, read_table, slices

KINDS = ("email", "ip", "card", "phone")
SAMPLE, ISLANDS, TOKENS, CHARS = 20_000, 300, 24, 64
SCHEMA = "doc_id long, base string, spans string, n_email long, n_ip long, n_card long, n_phone long, n_added long"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin at the first digit of a run; possessive repeats, so that a long run is read once
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_PIECE = re.compile(r"(?<!\S)[^\s@]*+@\S*|[0-9+(][0-9 ().+-]*")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)
_GROUPS = re.compile(r"[0-9]+")


def digits(s: str) -> str:
    return "".join(_GROUPS.findall(s))


def luhn(number: str) -> bool:
    """The check digit of a number: every second digit from the right counts twice, its own digits added."""
    twice = sum(d * 2 - 9 * (d > 4) for d in map(int, number[-2::-2]))
    return (twice + sum(map(int, number[::-2]))) % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            end = m.end()
            yield begin, end
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, by start, then kind."""
    if not _ANY.search(text):
        return []
    out = [(a, 0, b) for a, b in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = digits(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def plausible(kind: int, s: str) -> bool:
    """Whether a span by itself is of the pattern of its kind and passes its check."""
    if kind == 0:
        return next(_emails(s), None) == (0, len(s))
    if kind == 1:
        return bool(_IP.fullmatch(s)) and all(map(_byte, s.split(".")))
    if kind == 2:
        return bool(_CARD.fullmatch(s)) and 12 <= len(digits(s)) <= 19 and luhn(digits(s))
    return bool(_PHONE.fullmatch(s)) and 9 <= len(digits(s)) <= 15


# --- islands and features ------------------------------------------------------------------------


def islands(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the stretches with digits or an @ outside the spans; pieces with only white space between them are one."""
    out: list[list[int]] = []
    for m in _PIECE.finditer(text):
        if out and not text[out[-1][1] : m.start()].strip():
            out[-1][1] = m.end()
        else:
            out.append([m.start(), m.end()])
    found, k, covered = [], 0, 0  # covered: the end of the spans that begin before
    for a, b in out:
        loose, at = False, a
        while at < b and not loose:
            while k < len(spans) and spans[k][0] <= at:
                covered = max(covered, spans[k][2])
                k += 1
            if covered > at:
                at = covered
                continue
            stop = min(b, spans[k][0]) if k < len(spans) else b
            loose, at = _ANY.search(text, at, stop) is not None, stop
        if loose:
            found.append((a, b))
    return found


def _class(c: str) -> str:
    return "s" if not c or c.isspace() else "d" if "0" <= c <= "9" else "a" if c.isalpha() else c if c in "().+-@,;:=\"'/_#%" else "o"


def features(s: str, before: str, after: str) -> tuple[str, ...]:
    """What the field looks at: the whole of a candidate and its two neighbours."""
    groups = _GROUPS.findall(s)
    n = sum(map(len, groups))
    shape = "-".join(str(min(len(g), 20)) for g in groups[:6]) + ("-" if len(groups) > 6 else "")
    signs = "".join(sorted({c for c in s if not c.isalnum()} & set(" ().+-@_%")))
    check = str(luhn("".join(groups))) if 12 <= n <= 19 else "none"
    parts = len(groups) == 4 and "." in signs and all(map(_byte, groups))
    return ("bias", f"before {_class(before)}", f"after {_class(after)}", f"digits {min(n, 20)}", f"shape {shape}", f"signs {signs}", f"luhn {check}", f"luhn {check} {len(groups) == 1 or '.' not in signs}", f"parts {parts}", f"first {_class(s[0])}", f"last {_class(s[-1])}", f"address {'@' in s and plausible(0, s)}", f"letters {any(c.isalpha() for c in s)}")


def _token_class(t: str) -> str:
    return f"digits {min(len(t), 8)}" if "0" <= t[0] <= "9" else "letters" if t.isalpha() else f"sign {_class(t[0])}"


class Island:
    """The tokens of a stretch and its candidates (first token, past the last one); fixed: {(first, past): kind}."""

    def __init__(self, text: str, before: str = "", after: str = "", spans: tuple[tuple[int, int, int], ...] = ()):
        """spans: (start, kind, end) that are kept as they are; a span that overlaps an earlier one, or cuts a token, only bars its tokens."""
        self.text = text
        at = [m.start() for m in _TOKEN.finditer(text)]
        self.edge = [*at, len(text)]
        place = {x: k for k, x in enumerate(self.edge)}
        self.tokens = [text[a:b] for a, b in zip(self.edge, self.edge[1:])]
        taken, self.fixed, end = [False] * len(at), {}, 0
        for a, kind, b in spans:
            if a >= end and a in place and b in place:
                self.fixed[place[a], place[b]] = kind
            for k in range(max(0, bisect_right(self.edge, a) - 1), min(len(at), bisect_left(self.edge, b))):
                taken[k] = True
            end = max(end, b)
        self.candidates: list[tuple[int, int]] = []
        self.seen: list[tuple[str, ...]] = []
        for i, first in enumerate(self.tokens):
            if taken[i] or not (first.isascii() and (first.isalnum() or first in "+(")):
                continue
            n, letters, address = 0, False, False
            for j in range(i, min(len(at), i + TOKENS)):
                t = self.tokens[j]
                if taken[j] or t.isspace() and t != " ":
                    break
                n += len(t) if "0" <= t[0] <= "9" else 0
                letters, address = letters or t.isalpha(), address or t == "@"
                if n > 19 and not address or self.edge[j + 1] - self.edge[i] > CHARS:
                    break
                if (address or n >= 4 and not letters) and t.isascii() and t.isalnum():
                    s = text[self.edge[i] : self.edge[j + 1]]
                    self.candidates.append((i, j + 1))
                    self.seen.append(features(s, text[self.edge[i] - 1] if i else before, text[self.edge[j + 1]] if j + 1 < len(at) else after))

    def kinds(self, spans) -> dict[tuple[int, int], int]:
        place = {x: k for k, x in enumerate(self.edge)}
        return {(place[a], place[b]): k for a, k, b in spans if a in place and b in place}


class Field:
    """Weights of candidates' features by kind, of tokens outside spans, and between neighbouring kinds (0: outside)."""

    def __init__(self, names: dict[str, int]):
        self.names = names
        self.w, self.t = np.zeros((len(names) + 1, len(KINDS))), np.zeros((len(KINDS) + 1,) * 2)  # the last row: unknown names

    def rows(self, names) -> list[int]:
        return [self.names.get(x, len(self.names)) for x in names]

    def scores(self, island: Island) -> tuple[list[list[float]], list[float]]:
        """Of each candidate by kind, and of each token outside."""
        own = [self.w[self.rows(f)].sum(axis=0).tolist() for f in island.seen]
        return own, [float(self.w[self.names.get(f"outside {_token_class(t)}", len(self.names)), 0]) for t in island.tokens]

    def steps(self, island: Island) -> list[list[tuple[int, int, float, int]]]:
        """For each token place the steps that end there: (from, kind + 1 or 0, score, candidate or -1)."""
        own, outside = self.scores(island)
        out: list[list] = [[] for _ in range(len(island.tokens) + 1)]
        fixed_at = {k for (i, j) in island.fixed for k in range(i, j)}
        for k, s in enumerate(outside):
            if k not in fixed_at:
                out[k + 1].append((k, 0, s, -1))
        for (i, j), kind in island.fixed.items():
            out[j].append((i, kind + 1, 0.0, -1))
        for c, (i, j) in enumerate(island.candidates):
            out[j] += [(i, k + 1, own[c][k], c) for k in range(len(KINDS))]
        return out

    def best(self, island: Island) -> list[tuple[int, int, int]]:
        """(first token, kind, past token) of the spans of the best reading, fixed ones too."""
        t, n = self.t.tolist(), len(island.tokens)
        top = [[-np.inf] * len(t) for _ in range(n + 1)]
        back: list[list] = [[None] * len(t) for _ in range(n + 1)]
        top[0][0] = 0.0
        for e, steps in enumerate(self.steps(island)):
            for a, y, s, _ in steps:
                for x, v in enumerate(top[a]):
                    if v + t[x][y] + s > top[e][y]:
                        top[e][y], back[e][y] = v + t[x][y] + s, (a, x)
        y, e, out = max(range(len(t)), key=lambda k: top[n][k]), n, []
        while e:
            a, x = back[e][y]
            if y:
                out.append((a, y - 1, e))
            e, y = a, x
        return out[::-1]

    def gradient(self, island: Island, kinds: dict[tuple[int, int], int]) -> tuple[float, np.ndarray, np.ndarray]:
        """The log likelihood of the reading with these spans, and its gradient: what is seen less what is expected."""
        steps, n, y = self.steps(island), len(island.tokens), len(self.t)
        ahead = np.full((n + 1, y), -np.inf)
        ahead[0, 0] = 0.0
        enter = np.empty((n + 1, y))
        for e in range(n + 1):
            if e:
                ends: list[list[float]] = [[] for _ in range(y)]
                for a, k, s, _ in steps[e]:
                    ends[k].append(enter[a, k] + s)
                ahead[e] = [np.logaddexp.reduce(x) if x else -np.inf for x in ends]
            enter[e] = np.logaddexp.reduce(ahead[e][:, None] + self.t, axis=0)
        total = np.logaddexp.reduce(ahead[n])
        behind, leave = np.zeros((n + 1, y)), [[[] for _ in range(y)] for _ in range(n + 1)]
        dw, dt = np.zeros_like(self.w), np.zeros_like(self.t)
        names = [self.rows(f) for f in island.seen]
        for e in range(n, -1, -1):
            if e < n:
                into = np.array([np.logaddexp.reduce(x) if x else -np.inf for x in leave[e]])  # of each next kind
                both = self.t + into[None, :]
                behind[e] = np.logaddexp.reduce(both, axis=1)
                dt -= np.exp(ahead[e][:, None] + both - total)
            for a, k, s, c in steps[e]:
                leave[a][k].append(s + behind[e, k])
                p = np.exp(enter[a, k] + s + behind[e, k] - total)
                if c >= 0:
                    np.add.at(dw[:, k - 1], names[c], -p)
                elif not k:
                    dw[self._outside(island, a), 0] -= p
        at, x, likely, places = 0, 0, 0.0, {c: k for k, c in enumerate(island.candidates)}
        own, outside = self.scores(island)
        starts = {i: (j, k) for (i, j), k in kinds.items()}
        while at < n:
            j, k = starts.get(at, (at + 1, -1))
            dt[x, k + 1] += 1
            likely += self.t[x, k + 1]
            if k < 0:
                dw[self._outside(island, at), 0] += 1
                likely += outside[at]
            elif (at, j) in places:
                c = places[at, j]
                np.add.at(dw[:, k], names[c], 1.0)
                likely += own[c][k]
            at, x = j, k + 1
        dw[-1] = 0
        return likely - total, dw, dt

    def _outside(self, island: Island, k: int) -> int:
        return self.names.get(f"outside {_token_class(island.tokens[k])}", len(self.names))


def learned(examples: list[tuple[str, str, str, list[tuple[int, int, int]]]], passes: int = 6, rate: float = 0.5, decay: float = 1e-4) -> Field | None:
    """A field fitted to (text, before, after, spans); None where there is no span to learn from."""
    if not any(spans for *_, spans in examples):
        return None
    r = random.Random(7)
    found = [(s[a:b], k) for s, _, _, spans in examples for a, k, b in spans]
    joined = []
    for _ in range(min(ISLANDS, 2 * len(found))):  # spans side by side, as one island
        text, spans = "", []
        for s, k in (r.choice(found) for _ in range(r.choice((2, 2, 3)))):
            text += r.choice((" ", " ", ", ", "; ")) if text else ""
            spans.append((len(text), k, len(text) + len(s)))
            text += s
        joined.append((text, " ", r.choice((" ", ".", ",")), spans))
    islands = []
    for text, before, after, spans in examples + joined:
        island = Island(text, before, after)
        kinds = island.kinds(spans)
        if all(c in set(island.candidates) for c in kinds):
            islands.append((island, kinds))
    names = sorted({x for i, _ in islands for f in i.seen for x in f} | {f"outside {_token_class(t)}" for i, _ in islands for t in i.tokens})
    field = Field({x: k for k, x in enumerate(names)})
    sums = [np.full_like(field.w, 1e-6), np.full_like(field.t, 1e-6)]
    for _ in range(passes):
        r.shuffle(islands)
        for island, kinds in islands:
            _, *steps = field.gradient(island, kinds)
            for weights, step, total in zip((field.w, field.t), steps, sums):
                step -= decay * weights
                total += step * step
                weights += rate * step / np.sqrt(total)
    return field


# --- tables --------------------------------------------------------------------------------------


def _disjoint(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list = []
    for s in spans:
        if not out or s[0] >= out[-1][2]:
            out.append(s)
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, most: int = ISLANDS) -> Field | None:
    """The field, from at most ``most`` islands with base spans and as many without, of about ``sample`` documents."""
    docs = id_and_text(docs, id_col, text_col)
    share = min(1.0, sample / max(1, docs.count()))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                if text and _ANY.search(text):
                    spans = _disjoint(base_spans(text))
                    for a, b in islands(text, []):
                        own = [(x - a, k, y - a) for x, k, y in spans if a <= x and y <= b]
                        if b - a <= 4 * CHARS and all(y <= a or x >= b or (a <= x and y <= b) for x, _, y in spans):
                            rows.append((text[a:b], text[a - 1 : a], text[b : b + 1], " ".join(f"{x}:{k}:{y}" for x, k, y in own)))
            yield pa.record_batch([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], names=["island", "before", "after", "spans"])

    found = chosen.mapInArrow(run, "island string, before string, after string, spans string").distinct()
    by = F.xxhash64("island", "before", "after"), F.col("island"), F.col("before"), F.col("after")
    rows = [r for some in (F.col("spans") != "", F.col("spans") == "") for r in found.where(some).orderBy(*by).limit(most).collect()]
    return learned([(r.island, r.before, r.after, [tuple(map(int, s.split(":"))) for s in r.spans.split()]) for r in rows])


def added_spans(text: str, base: list[tuple[int, int, int]], field: Field, decoded: Memo | None = None) -> list[tuple[int, int, int]]:
    """The spans that the field finds beside the base ones."""
    out = []
    for a, b in islands(text, base):
        inside = tuple((max(x, a) - a, k, min(y, b) - a) for x, k, y in base if x < b and y > a)
        key = (text[a:b], text[a - 1 : a], text[b : b + 1], inside)
        out += [(a + x, k, a + y) for x, k, y in (decoded[key] if decoded is not None and b - a <= CHARS else _decoded(field, key))]
    return out


def _decoded(field: Field, key) -> list[tuple[int, int, int]]:
    text, _, _, inside = key
    island = Island(*key)
    if not island.candidates:
        return []
    found = ((island.edge[i], k, island.edge[j]) for i, k, j in field.best(island))
    return [(a, k, b) for a, k, b in found if plausible(k, text[a:b]) and all(y <= a or x >= b for x, _, y in inside)]


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def personal_data(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (kind:start:end in code points, comma-joined; base spans, and all), the number of base spans of each kind, and of added ones."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # a few thousand weights

    def run(batches):
        field = shared.value
        decoded = Memo(lambda key: _decoded(field, key), 1 << 14)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for text in part.column(1).to_pylist():
                    base = base_spans(text) if text else []
                    more = added_spans(text, base, field, decoded) if text and field and _ANY.search(text) else []
                    count = [0] * len(KINDS)
                    for _, k, _ in base:
                        count[k] += 1
                    rows.append((_joined(base), _joined(sorted(base + more)), *count, len(more)))
                yield pa.record_batch([part.column(0), *(pa.array([r[k] for r in rows], pa.string() if k < 2 else pa.int64()) for k in range(7))], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_email, n_ip, n_card and n_phone count the base spans; spans holds all, n_added those of the random field."""
    docs = read_table(spark, sf_dir, "documents")
    found = personal_data(docs, fit(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_added")

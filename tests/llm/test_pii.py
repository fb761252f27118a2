import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from tests.conftest import SMALL
from wordloom.llm import pii, queries
from wordloom.llm.common import read_table

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
CARD, OTHER, PHONE = "4465758382889437", "4917484589897107", "+1 (269) 555-3296"


def plain_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            s, d = m.group(), re.sub(r"\D", "", m.group(), flags=re.ASCII)
            double = [int(c) * 2 if n % 2 else int(c) for n, c in enumerate(reversed(d))]
            if k == 0 or k == 1 and max(map(int, s.split("."))) <= 255 or k == 2 and 12 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in double) % 10 == 0 or k == 3 and 9 <= len(d) <= 15:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in spans)


@pytest.fixture(scope="module")
def field():
    phones = [f"+1 ({r}) 555-{r * 3 % 10000:04d}" for r in range(200, 900, 40)]
    cards = [c for c in (f"4{n:015d}" for n in range(10**14, 10**14 + 900, 7)) if pii.luhn(c)][:12]
    found = [(s, 3) for s in phones] + [(s, 2) for s in cards] + [(f"{k}.7.{k * 3}.9", 1) for k in range(10, 30)] + [(f"ab.{k}@mail{k}.example.com", 0) for k in range(12)]
    none = [("135299847", "=", "a", []), ("4.0", " ", "."), ("89450 874088", "a", "f", []), ("2024", " ", ","), ("20240101 555-1234", " ", " ", [])]
    return pii.learned([(s, " ", after, [(0, k, len(s))]) for s, k in found for after in (" ", ".", "#")] + [(*x, []) if len(x) == 3 else x for x in none])


def test_base_spans_against_patterns():
    r = random.Random(4)
    for alphabet in ("a1.@- +", "0123456789 -", "+0123456789 ().-", "255.01 ", "a@b.c-_é\n"):
        for _ in range(3000):
            text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
            assert pii.base_spans(text) == plain_spans(text), text
    for text in (f"x {CARD[:4]}-{CARD[4:8]} {CARD[8:]}, {PHONE}. a.b+c@d-e.f.gh..i 1.2.3.4.5.6.7.8 1.2.3.256", "١٢٣.1.1.1 +１２３４５６７８９"):
        assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1 " * 200_000, "a" * 300_000 + "@", "a@" * 100_000, "1." * 150_000, "+1" + " (" * 150_000, "+" * 300_000, "a." * 150_000 + "1"):
        began = time.time()
        base = pii.base_spans(text)
        pii.islands(text, base)
        assert time.time() - began < 3, text[:4]


def _readings(island):
    """All ways to cover an island's tokens by candidates of any kind, fixed spans and single tokens."""
    n, fixed_at = len(island.tokens), {k for (i, j) in island.fixed for k in range(i, j)}
    steps = [(k, k + 1, 0) for k in range(n) if k not in fixed_at] + [(i, j, k + 1) for (i, j), k in island.fixed.items()] + [(i, j, k + 1) for i, j in island.candidates for k in range(4)]

    def go(at):
        if at == n:
            yield ()
        for i, j, y in steps:
            if i == at:
                for rest in go(j):
                    yield ((i, j, y), *rest)

    return go(0)


def _score(field, island, reading):
    own, outside = field.scores(island)
    at, x, s = {c: k for k, c in enumerate(island.candidates)}, 0, 0.0
    for i, j, y in reading:
        s += field.t[x, y] + (outside[i] if not y else 0.0 if (i, j) in island.fixed else own[at[i, j]][y - 1])
        x = y
    return s


@pytest.mark.parametrize("text,spans", [("4465 758 382-88", ()), ("+12 345", ()), ("a@b.c 12345", ()), ("1234 5.6.7.8 91011", ((5, 1, 12),))])
def test_best_and_likelihood_against_all_readings(text, spans):
    island = pii.Island(text, " ", "x", spans)
    names = sorted({x for f in island.seen for x in f} | {f"outside {pii._token_class(t)}" for t in island.tokens})
    field, r = pii.Field({x: k for k, x in enumerate(names)}), np.random.default_rng(len(text))
    field.w[:-1], field.t = r.normal(size=field.w[:-1].shape), r.normal(size=field.t.shape)
    readings = list(_readings(island))
    scores = np.array([_score(field, island, x) for x in readings])
    best = readings[int(scores.argmax())]
    assert field.best(island) == [(i, y - 1, j) for i, j, y in best if y]
    for x in r.permutation(len(readings))[:5].tolist():
        if spans and not any((i, j) in island.fixed for i, j, _ in readings[x]):
            continue
        kinds = {(i, j): y - 1 for i, j, y in readings[x] if y}
        likely, dw, dt = field.gradient(island, kinds)
        if not spans:
            assert likely == pytest.approx(scores[x] - np.logaddexp.reduce(scores))
        for weights, step in ((field.w, dw), (field.t, dt)):
            for place in itertools.islice(zip(*np.nonzero(step)), 6):
                weights[place] += 1e-5
                higher = field.gradient(island, kinds)[0]
                weights[place] -= 1e-5
                assert (higher - likely) / 1e-5 == pytest.approx(step[place], abs=1e-3)


def test_neighbours_are_told_apart(field):
    for text, expected in (
        (f"to {PHONE} {CARD} and", [PHONE, CARD]),
        (f"to {CARD} {OTHER} and", [CARD, OTHER] if pii.luhn(OTHER) else [CARD]),
        (f"on 1.2.3.4 {CARD}, then", [CARD]),
        ("password=135299847ac0e0f0dc CC BY-NC 4.0. 20240101", []),
        (f"call {PHONE}. Mail a.b@c.example.com", []),
    ):
        base = pii.base_spans(text)
        found = [text[a:b] for a, _, b in pii.added_spans(text, base, field)]
        assert [x for x in found if x in expected] == expected and set(found) <= set(expected), text


def test_islands_without_anything_loose():
    text = f"a 1.2.3.4 {PHONE} b x@y.zz, 17"
    base = pii.base_spans(text)
    assert [text[a:b] for a, b in pii.islands(text, base)] == ["x@y.zz, 17"] and len(pii.islands(text, [])) == 2


def test_query_keeps_the_base(spark):
    got = {r.doc_id: r for r in queries.op11_personal_data(spark, SMALL).collect()}
    docs = {r.doc_id: r.text for r in read_table(spark, SMALL, "documents").select("doc_id", "text").collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        base, r = plain_spans(text), got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, k, _ in base) for x in range(4))
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert {s for s in joined(base).split(",") if s} <= {":".join(s) for s in spans} and len(spans) == len(base) + r.n_added
        for kind, a, b in spans:
            assert pii.plausible(pii.KINDS.index(kind), text[int(a) : int(b)])


def test_query_finds_planted_neighbours(spark, tmp_path):
    r = random.Random(2)
    number = lambda: next(c for c in (f"4{r.randrange(10**15):015d}" for _ in range(999)) if pii.luhn(c))
    phone = lambda: f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(10**4):04d}"
    make = (number, phone, lambda: f"{r.randrange(1, 255)}.{r.randrange(255)}.7.9", lambda: f"ab.{r.randrange(99)}@mail.example.com")
    alone = [(k, f"words é before {make[k % 4]()} and after") for k in range(400)]
    pairs = [(1000 + k, f"{phone()} {number()}") for k in range(20)]
    clean = [(2000 + k, f"version {k}.0, of {1900 + k} in {k} parts, id {r.randrange(10**9):09x}e") for k in range(200)]
    edge = [(None, "1.2.3.4"), (7000, None), (7000, ""), (7001, "x " * 200_000 + "1.2.3.4")]
    df = spark.createDataFrame([(i, t, "x") for i, t in alone + pairs + clean + edge], "doc_id long, text string, spans string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(x.doc_id, x.spans): x for x in queries.op11_personal_data(spark, str(tmp_path)).collect()}
    by_id = {i: x for (i, _), x in got.items()}
    assert all(by_id[i].spans == joined([(0, 3, 17), (18, 2, 34)]) for i, _ in pairs)
    assert all(by_id[i].spans == "" for i, _ in clean) and all(by_id[i].n_added == 0 for i, _ in alone)
    assert by_id[None].spans == "ip:0:7" and by_id[7001].spans == "ip:400000:400007" and by_id[7000].spans == ""
    assert pii.personal_data(df.limit(0), pii.fit(df.limit(0))).count() == 0

import pyarrow as pa
import pytest

from tests.test_frequent import ODD, counted, documents
from wordloom.operators import blocks, frequent, transitions

LANGUAGES = [(i, f"l{i}", t) for i, (_, _, t) in enumerate(ODD * 9)]


@pytest.mark.parametrize("rows", [ODD, ODD[1:], LANGUAGES[:40], LANGUAGES])
def test_grams_of_blocks(spark, rows):
    docs = documents(spark, rows)
    for sizes in ((1,), (2, 3)):
        want = sorted(x for n in sizes for x in counted(rows, n))
        assert sorted(map(tuple, transitions.gram_evidence(docs, "doc_id", "lang", sizes).collect())) == want
    marked = frequent.marks(docs, (2, 3), 3)
    got = {r.gram: tuple(r) for r in transitions.gram_evidence(docs, "doc_id", "lang", (2, 3), marked).collect()}
    assert all(got[x[0]] == x for n in (2, 3) for x in counted(rows, n) if x[1] >= 3)


def test_blocks_hold_each_row_once(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 5)
    rows = [["a"] * n if n is not None else None for n in (3, None, 2, 1, 9, 0, 4, 2)]
    batches = [pa.record_batch([pa.array(rows[a:b], pa.list_(pa.string()))], names=["w"]) for a, b in ((0, 3), (3, 3), (3, 8))]
    got = [b.column(0).to_pylist() for b in blocks._blocks(iter(batches))]
    assert [r for b in got for r in b] == rows and all(sum(len(r or []) for r in b) <= 5 or sum(bool(r) for r in b) == 1 for b in got)


def test_grams_of_any_size(spark):
    words = [f"w{i * i % 97}" for i in range(3_000)]
    docs = spark.createDataFrame([(1, "a", words)], "doc_id long, lang string, words array<string>")
    want = {"|".join(words[i : i + 7]) for i in range(len(words) - 6)}
    assert {r.gram for r in transitions.gram_evidence(docs, "doc_id", "lang", (7,)).collect()} == want

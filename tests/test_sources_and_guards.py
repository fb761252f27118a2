import itertools
import math

import pytest
from pyspark.sql import functions as F

from wordloom.functions import keys, syllables
from wordloom.operators import completion, lexicon, segmentation, transitions, validation
from wordloom.sources import readers


def got(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_syllables():
    table = frozenset(["xi", "an", "xian", "ni", "hao", "fang", "gan", "fan"])
    assert syllables.parse("nihao", table) == ["ni", "hao"]
    assert syllables.parse("xian", table) == ["xian"]
    assert syllables.parse("xi'an", table) == ["xi", "an"]
    assert syllables.parse("fangan", table) == ["fang", "an"]
    assert syllables.parse("zz", table) is None and syllables.parse("", table) is None


def test_remote_answers_are_kept_for_their_parameters(tmp_path, spark):
    asked = []

    def fetch(p):
        asked.append(p)
        return ['{"results":{"bindings":[{"name":{"value":"a"},"links":{"value":"7"}},{"name":{"value":"b"},"links":{"value":"x"}}]}}']

    path = str(tmp_path / "cache.json")
    for limit in (5, 5, 6, 6):
        pages = readers.cached(path, {"limit": limit}, fetch)
    assert [p["limit"] for p in asked] == [5, 6]
    df = spark.createDataFrame([(p,) for p in [*pages, "no json"]], "page string")
    assert got(readers.bindings(df, ["name"], ["links"]), "name", "links") == [("a", 7), ("b", 0)]


def test_pinned_file_must_have_its_digest(spark):
    files = spark.createDataFrame([("p", b"word  3\r\nnone\r\n")], "path string, content binary")
    with pytest.raises(Exception, match="wrong digest"):
        readers.pinned(files, "0" * 64).collect()


def test_compressed_documents(spark, tmp_path):
    import gzip

    import zstandard

    raw = b'{"text": "a", "source": "s", "id": "1"}\n{"content": "b"}\nbad\n'
    (tmp_path / "x.jsonl.gz").write_bytes(gzip.compress(raw))
    (tmp_path / "y.jsonl").write_bytes(raw)
    assert got(readers.json_documents(spark, str(tmp_path)), "source", "text") == [("s", "a"), ("s", "a"), ("x", "b"), ("y", "b")]
    assert zstandard.ZstdDecompressor().decompress(zstandard.ZstdCompressor().compress(raw)) == raw


def test_layers(spark):
    read = lambda m: spark.createDataFrame([(m["id"] * 2,)], "text string")
    out = readers.layers([{"id": "a", "vertical_layer_id": 3}, {"id": "b"}, {"id": "c", "vertical_layer_id": 1}], read)
    assert got(out, "text", "source", "layer") == [("aa", "a", 3), ("cc", "c", 1)]


def test_files_and_characters(spark):
    assert validation.files(["a", "x/b.zip"], ["a", "c"], ["*.zip"]) == [("missing", "c"), ("forbidden", "x/b.zip")]
    a, b = spark.createDataFrame([("abc",), ("c",)], "text string"), spark.createDataFrame([("bx",)], "text string")
    assert got(lexicon.only_characters(a, b), "char") == [("a",), ("c",)]


def test_bound_syllables_and_specialists_take_no_place(spark):
    lex = spark.createDataFrame([("hua", "A", 9), ("huar", "Ab", 8), ("huas", "C", 7), ("hut", "D", 6)], "reading string, text string, weight int")
    out = completion.prefix_top(lex, specialist=spark.createDataFrame([("D",)], "text string"), bound="r")
    assert {r.text for r in out.collect()} == {"A", "C"}


def test_guards_of_pairs(spark):
    lex = spark.createDataFrame([("xx", "zz", 5), ("ab", "abc", 95), ("q", "bad", 1)], "reading string, text string, n int")
    rows = [("a", "b", "ab", 100, 9, 5, 5), ("k", "m", "km", 50, 9, 5, 5), ("k", "n", "km", 30, 9, 5, 5), ("k", "o", "km", 20, 9, 5, 5), ("z", "z", "zz", 50, 9, 5, 5), ("u", "v", "uv", 50, 3, 5, 5), ("u", "w", "uw", 50, 9, 1, 5), ("u", "bad", "ub", 50, 9, 5, 5)]
    pairs = spark.createDataFrame(rows, "left string, right string, reading string, n int, sources int, lefts int, rights int")
    out = transitions.guarded_pairs(pairs, lex, lex.where("text = 'bad'").select("text"))
    assert got(out, "left", "right", "k") == [("k", "m", 1), ("k", "n", 2)]


def test_nbest_priors_against_brute_force(spark):
    words = {"ab": 9, "bc": 8, "abc": 1}
    lex, text, n = segmentation.Lexicon(words), "abcb", 3
    found = []
    for cut in itertools.product([0, 1], repeat=len(text) - 1):
        parts, p = [], 0
        for i, c in enumerate([*cut, 1], 1):
            if c:
                parts.append(text[p:i])
                p = i
        if all(len(x) == 1 or x in words for x in parts):
            found.append((sum(lex.cost[x] if len(x) > 1 else lex.char_cost.get(x, lex.unknown) for x in parts), parts))
    best = max(s for s, _ in found)
    near = sorted(((s, p) for s, p in found if s >= best - 3.0), reverse=True)[:4]
    total = sum(math.exp(s - best) for s, _ in near)
    want = {}
    for s, p in near:
        for a, b in zip(p, p[1:]):
            want[f"{a}|{b}"] = want.get(f"{a}|{b}", 0) + n * math.exp(s - best) / total
    stretches = spark.createDataFrame([(text, n)], "stretch string, n int")
    cut = segmentation.segmented(stretches, words, mode="nearest").join(stretches, "stretch")
    out = {r.path: r.weight for r in transitions.nbest_priors(cut.select("stretch", F.col("n"), "score", "pieces")).collect()}
    assert out.keys() == want.keys() and all(math.isclose(out[k], want[k], rel_tol=1e-9) for k in want)


def test_scans_of_few_files_are_dealt_and_others_are_not(spark, tmp_path):
    rows = spark.range(0, 300_000, numPartitions=1).selectExpr("id", "sha2(cast(id AS string), 256) AS text")
    rows.write.parquet(f"{tmp_path}/one")
    rows.repartition(16).write.parquet(f"{tmp_path}/many")
    rows.limit(5).write.parquet(f"{tmp_path}/small")
    rows.limit(0).write.parquet(f"{tmp_path}/none")
    plan = lambda name, **k: readers.columnar(spark, f"{tmp_path}/{name}", **k)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan("one")
    assert all("Repartition" not in p for p in (plan("one", most=2 << 20), plan("many"), plan("small"), plan("none")))
    assert sorted(r.id for r in readers.columnar(spark, f"{tmp_path}/one").select("id").collect()) == list(range(300_000))


def test_repetition_is_that_of_a_plain_count(spark):
    import random

    rng = random.Random(3)
    texts = ["", "a", "aaaaaaaa", "ab" * 4, "aaaaabbb", "bbbaaaaa", "aaaabbbb", "\U0001f600" * 9 + "ab", None] + ["".join(rng.choice("aaab c\U00020000") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", keys.repetitive(F.col("t")).alias("r")).collect()
    assert len(got) == len(texts)
    for t, r in got:
        assert r == (None if t is None else len(t) >= 8 and max(map(t.count, set(t))) * 100 >= 55 * len(t)), t
    with pytest.raises(ValueError):
        keys.repetitive(F.col("t"), percent=50)

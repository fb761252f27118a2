import itertools
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from wordloom.functions import keys
from wordloom.operators import admission, curation, evaluation, fragments, lexicon, patterns, segmentation, single_char, transitions, validation, variants
from wordloom.sources import readers, writers
from wordloom.streaming import incremental


def got(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_keys(spark):
    df = spark.createDataFrame([(" Lu’An　",), ("Zha1",)], "r string")
    assert got(df, keys.exact_key(F.col("r")), keys.compact_key(F.col("r")), keys.lookup_key(F.col("r"))) == [("lu'an", "luan", "lu'an"), ("zha", "zha", "zha")]


def test_record_text(spark):
    values = ['{"text":"a"}', '{"content":"b"}', json.dumps({"messages": [{"role": "u", "content": "c"}, {"role": "a", "content": "d"}]}), "not json"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(keys.record_text(F.col("v"))).collect()] == [["a"], ["b"], ["c", "d"], []]


def test_gate(spark):
    df = spark.createDataFrame([(430, 4, 2, 1), (520, 20, 7, 2), (500, 2, 2, 1)], "w int, n long, s long, d long")
    out = [r[0] for r in df.select(keys.gated_evidence(F.col("w"), F.col("n"), F.col("s"), F.col("d"))).collect()]
    assert out == [430 + round(12 * math.log2(5)) + 8 + 12, 520 + round(12 * math.log2(21)) + 28 + 24, None]


def test_chunks(spark):
    p = keys.CJK
    text = "".join(chr(0x4E00 + i) for i in range(90))
    out = got(fragments.chunks(spark.createDataFrame([(1, "meta1" + text + "。" + "好" * 10)], "id int, text string"), p, ["id"]), "part", "chunk")
    assert out == [(k, text[a : a + 40]) for k, a in enumerate(range(0, 87, 36))]


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("ti'gao\tX Y\t7\ntigao\tXY\t5\tno_contains\n", encoding="utf-8")
    assert got(readers.dictionary_strict(spark, str(tmp_path / "d.tsv")), "key", "text", "weight") == [("ti'gao", "X Y", 7), ("tigao", "XY", 5)]
    (tmp_path / "bad.tsv").write_text("a\tX\tseven\n", encoding="utf-8")
    with pytest.raises(Exception, match="invalid weight"):
        readers.dictionary_strict(spark, str(tmp_path / "bad.tsv")).collect()
    (tmp_path / "l.tsv").write_text("a'b\tXY\t7\nab\tXY\t9\na'c\tXY\tx\n#\n", encoding="utf-8")
    assert got(readers.dictionary_lenient(spark, str(tmp_path / "l.tsv")), "text", "syllables") == [("XY", ["a", "b"])]


def test_corpora(spark, tmp_path):
    for name, lines in {"a/train.jsonl": ['{"text":"x"}', "bad"], "a/validation.jsonl": ['{"text":"no"}'], "a/t.txt": ["y"]}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("\n".join(lines), encoding="utf-8")
    assert got(readers.json_corpus(spark, str(tmp_path)), "domain", "text") == [("train", "x")]
    assert got(readers.text_corpus(spark, str(tmp_path)), "source", "domain", "text") == [("a/t.txt", "a", "y")]


def test_within_budget(spark):
    df = spark.createDataFrame([("s", i, "abc") for i in range(5)], "source string, ord int, text string")
    assert got(readers.within_budget(df, 8), "ord") == [(0,), (1,)]


def test_keep_order_and_report():
    assert writers.refreshed("| rows | 5 | x |\n", "rows", "6") == "| rows | 6 | x |\n"
    with pytest.raises(ValueError):
        writers.refreshed("none", "rows", "6")


def test_regressions(spark):
    lex = spark.createDataFrame([("zha", "a", 5), ("zha", "b", 4), ("zha", "c", 3)], "reading string, text string, weight int")
    s = spark.createDataFrame([("zha", "c", False, 2), ("zha", "b", True, 9), ("zha", "q", False, 9), ("wo", "q", False, 9), ("zha", "a", False, 1)], "reading string, text string, forbidden boolean, max_rank int")
    assert got(lexicon.regressions(lex, s), "text", "problem") == [("b", "forbidden_present"), ("c", "rank_exceeded"), ("q", "missing"), ("q", "no_candidates")]


def paths_frame(spark, rows):
    return spark.createDataFrame(rows, "words array<string>, syl array<array<string>>, evidence int, source_count int")


def test_completions_limits_and_segmentations(spark):
    rows = [(["A", f"s{i:02}"], [["a"], ["s"]], 800 - i, 1) for i in range(32)]
    rows += [(["B", "long"], [["b"], list("abcdefg")], 900, 1), (["C", "xy"], [["c"], ["x", "y"]], 720, 1), (["C", "x", "y"], [["c"], ["x"], ["y"]], 640, 1)]
    out = got(transitions.completions(paths_frame(spark, rows), 24), F.concat_ws("|", "anchor"), F.concat_ws("|", "suffix"), "evidence")
    assert [r[2] for r in out if r[0] == "A"] == [800 - i for i in range(24)]
    assert not [r for r in out if r[0] == "B"]
    assert [r for r in out if r[0] == "C"] == [("C", "xy", 720)]


def test_four_words_cut_before_reading_check(spark):
    left = [(["a", "b", "c"], [["1"], ["2"], ["3"]], 700 + i, 1) for i in range(1)]
    right = [(["b", "c", f"d{i}"], [["2"], ["9"], ["4"]], 900 - i, 1) for i in range(6)] + [(["b", "c", "e"], [["2"], ["3"], ["5"]], 600, 1)]
    assert transitions.four_words(paths_frame(spark, left + right)).count() == 0  # the only fitting row is seventh
    assert transitions.four_words(paths_frame(spark, left + right[5:])).count() == 1


def test_next_lines(spark):
    df = spark.createDataFrame([("ab", ",", "cd", "x'y")], "line string, mark string, next string, reading string")
    assert got(transitions.next_lines(df), "evidence", "sources") == [(900, 9)]
    with pytest.raises(Exception, match="reading does not match"):
        transitions.next_lines(df.withColumn("reading", F.lit("x"))).collect()


def test_log_sum_exp_follows_the_total(spark):
    df = spark.createDataFrame([("g", 1, -3000, "a"), ("g", 2, -2500, "b"), ("g", 3, -2400, "c")], "gram string, ord int, score int, backoff string")
    total, back = -3000, "a"
    for s, b in ((-2500, "b"), (-2400, "c")):
        back = b if s > total else back
        total = round(1000 * math.log(math.exp(total / 1000) + math.exp(s / 1000)))
    assert got(variants.log_sum_exp(df), "score", "backoff") == [(total, back)]


def test_twins_and_backfill(spark):
    lex = spark.createDataFrame([("r", "old", 9), ("r", "new", 3)], "reading string, text string, weight int")
    pairs = spark.createDataFrame([("old", "new")], "variant string, target string")
    assert got(variants.raised_twins(lex, pairs), "text", "weight") == [("new", 9), ("old", 1)]
    assert got(variants.backfilled(lex, lex, F.lit("new")), "text", "weight", "twin") == [("new", 9, True), ("old", 9, True)]


def test_phrases_before_characters(spark):
    f = variants.phrase_converter({"ab": "X", "abc": "Y"}, {"a": "1"})
    assert got(spark.createDataFrame([("abcaab",), (None,)], "t string").where("t IS NOT NULL"), f(F.col("t"))) == [("Y1X",)]


def test_curation_is_idempotent(spark):
    lex = spark.createDataFrame([("a", "xy", 500), ("b", "z", 300)], "reading string, text string, weight int")
    rows = spark.createDataFrame([("a", "xy", 0.347), ("c", "new", -1.99), ("b", "z", -2.0)], "reading string, text string, score double")
    once = curation.force(lex, rows)
    assert got(once, "text", "weight") == [("new", 1), ("xy", 347), ("z", 0)] == got(curation.force(once, rows), "text", "weight")
    over = spark.createDataFrame([("xy", "q"), ("z", "q")], "text string, reading string")
    moved = curation.overridden(lex, over)
    assert got(moved, "reading", "text") == [("b", "z"), ("q", "xy"), ("q", "z")]
    assert got(curation.overridden(moved, over), "reading", "text", "weight") == got(moved, "reading", "text", "weight")
    alias = spark.createDataFrame([("z", "n", "b"), ("xy", "a", "a")], "text string, reading string, from_reading string")
    assert got(curation.aliased(lex, alias, 200), "reading", "text", "weight") == [("a", "xy", 500), ("b", "z", 300), ("n", "z", 200)]
    terms = spark.createDataFrame([("xy",), ("z",)], "text string")
    assert got(curation.excluded(lex, terms), "text") == [("z",)]
    assert got(curation.restored(lex.where("text='z'"), lex, terms), "text") == [("z",)]


def test_bad_specialist_row_fails(spark):
    df = spark.createDataFrame([("a", "b", 0.8, "x")], "sc string, tc string, usage double, reading string")
    with pytest.raises(Exception, match="usage"):
        curation.checked(df).collect()


def test_segmentation_against_brute_force():
    r = random.Random(4)
    for _ in range(300):
        words = {"".join(r.choice("abc") for _ in range(r.randint(2, 4))): r.randint(1, 50) for _ in range(6)}
        lex = segmentation.Lexicon(words, {"a": 3})
        text = "".join(r.choice("abc") for _ in range(r.randint(1, 9)))
        best = None
        for cut in itertools.product([0, 1], repeat=len(text) - 1):
            parts, p = [], 0
            for i, c in enumerate([*cut, 1], 1):
                if c:
                    parts.append(text[p:i])
                    p = i
            if all(len(x) == 1 or x in words for x in parts):
                score = sum(lex.cost[x] if len(x) > 1 else lex.char_cost.get(x, lex.unknown) for x in parts)
                best = score if best is None else max(best, score)
        cost = lambda parts: sum(lex.cost[x] if len(x) > 1 else lex.char_cost.get(x, lex.unknown) for x in parts)
        assert math.isclose(cost(lex.likeliest(text)), best)
        assert math.isclose(lex.nearest(text, 3, 5.0)[0][0], best)
        assert "".join(lex.greedy(text)) == text


def test_pattern_scans_agree(spark):
    t = spark.createDataFrame([("aaaa b", "s1", "d1"), ("xaab" * 200, "s2", "d1"), ("", "s3", "d2")], "text string, source string, domain string")
    p = spark.createDataFrame([("aa",), ("aab",), ("zz",)], "pattern string")
    want = [("aa", 203, 2, 1), ("aab", 200, 1, 1), ("zz", 0, 0, 0)]
    cols = ("pattern", "n", "sources", "domains")
    assert got(patterns.support_joined(t, p, piece=7), *cols) == want == got(patterns.support_scanned(t, p), *cols)


def test_single_characters(spark):
    rows = spark.createDataFrame([("r", "a", 500, 1), ("r", "b", 400, 2), ("q", "b", 350, 3), ("r", "c", 300, 4)], "reading string, char string, weight int, ord int")
    use = spark.createDataFrame([("a", 1.0), ("b", 9.0), ("c", 5.0)], "char string, rate double")
    assert got(single_char.redistributed(rows, use), "reading", "char", "weight") == [("q", "b", 350), ("r", "a", 300), ("r", "b", 400), ("r", "c", 500)]
    order = spark.createDataFrame([("r", "c", "a", 10)], "reading string, char string, other string, margin int")
    up = single_char.raised_over(rows.select("reading", "char", "weight"), order)
    assert got(up, "char", "weight") == [("a", 500), ("b", 350), ("b", 400), ("c", 510)]
    assert validation.order_kept(up, order).count() == 0
    est = spark.createDataFrame([("r", "a", 3.0), ("r", "b", 2.0), ("r", "c", 1.0)], "reading string, char string, rate double")
    s = spark.createDataFrame([("r", "c", 1)], "reading string, char string, max_rank int")
    assert [r[1] for r in sorted(((-r.rate, r.char) for r in single_char.lifted(est, s).collect()))] == ["c", "a", "b"]
    forms = spark.createDataFrame([("r", "a", "c", 1.0), ("r", "c", "c", 5.0)], "reading string, char string, leader string, estimate double")
    assert dict(got(single_char.led(rows.where("reading='r'"), forms), "char", "weight")) == {"a": 450, "b": 400, "c": 500}


def test_admission_first_reason_wins(spark):
    r = admission.Rules(shape=".{3,}", errors=("thx",), fragment_starts=("th",))
    df = spark.createDataFrame([("ab",), ("thx",), ("the",), ("fine",)], "t string")
    assert [x[0] for x in df.select(admission.reason(F.col("t"), F.lit("c"), r)).collect()] == ["length_or_script", "source_error", "fragment", ""]


def test_validators(spark):
    df = spark.createDataFrame([("ta", "ta'b", "XY", "X|Y", 5), ("tab", "ta'b", "XY", "X|Y", 5), ("ta", "ta'b", "XZ", "X|Y", 0)], "prefix string, reading string, text string, path string, evidence int")
    assert sorted(r.rule for r in validation.transition_completion(df).collect()) == ["evidence", "not_unique", "not_unique", "path", "prefix"]


def test_pair_audit_and_domains(spark):
    ev = spark.createDataFrame([("", "p", "b", "c", "c")] * 3 + [("x", "p", "b", "c", "b")], "before string, prefix string, baseline string, challenger string, chosen string")
    assert got(evaluation.pair_audit(ev), "width", "context", "keep", "switch", "decision") == [(0, "", 1, 3, 0), (1, "x", 1, 0, 0)]
    g = spark.createDataFrame([("d", "a", "b", "a"), ("d", "a", "a", "b"), ("d", "a", "a", "a")], "domain string, wanted string, current string, output string")
    assert got(evaluation.by_domain(g), "groups", "rescues", "regressions", "net", "switches") == [(3, 1, 1, 0, 2)]


def test_streaming_counts_survive_a_second_run(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.createDataFrame([("a b a",)], "text string").write.parquet(src)
    schema = spark.read.parquet(src).schema
    for more in (None, "b c"):
        if more:
            spark.createDataFrame([(more,)], "text string").write.mode("append").parquet(src)
        incremental.count_words(spark, src, schema, out, cp).awaitTermination()
    assert got(incremental.total(spark, out), "word", "n") == [("a", 2), ("b", 2), ("c", 1)]

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from wordloom.functions import generators, syllables
from wordloom.operators import segmentation, variants
from wordloom.sources import publishing


def plain_conversion(text, phrases, chars):
    out, spans, i, most = [], [], 0, max(map(len, phrases), default=1)
    while i < len(text):
        n = next((n for n in range(min(most, len(text) - i), 0, -1) if text[i : i + n] in phrases), 0)
        if n:
            spans.append((i, n, phrases[text[i : i + n]]))
        out.append(phrases[text[i : i + n]] if n else chars.get(text[i], text[i]))
        i += n or 1
    return "".join(out), spans


@pytest.mark.parametrize("seed", range(3))
def test_longest_phrases_come_first(spark, seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abc日") for _ in range(n))
    phrases, chars = {word(r.randint(1, 5)): word(2).upper() for _ in range(25)}, {"a": "ä", "日": ""}
    texts = [word(r.randint(0, 40)) for _ in range(300)]
    df = spark.createDataFrame([(t, 1) for t in texts] + [(None, 2)], "t string, converted_before int")
    out = variants.phrase_first(df, "t", spark.createDataFrame(list(phrases.items()), "form string, target string"), chars)
    got = [(x.t, x.converted, [tuple(s) for s in x.spans]) for x in out.collect()]
    assert sorted(x for x in got if x[0] is not None) == sorted((t, *plain_conversion(t, phrases, chars)) for t in texts)
    assert (None, None, []) in got


def test_longer_phrases_win_over_those_inside(spark):
    phrases = spark.createDataFrame([("巨细", "鉅細"), ("巨细胞", "巨細胞")], "form string, target string")
    df = spark.createDataFrame([("巨细胞病毒",), ("事无巨细",)], "t string")
    assert {r.t: r.converted for r in variants.phrase_first(df, "t", phrases, {"无": "無"}).collect()} == {"巨细胞病毒": "巨細胞病毒", "事无巨细": "事無鉅細"}


def test_a_hundred_thousand_phrases(spark):
    phrases = spark.range(100_000).selectExpr("concat('p', id) AS form", "concat('<', id, '>') AS target")
    df = spark.range(50).selectExpr("concat_ws(' ', 'p', concat('p', id), concat('p', id * 2000, 'x'), 'q') AS t")
    got = {x.t: x.converted for x in variants.phrase_first(df, "t", phrases, {"q": "Q"}).collect()}
    assert got == {f"p p{k} p{k * 2000}x q": f"p <{k}> <{k * 2000}>x Q" for k in range(50)}
    with pytest.raises(ValueError):
        variants.phrase_first(df, "t", phrases, {}, most=10)
    assert variants.phrase_first(df, "t", phrases.limit(0), {}).where("converted = t").count() == 50


def test_syllables_and_their_ambiguity(spark):
    table = ["a", "xi", "an", "xian", "i", "na", "n"]
    readings = ["xian", "xi'an", "xianan", "q", "", "'", "anan", "x'ian", *("".join(p) for k in (3, 5) for p in itertools.islice(itertools.product("xian", repeat=k), 0, 400, 7))]
    known = frozenset(table)

    def every(part):
        if not part:
            yield ()
        for k in range(1, len(part) + 1):
            if part[:k] in known:
                for rest in every(part[k:]):
                    yield (part[:k], *rest)

    df = spark.createDataFrame([(r,) for r in readings] + [(None,)], "r string").withColumn("p", syllables.parsed(F.col("r"), table))
    for r, p in df.collect():
        if r is None:
            assert p is None or p.syllables is None
            continue
        whole = [sum(x, ()) for x in itertools.product(*(list(every(part)) if part else [] for part in r.split("'")))]
        least = min(map(len, whole), default=0)
        best = [x for x in whole if len(x) == least]
        assert (p.ways, p.fewest) == (len(whole), len(best)), r
        assert p.syllables == (list(max(best, key=lambda x: [len(s) for s in x])) if best else None), r


def test_generators_in_sql(spark):
    generators.register(spark, {"ab": 5, "abc": 1})
    spark.createDataFrame([(1, "abxxcab"), (2, None), (3, "")], "i int, t string").createOrReplaceTempView("generated")
    got = lambda sql: sorted(tuple(r) for r in spark.sql(sql).collect())
    assert got("SELECT i, s.* FROM generated, LATERAL stretches(t, 'ab') s") == [(1, 0, "ab"), (1, 5, "ab")]
    assert got("SELECT i, f.* FROM generated, LATERAL fragments(t, 2, 4, 1) f") == [(1, 0, "abxx"), (1, 1, "xcab")]
    rows = got("SELECT i, n.* FROM generated, LATERAL segmentations(t, 2, 100.0D) n")
    want = segmentation.Lexicon({"ab": 5, "abc": 1}).nearest("abxxcab", 2, 100.0)
    assert [(r[1], round(r[2], 6), r[3]) for r in rows] == [(k, round(s, 6), p) for k, (s, p) in enumerate(want, 1)]


def test_versions_are_replaced_as_a_whole(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(10).withColumn("w", F.col("id") % 3)
    with pytest.raises(FileNotFoundError):
        publishing.read(spark, path)
    assert publishing.publish(df, path) and publishing.read(spark, path).count() == 10
    first = publishing.current(spark, path)
    # a check that finds rows, and a job that fails, leave the version before
    with pytest.raises(publishing.NotPublished, match="order"):
        publishing.publish(spark.range(20).withColumn("w", F.col("id")), path, {"none": lambda new: new.where("id < 0"), "order": lambda new: new.where("w > 18")})
    with pytest.raises(Exception, match="broken"):
        publishing.publish(spark.range(20).withColumn("w", F.when(F.col("id") < 19, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long"))), path)
    assert publishing.current(spark, path) == first and publishing.read(spark, path).count() == 10
    reader = publishing.read(spark, path)
    assert not publishing.publish(df.orderBy(F.desc("id")), path, if_changed=True) and publishing.current(spark, path) == first
    assert publishing.publish(df.where("id > 4"), path, if_changed=True) and publishing.read(spark, path).count() == 5
    assert reader.count() == 10  # who reads the old version reads on
    assert publishing.tidied(spark, path) == 4 and len(os.listdir(f"{path}/versions")) == 1 and publishing.read(spark, path).count() == 5

import random

import pytest
from pyspark.sql import functions as F

from wordloom.operators import patterns


def brute(texts, wanted):
    out = {}
    for p in set(wanted):
        hits = [(s, d) for t, s, d in texts for i in range(len(t or "") - len(p) + 1) if t[i : i + len(p)] == p]
        out[p] = (min(len(hits), 1_000_000), min(255, len({s for s, _ in hits if s is not None})), len({d for _, d in hits if d is not None}))
    return out


def got(df):
    return {r.pattern: (r.n, r.sources, r.domains) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_anchored_against_brute_force(spark, seed):
    r = random.Random(seed)
    abc = ("ab", "abcdé日\U00020000", "a", "abc ")[seed]
    word = lambda n: "".join(r.choice(abc) for _ in range(n))
    texts = [(word(r.choice([0, 1, 5, 40, 300])), f"s{r.randint(0, 9)}", r.choice([None, "x", "y"])) for _ in range(60)] + [(None, "s", "x"), ("", None, "y")]
    wanted = [word(r.choice([1, 1, 2, 3, 4, 7, 8, 9, 17, 40])) for _ in range(80)] + [texts[0][0][3:30] or "a", "never", texts[5][0] or "b"]
    df = spark.createDataFrame(texts, "text string, source string, domain string").repartition(3)
    p = spark.createDataFrame([(w,) for w in wanted], "pattern string")
    assert got(patterns.support_anchored(df, p)) == brute(texts, wanted)


def test_anchored_equals_the_scan_for_many_patterns(spark):
    texts = spark.range(3000).selectExpr("sha2(cast(id AS string), 512) AS text", "cast(id % 500 AS string) AS source", "cast(id % 3 AS string) AS domain")
    p = spark.range(30_000).selectExpr("substring(sha2(cast(id % 6000 AS string), 512), cast(id % 100 AS int) + 1, 5 + cast(id % 7 AS int)) AS pattern")
    assert got(patterns.support_anchored(texts, p)) == got(patterns.support_scanned(texts, p))


def test_anchored_edges(spark):
    texts = spark.createDataFrame([("abc", "s", "d")], "text string, source string, domain string")
    none = spark.createDataFrame([], "pattern string")
    assert patterns.support_anchored(texts, none).count() == 0
    p = spark.createDataFrame([("bc",), ("bc",), ("x" * 3000,), (None,), ("",)], "pattern string")
    assert got(patterns.support_anchored(texts, p)) == {"bc": (1, 1, 1), "x" * 3000: (0, 0, 0)}
    assert got(patterns.support_anchored(texts.limit(0), p))["bc"] == (0, 0, 0)


def test_the_anchor_is_the_rarest_stretch(spark):
    """Only what stands around rare stretches travels: here 50 places of 100,000."""
    texts = spark.range(1000).select(F.concat(F.lit("a" * 100), F.when(F.col("id") % 20 == 0, "zq")).alias("text"), F.lit("s").alias("source"), F.lit("d").alias("domain"))
    texts = texts.withColumn("text", F.coalesce("text", F.lit("a" * 100)))
    p = spark.createDataFrame([("a" * 12 + "zq",)], "pattern string")
    assert got(patterns.support_anchored(texts, p)) == {"a" * 12 + "zq": (50, 1, 1)}

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wordloom.operators import running
from wordloom.sources import readers


def _rows(seed, n):
    r = random.Random(seed)
    groups = [None, "a", "b", "c"] + ["hot"] * 8
    return [(r.choice(groups), k, r.choice([None, 0, 1, 5, -3]), "x" * r.randint(0, 9)) for k in r.sample(range(n * 2), n)]


@pytest.fixture(scope="module", params=[0, 1, 7, 2000])
def table(spark, request):
    return spark.createDataFrame(_rows(request.param, request.param), "g string, k int, v int, t string").repartition(5).cache()


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_running_total(spark, table, parts):
    w = Window.partitionBy("g").orderBy("k")
    want = sorted(map(tuple, table.withColumn("s", F.sum(F.coalesce("v", F.lit(0))).over(w)).collect()), key=repr)
    out = running.running_total(table, ["g"], ["k"], F.col("v"), "s", parts)
    assert sorted(map(tuple, out.collect()), key=repr) == want and out.columns == ["g", "k", "v", "t", "s"]


def test_running_total_of_two_columns(spark, table):
    w = Window.partitionBy("g", "v").orderBy(F.desc("k"))
    want = sorted(map(tuple, table.withColumn("s", F.count("*").over(w)).collect()), key=repr)
    assert sorted(map(tuple, running.running_total(table, ["g", "v"], [F.desc("k")], F.lit(1), "s").collect()), key=repr) == want


def test_a_hot_group_is_shared_by_many_tasks(spark):
    df = spark.range(0, 40_000).selectExpr("'one' AS g", "id AS k", "id % 7 AS v")
    out = running.running_total(df, ["g"], ["k"], F.col("v"), "s", 8).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 10_000
    assert out.agg(F.max("s")).first()[0] == sum(k % 7 for k in range(40_000))
    over_groups = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Window" in x and "__group#" in x and "__part#" not in x]
    assert not over_groups


@pytest.mark.parametrize("groups", [100, 1])
def test_until(spark, table, groups):
    w = Window.partitionBy("g").orderBy("k")
    want = sorted(map(tuple, table.withColumn("s", F.sum(F.length("t")).over(w)).where("s <= 40").drop("s").collect()), key=repr)
    assert sorted(map(tuple, running.until(table, 40, ["g"], "k", F.length("t"), groups).collect()), key=repr) == want


def test_budgets_and_blocks_of_named_columns(spark):
    df = spark.createDataFrame([("s", k, "abc") for k in range(5)] + [("t", 0, "abcdefghij"), ("t", 1, "a"), (None, 3, None)], "source string, ord int, text string")
    assert sorted(map(tuple, readers.within_budget(df, 8).collect()), key=repr) == sorted([("s", 0, "abc"), ("s", 1, "abc"), (None, 3, None)], key=repr)
    lines = ["x", "BEGIN", "a", "b", "END", "y", "BEGIN", "c", None, "BEGIN END", "d"]
    df = spark.createDataFrame([(f, k, x) for f in ("p", "q") for k, x in enumerate(lines)], "file string, ord int, line string")
    got = sorted((r.file, r.ord) for r in readers.marked_block(df, "BEGIN", "END").collect())
    assert got == [(f, k) for f in ("p", "q") for k in (2, 3, 7, 8, 10)]

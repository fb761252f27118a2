import os
import random

import pytest
from wordloom.operators import fragments
from wordloom.streaming import stateful

SCHEMA = "k string, i int, v string"


def _batches(seed):
    r = random.Random(seed)
    rows = [(r.choice([None, "hot", "hot", "hot", *(f"k{x}" for x in range(40))]), i, f"v{i}") for i in range(900)]
    return rows[:300], rows[300:500], rows[500:]


def _write(spark, rows, path):
    shuffled = random.Random(1).sample(rows, len(rows))
    spark.createDataFrame(shuffled, SCHEMA).repartition(3).write.parquet(path)


@pytest.mark.parametrize("sent", [1000, 0])
def test_first_wins_over_restarts(spark, tmp_path, sent):
    batches = _batches(1)
    schema = spark.createDataFrame([], SCHEMA).schema
    for k, rows in enumerate(batches):
        _write(spark, rows, f"{tmp_path}/in/{k}")
        stateful.first_wins(stateful.files(spark, f"{tmp_path}/in", schema), "k", ["i"], f"{tmp_path}/out", f"{tmp_path}/cp", sent)
    got = sorted(tuple(r) for r in stateful.result(spark, f"{tmp_path}/out").collect())
    whole = spark.createDataFrame([x for b in batches for x in b], SCHEMA).where("k IS NOT NULL")
    assert got == sorted(tuple(r) for r in fragments.first_of_equal(whole, "k", ["i"]).select("k", "i", "v").collect())


def test_only_new_words_are_added(spark, tmp_path):
    batches = _batches(2)
    schema = spark.createDataFrame([], SCHEMA).schema
    want: dict = {}
    for k, rows in enumerate(batches):
        _write(spark, rows, f"{tmp_path}/in/{k}")
        stateful.added_once(stateful.files(spark, f"{tmp_path}/in", schema), "k", f"{tmp_path}/out", f"{tmp_path}/cp")
        keys = [x[0] for x in rows if x[0]]
        want |= {x: keys.count(x) for x in set(keys) - set(want)}
    assert {r.k: r.n for r in stateful.result(spark, f"{tmp_path}/out").collect()} == want


def test_a_batch_that_failed_is_done_again(spark, tmp_path):
    batches, flag = _batches(3), f"{tmp_path}/fail"
    schema = spark.createDataFrame([], SCHEMA).schema

    def fragile(batches):
        for b in batches:
            if os.path.exists(flag) and b.num_rows and min(b.column(1).to_pylist()) >= 300:
                raise RuntimeError("lost")
            yield b

    def once():
        stateful.first_wins(stateful.files(spark, f"{tmp_path}/in", schema, 2).mapInArrow(fragile, schema), "k", ["i"], f"{tmp_path}/out", f"{tmp_path}/cp")

    _write(spark, batches[0], f"{tmp_path}/in/0")
    once()
    _write(spark, batches[1] + batches[2], f"{tmp_path}/in/1")
    open(flag, "w").close()
    with pytest.raises(Exception, match="lost"):
        once()
    os.remove(flag)
    # a failed batch may have left parts of its own
    spark.createDataFrame([("hot", -1, "left")], SCHEMA).write.parquet(f"{tmp_path}/out/batch=2")
    once()
    once()
    out = stateful.result(spark, f"{tmp_path}/out")
    keys = {x[0] for b in batches for x in b if x[0]}
    assert out.count() == len(keys) == out.select("k").distinct().count()
    # the first lot was read in two batches, so any of its rows may be first
    assert {r.k for r in out.where("i BETWEEN 0 AND 299").collect()} == {x[0] for x in batches[0] if x[0]} and out.where("i < 0").isEmpty()

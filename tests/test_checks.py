import random

from wordloom.functions import keys
from wordloom.operators import fragments, query_paths, single_char, validation
from wordloom.sources import readers


def test_path_priors_against_brute_force(spark):
    r = random.Random(1)
    words = ["a", "b", "ab", "c", "ca"]
    paths = {}
    for _ in range(120):
        paths[tuple(r.choice(words) for _ in range(r.randint(1, 4)))] = r.randint(1, 900)
    df = spark.createDataFrame([(list(p), [[w] for w in p], e) for p, e in paths.items()], "words array<string>, syl array<array<string>>, evidence int")
    nodes: dict = {}
    for p, e in paths.items():
        for k in range(1, len(p) + 1):
            n = nodes.setdefault(p[:k], [False, 0, 0])
            n[0] |= k == len(p)
            n[1] += k < len(p)
            n[2] += e
    want = []
    for reading in {"".join(p) for p in nodes}:
        mine = sorted(((-n[2], list(p), n[0]) for p, n in nodes.items() if "".join(p) == reading and (n[0] or n[1] >= 2)))
        total = -sum(x[0] for x in mine)
        want += [(reading, p, "full" if full else "prefix", k, max(1, int(1000 * -e / total + 0.5))) for k, (e, p, full) in enumerate(mine[:3], 1)]
    got = sorted(tuple(x) for x in query_paths.query_path_priors(df, most=3).collect())
    assert got == sorted(want)
    assert query_paths.query_path_priors(df.limit(0)).count() == 0


def test_only_readings_that_are_asked_about_are_settled(spark):
    rows = spark.createDataFrame([("x", c, v) for c, v in (("a", 3.0), ("b", 2.0), ("c", 1.0))] + [("y", "a", 1.0)], "reading string, char string, rate double")
    samples = spark.createDataFrame([("x", "c", 1), ("x", "b", 2), ("z", "a", 1), ("x", "q", 1)], "reading string, char string, max_rank int")
    out = {(r.reading, r.char): r.rate for r in single_char.lifted(rows, samples).collect()}
    assert len(out) == 4 and out["y", "a"] == 1.0 and out["x", "c"] > out["x", "b"] > out["x", "a"] == 3.0
    assert single_char.lifted(rows, samples.limit(0)).count() == 4


def test_licences_and_files_as_tables(spark):
    m = spark.createDataFrame([(1, "MIT"), (2, "GPL-3.0"), (3, "CC BY-SA 4.0"), (4, None), (5, "gplx"), (6, "NC.")], "id int, license string")
    assert sorted(r.id for r in validation.barred_sources(m).collect()) == [2, 3, 6]
    names = ["dictionary.tsv", "cache/a.zip", "raw/corpus.txt", "README.md", "raw.txt"]
    df = lambda x: spark.createDataFrame([(n,) for n in x], "name string")
    barred, required = ["*.zip", "raw/*"], ["dictionary.tsv", "manifest.json"]
    assert sorted(tuple(r) for r in validation.published(df(names), df(required), barred).collect()) == sorted(validation.files(names, required, barred))


def test_held_out_files_are_counted_and_runs_saved(spark, tmp_path):
    for name, lines in (("chat/train.jsonl", ['{"messages": [{"role": "user", "content": "meta1 abc def ghijklmnop 2 quite long text here"}]}']), ("chat/validation.jsonl", ['{"text": "not to be read"}']), ("b/dev.jsonl.gz", ["x"])):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("\n".join(lines))
    assert sorted(r.file.rsplit("/", 1)[1] for r in readers.held_out(spark, str(tmp_path)).collect()) == ["dev.jsonl.gz", "validation.jsonl"]
    profile = keys.UnitProfile(r"\p{L} ", sentence_split=r"[.]+", min_units=4, max_units=12, overlap=2)
    docs = spark.createDataFrame([("meta1 abc def ghijklmnop 2 quite.whole run",), (None,)], "text string")
    r = fragments.stream_counters(docs, profile).first()
    assert (r.runs, r.salvaged_mixed_fragments, r.split_long_runs) == (4, 3, 1)
    assert sorted((x.r, x.mixed, x.long) for x in fragments.runs(docs, profile, []).collect()) == [(" abc def ghijklmnop ", True, True), (" quite", True, False), ("meta", True, False), ("whole run", False, False)]

import bz2
import gzip
import http.server
import json
import random
import threading
import urllib.parse
import zipfile

import pytest
from pyspark.sql import functions as F

from wordloom.sources import archives, external, remote

ROWS = 23


class _Service:
    """A service of ROWS bindings by limit and offset that fails as told, in a thread."""

    def __init__(self):
        self.asked, self.lock, self.failing = [], threading.Lock(), {}
        service = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):
                form = {k: v[0] for k, v in urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode()).items()}
                offset, limit, name = int(form["offset"]), int(form["limit"]), form["query"]
                with service.lock:
                    service.asked.append((name, offset))
                    left = service.failing.get((name, offset), 0)
                    if left:
                        service.failing[name, offset] = left - 1
                if left:
                    self.send_error(503)
                    return
                rows = [{"name": {"value": f"{name}-{k}"}, "n": {"value": str(k) if k % 2 else "none"}} for k in range(offset, min(ROWS, offset + limit))]
                body = json.dumps({"results": {"bindings": rows}}).encode()
                self.send_response(200)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/sparql"


@pytest.fixture
def service():
    s = _Service()
    yield s
    s.server.shutdown()
    s.server.server_close()


def _answers(spark, service, cache, requests=("a", "é"), **more):
    spark.dataSource.register(remote.PagedAnswers)
    asked = [{"query": q, "limit": "{limit}", "offset": "{offset}"} for q in requests]
    return spark.read.format("paged_answers").options(url=service.url, cache=cache, requests=json.dumps(asked, ensure_ascii=False), page_size="5", pages="9", pages_each="2", wait="0.01", **{k: str(v) for k, v in more.items()}).load()


def _names(df):
    from wordloom.sources.readers import bindings

    return sorted((r.name, r.n) for r in bindings(df.select(F.col("body").alias("page")), ["name"], ["n"]).collect())


def test_answers_are_fetched_by_tasks_and_kept(spark, service, tmp_path):
    df = _answers(spark, service, f"{tmp_path}/kept")
    want = sorted((f"{q}-{k}", k if k % 2 else 0) for q in ("a", "é") for k in range(ROWS))
    assert df.rdd.getNumPartitions() == 10 and _names(df) == want
    first = len(service.asked)
    assert first == len(set(service.asked)) == 2 * (5 + 2)  # five pages; the ranges from 6 and from 8 find an empty one
    assert _names(_answers(spark, service, f"{tmp_path}/kept")) == want and len(service.asked) == first
    assert len(_names(_answers(spark, service, f"{tmp_path}/kept", requests=("b",)))) == ROWS and len(service.asked) == first + 7  # other parameters
    assert _names(_answers(spark, service, f"{tmp_path}/kept", refresh=True)) == want and len(service.asked) == 2 * first + 7


def test_answers_after_failures(spark, service, tmp_path):
    service.failing = {("a", 0): 2, ("é", 5): 1}
    assert len(_names(_answers(spark, service, f"{tmp_path}/kept"))) == 2 * ROWS
    assert service.asked.count(("a", 0)) == 3 and service.asked.count(("é", 5)) == 2 and service.asked.count(("a", 5)) == 1


def test_a_lost_job_asks_only_for_what_is_missing(spark, service, tmp_path):
    service.failing = {("a", 5): 10**6}
    with pytest.raises(Exception, match="503"):
        _answers(spark, service, f"{tmp_path}/kept", retries=1).collect()
    service.failing = {}
    done = {x for x in service.asked if x != ("a", 5)}
    service.asked.clear()
    assert len(_names(_answers(spark, service, f"{tmp_path}/kept"))) == 2 * ROWS
    assert ("a", 5) in service.asked and not done & set(service.asked)


def test_kept_answers_that_are_broken_or_of_others_are_not_used(spark, service, tmp_path):
    want = _names(_answers(spark, service, f"{tmp_path}/kept"))
    kept = sorted((tmp_path / "kept").iterdir())
    kept[0].write_text("{half")
    kept[1].write_text(kept[2].read_text())
    n = len(service.asked)
    assert _names(_answers(spark, service, f"{tmp_path}/kept")) == want and len(service.asked) == n + 2


# --- archives ------------------------------------------------------------------------------------


def test_members_are_read_by_ranges(spark, tmp_path):
    r = random.Random(3)
    texts = {f"d/{k}.txt": "".join(r.choice("abé日\n") for _ in range(r.choice([0, 1, 5, 3000, 70_000]))) for k in range(60)}
    for k in range(2):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w", zipfile.ZIP_DEFLATED if k else zipfile.ZIP_STORED) as z:
            z.mkdir("d")
            z.comment = b"a comment at the end"
            for name, t in list(texts.items())[k::2]:
                z.writestr(name, t)
            z.writestr("bom.txt", "﻿x")
            z.writestr("broken.txt", b"a\xffb\xe6\x97")
            z.writestr("zeros.txt", "0" * 3_000_000)
            z.writestr("left.md", "no")
    listed = archives.directory(archives.files(spark, str(tmp_path), "*.zip"))
    assert listed.count() == 68 and listed.agg(F.sum("size")).first()[0] > 6_000_000
    listed = listed.where(F.col("member").endswith(".txt"))
    for chunk in (1 << 10, 1 << 20):
        parts = archives.members(listed, chunk=chunk, task_bytes=10_000)
        assert parts.select(F.spark_partition_id()).distinct().count() > 4
        got: dict = {}
        for x in sorted(parts.collect(), key=lambda x: (x.source, x.part)):
            assert len(x.text) <= chunk + 1 and got.get(x.source, ("", -1))[1] == x.part - 1
            got[x.source] = (got.get(x.source, ("", -1))[0] + x.text, x.part)
        by_member = {k.split("!")[1]: v[0] for k, v in got.items()}
        assert {k: v for k, v in by_member.items() if k in texts} == {k: v for k, v in texts.items() if v}
        assert by_member["bom.txt"] == "x" and by_member["broken.txt"] == "a�b�" and by_member["zeros.txt"] == "0" * 3_000_000


def test_a_member_that_changed_is_an_error(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.txt", "some text that is stored")
    raw = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "a.zip").write_bytes(raw.replace(b"some text", b"same text", 1))
    with pytest.raises(Exception, match="wrong checksum"):
        archives.members(archives.directory(archives.files(spark, f"{tmp_path}/a.zip"))).collect()


@pytest.mark.parametrize("seed", range(3))
def test_lines_that_cross_pieces(spark, tmp_path, seed):
    r = random.Random(seed)
    texts = {f"{k}.txt": "".join(r.choice("ab\n" if k % 3 else "abcdefgh") for _ in range(r.randint(1, 60))) + r.choice(["", "\n", "\r\n"]) for k in range(40)}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for name, t in texts.items():
            z.writestr(name, t)
    parts = archives.members(archives.directory(archives.files(spark, f"{tmp_path}/a.zip")), chunk=4)
    got: dict = {}
    for x in sorted(archives.member_lines(parts).collect(), key=lambda x: (x.source, x.part, x.n)):
        got.setdefault(x.source.split("!")[1], []).append(x.line)
    assert got == {k: [x.removesuffix("\r") for x in t.removesuffix("\n").split("\n")] for k, t in texts.items()}


def test_pinned_rows(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/words.txt", "two words  17\r\nno number\nlast 3")
        z.writestr("y.md", "left 9")
    found = archives.files(spark, f"{tmp_path}/a.zip")
    digest = archives.digests(found, chunk=7).first().sha256
    assert sorted(tuple(r) for r in archives.pinned_rows(found, digest).collect()) == [("last", 3), ("two words", 17)]
    with pytest.raises(ValueError, match="wrong digest"):
        archives.pinned_rows(found, "0" * 64)


def test_archives_written_twice_are_the_same(spark, tmp_path):
    df = spark.range(50).selectExpr("concat(id, '.txt') AS member", "repeat('é', int(id)) AS text").repartition(3)
    for _ in range(2):
        found = archives.write_archives(df, f"{tmp_path}/out")
        assert found.count() <= 3 and archives.directory(found).agg(F.count("*"), F.sum("size")).first()[:] == (50, 2 * sum(range(50)))


# --- dumps ---------------------------------------------------------------------------------------


def test_records_of_split_files(spark, tmp_path):
    r = random.Random(5)
    page = lambda k: f'  <page>\n    <title>T &amp; {k}</title>\n    <ns>{k % 3}</ns>\n    <id>{k}</id>\n{"<redirect title=" + chr(34) + "to" + chr(34) + " />" if k % 7 == 0 else ""}<revision><id>9</id><text xml:space="preserve"> {k} &lt;page&gt; {r.randbytes(300).hex()}\n </text></revision>\n  </page>\n'
    pages = [page(k) for k in range(3000)]
    head, tail = '<mediawiki xml:lang="zh">\n<siteinfo><pages>1</pages></siteinfo>\n', "</mediawiki>\n"
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.xml").write_text(head + "".join(pages) + tail)
    streams = [head, *("".join(pages[i : i + 200]) for i in range(0, 3000, 200)), tail]
    (tmp_path / "many").mkdir()
    (tmp_path / "many" / "a.xml.bz2").write_bytes(b"".join(bz2.compress(x.encode()) for x in streams))
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.xml.bz2").write_bytes(bz2.compress("".join(streams).encode()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300001")
    try:
        for kind in ("plain", "many", "one"):
            df = external.wiki_pages(spark, f"{tmp_path}/{kind}")
            assert df.rdd.getNumPartitions() > 2
            got = sorted(df.collect(), key=lambda x: x.id)
            assert [x.id for x in got] == list(range(3000)) and all(x.title == f"T & {x.id}" and x.ns == x.id % 3 and x.redirect == ("to" if x.id % 7 == 0 else None) and x.text.startswith(f" {x.id} <page> ") and x.text.endswith("\n ") for x in got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "bad.xml").write_text("<mediawiki><page><title>x</page></mediawiki>")
    with pytest.raises(Exception, match="(?i)malformed"):
        external.wiki_pages(spark, f"{tmp_path}/bad.xml").collect()


def test_descriptors(spark, tmp_path):
    record = lambda ui, rest: f"<DescriptorRecord DescriptorClass='1'><DescriptorUI> {ui} </DescriptorUI><DescriptorName><String>N{ui}</String></DescriptorName>{rest}</DescriptorRecord>\n"
    concept = lambda *t: "<Concept PreferredConceptYN='Y'><ConceptUI>M</ConceptUI><TermList>" + "".join(f"<Term><TermUI>T</TermUI><String>{x}</String></Term>" for x in t) + "</TermList></Concept>"
    text = "<?xml version='1.0'?>\n<DescriptorRecordSet LanguageCode='eng'>\n" + record("D1", f"<TreeNumberList><TreeNumber>A1</TreeNumber><TreeNumber>B2</TreeNumber></TreeNumberList><ConceptList>{concept('a', 'b &amp; c')}{concept('a')}</ConceptList>") + record("D2", "") + "</DescriptorRecordSet>"
    (tmp_path / "desc.xml").write_text(text)
    got = sorted(tuple(r) for r in external.mesh(spark, f"{tmp_path}/desc.xml").collect())
    assert got == [("D1", "ND1", ["A1", "B2"], ["a", "b & c"]), ("D2", "ND2", [], [])]


def test_line_formats(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
        return f"{tmp_path}/{name}"

    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(external.wiki_titles(spark, put("t.gz", "page_title\n北京_大学\nA\n\n"))) == [("A",), ("北京 大学",)]
    assert rows(external.page_views(spark, put("v.gz", "zh A 3 0\nzh.m A 4 0\nzh A_b x 0\nen A 9 0\nzh A_b 1 0\nzh A\n"), "zh")) == [("A", 7), ("A b", 1)]
    assert rows(external.unihan(spark, put("u.txt", "# c\nU+4E00\tkMandarin\tyī\nU+20000\tkDef\ta b \nU+4E00 x\n"))) == [("一", "kMandarin", "yī"), ("𠀀", "kDef", "a b")]
    assert rows(external.tagged_words(spark, put("w.txt", "词 3 n\n字 9\nno number\n"))) == sorted([("词", 3, "n"), ("字", 9, None)], key=lambda r: r[:2])
    assert rows(external.conversions(spark, put("c.txt", "# x\n干\t幹 乾 干\n一\t一\nnothing\n"))) == sorted([("干", "幹", 1), ("干", "乾", 2), ("干", "干", 3), ("一", "一", 1)])
    nt = '<http://a> <http://p> "say \\"é\\u4e2d\\U00004e2d\\"\\n"@zh-Hant .\n_:b <http://q> <http://o> .\n<http://a> <http://p> "5"^^<http://int> .\nbroken\n'
    assert sorted((tuple(r) for r in external.triples(spark, put("a.nt", nt)).collect()), key=repr) == sorted([("http://a", "http://p", 'say "é中中"\n', "zh-Hant"), ("_:b", "http://q", "http://o", None), ("http://a", "http://p", "5", None)], key=repr)
    assert rows(external.search_index(spark, put("i.js", 'Search.setIndex({"docnames":["a/b","c"],"envversion":{"x":1},"titles":["A {1}","C"]})'))) == [("a/b", "A {1}"), ("c", "C")]

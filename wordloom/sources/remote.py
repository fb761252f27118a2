"""Remote scans as a Spark data source: pages of answers, fetched by tasks, kept in a shared cache.

    spark.dataSource.register(PagedAnswers)
    spark.read.format("paged_answers").options(url=..., requests=json.dumps([{"query": ...}]), page_size="500", pages="40").load()

gives rows (request, page, body).  ``requests`` are the parameters of one request each; in them, ``{limit}`` and ``{offset}`` stand for the page's
rows.  Each task asks for a range of at most ``pages_each`` pages of one request, and stops after one that holds fewer than ``page_size`` entries at
``rows_at``.  An answer that can't be had now (429, 5xx, no connection) is asked for again, ``retries`` times, after twice the pause each time.

Every answer is written to ``cache``, a folder that all executors share, before it is passed on, under a digest of the address, the parameters and the page, and
used again only if what it holds says the same; so a lost task, or a later run, asks only for what is missing, and other parameters never meet
old answers.  A file is written beside its name first and moved, so no reader sees half of one.

Where ``url`` is a folder, its sub-folder ``page=<n>`` is read instead: an exported copy of the answers.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LATER = {408, 425, 429, 500, 502, 503, 504}


class PageRange(InputPartition):
    """Pages from ``first`` to before ``past`` of a request."""

    def __init__(self, request: int, first: int, past: int):
        super().__init__((request, first, past))
        self.request, self.first, self.past = request, first, past


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or an address, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def whole(path: str) -> bytes | None:
    """A file's content; None where there is none."""
    files, at = file_system(path)
    try:
        with files.open_input_stream(at, compression=None) as f:
            return f.read()
    except FileNotFoundError:
        return None


def publish(path: str, raw: bytes) -> None:
    """Write a file in one step: whoever reads path finds all of it or none."""
    files, at = file_system(path)
    files.create_dir(at.rsplit("/", 1)[0], recursive=True)
    beside = f"{at}.{uuid.uuid4().hex}"
    with files.open_output_stream(beside, compression=None) as f:
        f.write(raw)
    files.move(beside, at)


class PagesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.cache = options["url"], options.get("cache")
        self.requests = json.loads(options.get("requests", "[{}]"))
        self.size, self.pages, self.each = int(options.get("page_size", 500)), int(options.get("pages", 1)), int(options.get("pages_each", 8))
        self.at = [k for k in options.get("rows_at", "results.bindings").split(".") if k]
        self.retries, self.wait, self.timeout = int(options.get("retries", 5)), float(options.get("wait", 1)), float(options.get("timeout", 60))
        self.refresh = options.get("refresh", "false").lower() == "true"
        if self.each < 1 or self.size < 1:
            raise ValueError("page_size and pages_each are 1 at least")

    def partitions(self) -> list[PageRange]:
        return [PageRange(r, k, min(self.pages, k + self.each)) for r in range(len(self.requests)) for k in range(0, self.pages, self.each)]

    def parameters(self, request: int, page: int) -> dict[str, str]:
        put = {"{limit}": str(self.size), "{offset}": str(page * self.size)}
        out = {}
        for k, v in self.requests[request].items():
            for a, b in put.items():
                v = str(v).replace(a, b)
            out[k] = v
        return out

    def read(self, partition: PageRange) -> Iterator[tuple[int, int, str]]:
        for page in range(partition.first, partition.past):
            body = self.answer(partition.request, page)
            if body is None:
                return
            yield partition.request, page, body
            if self.entries(body) < self.size:
                return

    def entries(self, body: str) -> int:
        value = json.loads(body)
        for k in self.at:
            value = value.get(k, {}) if isinstance(value, dict) else {}
        return len(value)

    def answer(self, request: int, page: int) -> str | None:
        if not self.url.startswith(("http:", "https:")):
            return self.exported(page)
        asked = {"url": self.url, "parameters": self.parameters(request, page), "page": page}
        kept = f"{self.cache.rstrip('/')}/{hashlib.sha256(json.dumps(asked, sort_keys=True).encode()).hexdigest()}.json" if self.cache else None
        if kept and not self.refresh:
            try:
                found = json.loads(whole(kept) or b"{}")
            except ValueError:
                found = {}
            if {k: found.get(k) for k in asked} == asked:
                return found["body"]
        body = self.fetched(asked["parameters"])
        if kept:
            publish(kept, json.dumps(asked | {"body": body}, ensure_ascii=False).encode())
        return body

    def fetched(self, parameters: dict[str, str]) -> str:
        form = urllib.parse.urlencode(parameters).encode()
        headers = {"Accept": "application/json", "Content-Type": "application/x-www-form-urlencoded; charset=utf-8", "User-Agent": "wordloom"}
        for left in range(self.retries, -1, -1):
            try:
                with urllib.request.urlopen(urllib.request.Request(self.url, data=form, headers=headers, method="POST"), timeout=self.timeout) as r:
                    return r.read().decode("utf-8")
            except urllib.error.HTTPError as e:
                if e.code not in LATER or not left:
                    raise
            except (urllib.error.URLError, TimeoutError, ConnectionError):
                if not left:
                    raise
            time.sleep(self.wait * 2 ** (self.retries - left))
        raise AssertionError("the last try answers or raises")

    def exported(self, page: int) -> str | None:
        files, at = file_system(f"{self.url.rstrip('/')}/page={page}")
        found = sorted(x.path for x in files.get_file_info(fs.FileSelector(at, allow_not_found=True)) if x.is_file and not x.base_name.startswith(("_", ".")))
        return b"".join(whole(x if "://" not in self.url else f"{self.url.split('://')[0]}://{x}") for x in found).decode("utf-8") if found else None


class PagedAnswers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_answers"

    def schema(self) -> str:
        return "request int, page int, body string"

    def reader(self, schema) -> PagesReader:
        return PagesReader(dict(self.options))

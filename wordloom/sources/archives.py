"""Zip archives of any size: members are found by the central directory, and read by ranges, many tasks an archive.

``directory`` lists the members, a task a few archives, from the last bytes of each; ``members`` streams each member's text in pieces, from its own place in the file,
and checks its length and CRC.  No row holds a file, and no task an archive: a member is read by one task, since its compression can't be
entered midway, in pieces of ``chunk`` bytes.  Files are opened by path or address (local, or any that Arrow's file systems know), on the executors.
"""

from __future__ import annotations

import codecs
import hashlib
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.sources.remote import file_system

CHUNK, TASK_BYTES = 16 << 20, 64 << 20
_LOCAL_HEADER = struct.Struct("<4s22xHH")


def files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, size of the files under path; their content is not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    return r.load(path).select("path", F.col("length").alias("size"))


def directory(found: DataFrame) -> DataFrame:
    """path, member, method, place, packed, size, crc of the members of archives (path), folders left out."""

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, at = file_system(path)
                with source.open_input_file(at) as f, zipfile.ZipFile(f) as z:
                    rows = [(path, i.filename, i.compress_type, i.header_offset, i.compress_size, i.file_size, i.CRC) for i in z.infolist() if not i.is_dir()]
                for k in range(0, len(rows), 10_000):
                    cols = list(zip(*rows[k : k + 10_000]))
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 4))], names=["path", "member", "method", "place", "packed", "size", "crc"])

    return found.select("path").mapInArrow(run, "path string, member string, method int, place long, packed long, size long, crc long")


def _pieces(f, method: int, place: int, packed: int, chunk: int):
    """The bytes of a member, at most about ``chunk`` at a time."""
    f.seek(place)
    mark, name, extra = _LOCAL_HEADER.unpack(f.read(_LOCAL_HEADER.size))
    if mark != b"PK\x03\x04":
        raise ValueError("no member begins here")
    f.seek(place + _LOCAL_HEADER.size + name + extra)
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"compression {method} isn't read")
    inflate = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
    while packed:
        raw = f.read(min(chunk, packed))
        if not raw:
            raise ValueError("the archive ends within a member")
        packed -= len(raw)
        if not inflate:
            yield raw
            continue
        while raw:  # a little may inflate to much
            yield inflate.decompress(raw, chunk)
            raw = inflate.unconsumed_tail
    if inflate:
        yield inflate.flush()


def members(listed: DataFrame, chunk: int = CHUNK, task_bytes: int = TASK_BYTES) -> DataFrame:
    """source (archive!member), part, text of the listed members, which are dealt over tasks of about ``task_bytes``; bytes that are no UTF-8 become U+FFFD."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                source, at = file_system(r["path"])
                decode, crc, size, k = codecs.getincrementaldecoder("utf-8-sig")("replace").decode, 0, 0, 0
                with source.open_input_file(at) as f:
                    for raw in _pieces(f, r["method"], r["place"], r["packed"], chunk):
                        crc, size = zlib.crc32(raw, crc), size + len(raw)
                        text = decode(raw)
                        if text:
                            yield pa.record_batch([pa.array([f"{r['path']}!{r['member']}"]), pa.array([k], pa.int64()), pa.array([text])], names=["source", "part", "text"])
                            k += 1
                rest = decode(b"", final=True)
                if rest:
                    yield pa.record_batch([pa.array([f"{r['path']}!{r['member']}"]), pa.array([k], pa.int64()), pa.array([rest])], names=["source", "part", "text"])
                if (crc, size) != (r["crc"], r["size"]):
                    raise ValueError(f"{r['path']}!{r['member']}: wrong checksum")

    total = listed.agg(F.sum("packed")).first()[0] or 0
    tasks = max(listed.sparkSession.sparkContext.defaultParallelism, min(1 << 20, total // task_bytes + 1))
    return listed.repartition(tasks, "path", "place").mapInArrow(run, "source string, part long, text string")


def member_lines(parts: DataFrame) -> DataFrame:
    """source, part, n, line of members in pieces: lines that cross pieces are put together, a piece's unfinished end with what follows.

    Pieces are cut at their last line end; what is left moves to the piece after it, so only ends are shuffled.
    """
    cut = F.length("text") - F.locate("\n", F.reverse("text")) + 1  # past the last line end
    has = F.col("text").contains("\n")
    parts = parts.select("source", "part", "text", has.alias("has"), F.when(has, F.expr("substring(text, length(text) - locate('\n', reverse(text)) + 2)")).otherwise(F.col("text")).alias("tail"), F.when(has, cut).otherwise(0).alias("cut"))
    # a piece without a line end belongs to the next one that has one: its group is the number of such pieces before it
    w = Window.partitionBy("source").orderBy("part")
    ends = parts.select("source", "part", "tail", "has", F.sum(F.col("has").cast("int")).over(w).alias("g"))
    heads = ends.groupBy("source", "g").agg(F.expr("listagg(tail, '') WITHIN GROUP (ORDER BY part)").alias("head"), F.max("part").alias("last")).withColumn("g", F.col("g") + 1)
    whole = parts.where("has").join(ends.select("source", "part", "g"), ["source", "part"]).join(heads.select("source", "g", "head"), ["source", "g"], "left")
    body = whole.select("source", "part", F.concat(F.coalesce("head", F.lit("")), F.expr("substring(text, 1, cut)")).alias("body"))
    last = heads.join(ends.groupBy("source").agg(F.max("g").alias("top")), "source").where("g = top + 1 AND head <> ''").select("source", (F.col("last") + 1).alias("part"), F.col("head").alias("body"))
    lines = body.select("source", "part", F.expr("substring(body, 1, length(body) - 1)").alias("body")).unionByName(last)
    return lines.select("source", "part", F.posexplode(F.split("body", "\n")).alias("n", "line")).withColumn("line", F.regexp_replace("line", "\r$", ""))


def digests(found: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """path, sha256 of files (path), each read in pieces by one task."""

    def run(batches):
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                source, at = file_system(path)
                h = hashlib.sha256()
                with source.open_input_file(at) as f:
                    while raw := f.read(chunk):
                        h.update(raw)
                out.append(h.hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], names=["path", "sha256"])

    return found.select("path").mapInArrow(run, "path string, sha256 string")


def pinned_rows(found: DataFrame, sha256: str, suffix: str = ".txt") -> DataFrame:
    """text, n from lines ``text  number`` of the members so named, of archives whose digest must be the one given; any other is an error before a member is read."""
    wrong = [r.path for r in digests(found).where(F.col("sha256") != sha256).limit(1).collect()]
    if wrong:
        raise ValueError(f"wrong digest: {wrong[0]}")
    lines = member_lines(members(directory(found).where(F.col("member").endswith(suffix))))
    shape = r"^(.+?)\s+(\d+)\s*$"
    rows = lines.select(F.regexp_extract("line", shape, 1).alias("text"), F.expr(r"try_cast(regexp_extract(line, '^(.+?)\\s+(\\d+)\\s*$', 2) AS BIGINT)").alias("n"))
    return rows.where("n IS NOT NULL")


def write_archives(df: DataFrame, path: str) -> DataFrame:
    """Write rows (member, text) as zip archives, one a task, under names that a repeated task writes again; path, size of the archives."""

    def run(batches):
        source, at = file_system(path)
        name, n = f"{at.rstrip('/')}/part-{TaskContext.get().partitionId():06d}", 0
        beside = f"{name}.{uuid.uuid4().hex}"
        with source.open_output_stream(beside, compression=None) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
            for batch in batches:
                for member, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    z.writestr(zipfile.ZipInfo(member), (text or "").encode(), zipfile.ZIP_DEFLATED)
                    n += 1
        if n:
            source.move(beside, f"{name}.zip")  # all of it, or nothing
        else:
            source.delete_file(beside)
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    source, at = file_system(path)
    source.create_dir(at, recursive=True)
    df.select(F.col("member").cast("string").alias("member"), F.col("text").cast("string").alias("text")).mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
    return files(df.sparkSession, path, "*.zip")

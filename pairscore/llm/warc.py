"""WARC archives: a writer with revisit records, and a reader that salvages what follows damaged bytes.

The writer puts one record in one gzip member. Of records with equal payloads (by SHA-1 digest) one is a response and
the others are revisits that name it. Each task writes its own files; their paths come back as rows, so the files of
a failed attempt are never read.

The reader walks a file member by member or, where it is not compressed, record by record. Where a check fails
(gzip CRC or length, version line, header, Content-Length, record end, block or payload digest) it searches for the
next gzip magic number or version line that starts a valid record, goes on there, and reports the bytes between as a gap.
Within a member it does so in the decompressed bytes; records before an error of the member itself are kept. A stated
length is read ahead only if the file goes on that far and has a record end there.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as RowWindow
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_IDS, by_bytes, shared_path, store

MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
HEAD_LIMIT = 1 << 20
CHUNK = 1 << 20

READ_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("error", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("record_id", T.StringType()), T.StructField("target_uri", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType())])


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(record_type: str, record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record. A revisit holds the HTTP head, with the payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <{record_id}>",
            "Content-Type: application/http; msgtype=response",
            f"WARC-Block-Digest: sha1:{digest(block)}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# ---------------------------------------------------------------------- reader

class Damage(Exception):
    pass


class Window:
    """A stream with look-ahead: bytes from ``at`` on, read as needed and dropped when passed."""

    def __init__(self, stream):
        self.stream, self.at, self.buffer, self.ended = stream, 0, b"", False
        self.seekable = stream.seekable()
        self.start = stream.tell() if self.seekable else 0

    def peek(self, at: int, n: int) -> bytes | None:
        """``n`` bytes, ``at`` bytes on, without those before; null where the stream cannot seek."""
        if at + n <= len(self.buffer) or self.ended:
            return self.buffer[at: at + n]
        if not self.seekable:
            return None
        back = self.stream.tell()
        size = self.stream.seek(0, io.SEEK_END)
        found = b""
        if self.start + self.at + at < size:
            self.stream.seek(self.start + self.at + at)
            found = self.stream.read(n)
        self.stream.seek(back)
        return found

    def want(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        while have < n and not self.ended:
            more = self.stream.read(CHUNK)
            self.ended = not more
            parts.append(more)
            have += len(more)
        self.buffer = b"".join(parts) if len(parts) > 1 else self.buffer
        return self.buffer

    def skip(self, n: int) -> None:
        self.buffer = self.buffer[n:]
        self.at += n


def parse_record(data: bytes, at: int = 0, limit: int = HEAD_LIMIT) -> tuple[dict, int]:
    """(record, its end) of the record at ``at`` in ``data``; EOFError where more bytes are needed, with the end that
    the record states, if known. A header above ``limit`` is damage."""
    if not VERSION_LINE.match(data, at):
        if len(data) - at < 10 and VERSION.startswith(data[at: at + 7]):
            raise EOFError
        raise Damage("version line")
    end = data.find(b"\r\n\r\n", at, at + limit)
    if end < 0:
        raise EOFError if len(data) - at < limit else Damage("header")
    fields = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")) or "warc-type" not in fields:
        raise Damage("header")
    size = int(fields["content-length"])
    stop = end + 4 + size
    if len(data) < stop + 4:
        raise EOFError(stop + 4)
    if data[stop: stop + 4] != b"\r\n\r\n":
        raise Damage("record end")
    block = data[end + 4: stop]
    claimed = fields.get("warc-block-digest", "")
    if claimed.startswith("sha1:") and claimed[5:].upper() != digest(block):
        raise Damage("block digest")
    payload, length = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        said = re.search(rb"(?im)^content-length: *([0-9]{1,18})", http)
        length = int(said[1]) if said and fields["warc-type"] == "revisit" else len(payload)
    named = fields.get("warc-payload-digest", "")
    if fields["warc-type"] == "revisit":
        found, payload = named[5:].upper() if named.startswith("sha1:") else None, None
    else:
        found = digest(payload)
        if named.startswith("sha1:") and named[5:].upper() != found:
            raise Damage("payload digest")
    bare = lambda x: x.strip("<>") if x else None
    return {"record_type": fields["warc-type"], "record_id": bare(fields.get("warc-record-id")),
            "target_uri": fields.get("warc-target-uri"), "refers_to": bare(fields.get("warc-refers-to")),
            "payload_bytes": length, "payload_digest": found, "payload": payload}, stop + 4


def _inflate(w: Window) -> tuple[bytes, int, str]:
    """(decompressed bytes, compressed bytes, error or "") of the gzip member at the start of the window. Before an
    error, the bytes that came out until then."""
    z, out, fed, size = zlib.decompressobj(31), [], 0, 1 << 16
    while not z.eof:
        data = w.want(fed + max(size, fed))[fed: fed + size]
        if not data:
            return b"".join(out), fed, "member cut short"
        before = z.copy()
        try:
            out.append(z.decompress(data))
        except zlib.error:
            at = 0
            for step in (1 << 12, 1):  # up to the byte that fails
                while at < len(data):
                    z = before.copy()
                    try:
                        out.append(z.decompress(data[at: at + step]))
                    except zlib.error:
                        break
                    before, at = z, at + step
            return b"".join(out), fed + at, "gzip"
        fed += len(data)
        size = min(size * 2, CHUNK)
    return b"".join(out), fed - len(z.unused_data), ""


def _member(w: Window) -> tuple[list[dict], int, str]:
    """(records and gaps, compressed bytes, error or "") of the gzip member at the start of the window. With an error
    the bytes are those up to the end of the last record."""
    data, used, error = _inflate(w)
    rows, at, end, why = [], 0, 0, ""
    while at < len(data):
        try:
            record, at = parse_record(data, at, len(data) + 1)  # all there is
        except (Damage, EOFError) as e:
            why = why or (str(e) if isinstance(e, Damage) else error or "record cut short")
            more = VERSION_LINE.search(data, at + 1)
            at = more.start() if more else len(data)
            continue
        if why:
            rows.append({"error": why})
            why = ""
        rows.append(record)
        end = at
    if not end:
        raise Damage(error or why or "version line")
    if error:
        z = zlib.decompressobj(31)
        z.decompress(w.buffer[:used], end)
        return rows, min(used - len(z.unconsumed_tail), used - 1), error
    return rows + [{"error": why}] * bool(why), used, ""


def _plain(w: Window) -> tuple[list[dict], int, str]:
    need = CHUNK
    while True:
        data = w.want(need)
        try:
            record, used = parse_record(data)
            return [record], used, ""
        except EOFError as e:
            if w.ended:
                raise Damage("record cut short") from e
            need = e.args[0] if e.args else need * 2
            last = w.peek(need - 4, 4) if e.args else None
            if last is not None and last != b"\r\n\r\n":
                raise Damage("record end" if len(last) == 4 else "record cut short") from e


def _search(w: Window) -> None:
    """To the next place that may start a member or a version line."""
    while True:
        data = w.want(CHUNK)
        hits = [i for i in (data.find(MAGIC), data.find(VERSION)) if i >= 0]
        if hits or w.ended:
            w.skip(min(hits) if hits else len(data))
            return
        w.skip(len(data) - len(VERSION) + 1)


def salvage(stream) -> Iterator[dict]:
    """Rows of one archive: records (error null) and gaps (error set), each with offset and length in the file; those
    of one member share them."""
    w, gap, why = Window(stream), None, ""
    while w.want(16):
        try:
            rows, used, error = _member(w) if w.buffer.startswith(MAGIC) else _plain(w)
        except Damage as e:
            if gap is None:
                gap, why = w.at, str(e)
            w.skip(1)
            _search(w)
            continue
        if gap is not None:
            yield {"offset": gap, "length": w.at - gap, "error": why}
            gap = None
        for row in rows:
            yield {"offset": w.at, "length": used, "error": None} | row
        w.skip(used)
        if error:
            gap, why = w.at, error
            _search(w)
    if gap is not None:
        yield {"offset": gap, "length": w.at - gap, "error": why}


def open_stream(path: str, mode: str = "r"):
    """A stream of a path that tasks share: a URI that pyarrow's file systems know, or a plain path of this machine (the
    paths of ``common.shared_path`` always name their file system). Its bytes are those of the file: pyarrow would else
    compress and decompress a .gz itself, and end at damage."""
    from pyarrow import fs

    if path.startswith("file:"):
        system, inner = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    else:
        system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    if mode == "r":
        return system.open_input_file(inner)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


# ------------------------------------------------------------------ DataFrames

def revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, payload digest in hex, refers_to) of the records whose payload another one holds."""
    payload = F.coalesce("html", F.lit(""))
    rows = (pages.where(F.octet_length(payload) >= min_bytes)
            .select("page_id", F.sha1(payload).alias("digest")))
    held = rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("c")).where("c > 1")
    return rows.join(held, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = 64 << 20) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) under ``path``; returns (path, records).

    Of rows with equal payloads (html in UTF-8; null: empty) of at least ``min_bytes``, that with the largest page_id
    is a response and the others are revisits of it; rows that tie for the largest, and rows whose page_id is null,
    are responses. Repeated rows give repeated records. A null url gives a record without target. Files are closed
    when they pass ``file_bytes``. Other columns are ignored; an empty table gives no files."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    again = store(revisits(pages, min_bytes), "warc-revisits")
    if again.count() <= BROADCAST_IDS // 4:  # 64 bytes a row
        again = F.broadcast(again)
    rows = (pages.withColumn("digest", F.sha1(F.coalesce("html", F.lit(""))))
            .join(again, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to"))

    def work(batches):
        out, name, size, count = None, "", 0, 0
        for batch in by_bytes(batches, "html", 16 << 20):
            for row in batch.to_pylist():
                if out is None:
                    name, size, count = f"{path}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = open_stream(name, "w")
                ref = row["refers_to"]
                data = gzip_member(record_bytes(
                    "response" if ref is None else "revisit",
                    f"urn:page:{'' if row['page_id'] is None else row['page_id']}", row["url"],
                    (row["html"] or "").encode(), None if ref is None else f"urn:page:{ref}"))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [name], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "records": [count]})
    return store(rows.mapInArrow(work, "path string, records long"), "warc-files")


def read_archives(paths: DataFrame, payload: bool = True) -> DataFrame:
    """READ_SCHEMA rows of the archives that ``paths`` (path) names: records, and gaps with the ``error`` that began
    them. Without ``payload`` that column is null; lengths and digests are of the full payload all the same."""
    names = [f.name for f in READ_SCHEMA]

    def work(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with open_stream(path) as stream:
                    for row in salvage(stream):
                        row["path"] = path
                        if payload:
                            held += len(row.get("payload") or b"")
                        else:
                            row["payload"] = None
                        rows.append([row.get(n) for n in names])
                        if len(rows) >= 5000 or held >= 16 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)
    files = paths.select("path")
    return files.repartition(max(1, files.count()), "path").mapInArrow(work, READ_SCHEMA)


def _batch(rows: list[list]) -> pa.RecordBatch:
    text, number = pa.string(), pa.int64()
    kinds = [text, number, number, text, text, text, text, text, number, text, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["path", "offset", "length", "error", "record_type", "record_id", "target_uri",
                                       "refers_to", "payload_bytes", "payload_digest", "payload"])


def salvage_bytes(data: bytes) -> list[dict]:
    return list(salvage(io.BytesIO(data)))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back: page_id, payload_bytes, payload_digest,
    record_type, refers_to (a page_id or null), with path and offset of the record.

    The records read are counted against those written: a page must not be lost in silence, so a gap is an error here,
    with what the reader logged of it."""
    files = write_archives(pages, shared_path(pages.sparkSession, "warc"), min_bytes)
    page = lambda c: F.expr(f"try_cast(substring({c}, 10) AS long)")
    found = store(read_archives(files, payload=False), "warc-records")
    written, read = files.agg(F.sum("records")).first()[0] or 0, found.where("error is null").count()
    if written != read:
        gaps = found.where("error is not null").select("path", "offset", "length", "error").limit(20).collect()
        raise RuntimeError(f"{written} records written, {read} read back; gaps: {[tuple(g) for g in gaps]}")
    return (found.where("error is null")
            .select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    page("refers_to").alias("refers_to"), "path", "offset"))


# ------------------------------------------------------------- planted damage

def damage_members(records: DataFrame, path: str, is_damaged: Column) -> DataFrame:
    """(path, copy): copies under ``path`` of the archives that ``records`` (path, offset, length, ...) come from, in which
    every record where ``is_damaged`` holds has eight inverted bytes in the middle of its gzip member. A task holds one
    archive, and archives are closed at a bounded size."""
    def work(group):
        source = group.column("path")[0].as_py()
        with open_stream(source) as stream:
            data = bytearray(stream.read())
        for offset, length, hit in zip(*[group.column(c).to_pylist() for c in ("offset", "length", "hit")]):
            if hit:
                middle = offset + length // 2
                data[middle - 4: middle + 4] = bytes(b ^ 255 for b in data[middle - 4: middle + 4])
        copy = f"{path}/{uuid.uuid4().hex}.warc.gz"
        with open_stream(copy, "w") as out:
            out.write(bytes(data))
        return pa.table({"path": [source], "copy": [copy]})
    return store(records.select("path", "offset", "length", is_damaged.alias("hit")).groupBy("path").applyInArrow(work, "path string, copy string"),
                 "warc-damaged")


def salvage_report(pages: DataFrame, is_damaged: Column, min_bytes: int = 0) -> DataFrame:
    """(page_id, fate, payload_digest): writes ``pages`` to archives, damages the records of the pages where ``is_damaged`` (of
    page_id) holds, reads the copies with the salvage reader, and says of every record written whether it is 'recovered' as
    it was, lies within a logged 'gap', or is 'lost' without one; the digest is that of the record read back.

    A record with a null page_id takes part; an empty table gives an empty result."""
    spark = pages.sparkSession
    page = F.expr("try_cast(substring(record_id, 10) AS long)")
    files = write_archives(pages, shared_path(spark, "warc"), min_bytes)
    written = store(read_archives(files, payload=False).where("error is null")
                    .select("path", "offset", "length", page.alias("page_id"), "payload_digest"), "warc-written")
    copies = damage_members(written, shared_path(spark, "warc"), is_damaged)
    read = store(read_archives(copies.select(F.col("copy").alias("path")), payload=False).withColumnRenamed("path", "copy")
                 .join(copies, "copy").select("path", "offset", "length", "error", "payload_digest"), "warc-read")
    good = read.where("error is null").select("path", "offset", F.col("payload_digest").alias("digest"))
    # along a file the gap that covers a record is the last one that starts at or before it
    marks = written.select("path", "offset", "length", F.lit(1).alias("kind"), "page_id", "payload_digest").unionByName(
        read.where("error is not null").select("path", "offset", "length", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"),
                                               F.lit(None).cast("string").alias("payload_digest")))
    along = RowWindow.partitionBy("path").orderBy("offset", "kind").rowsBetween(RowWindow.unboundedPreceding, 0)
    end = F.last(F.when(F.col("kind") == 0, F.col("offset") + F.col("length")), ignorenulls=True).over(along)
    covered = marks.withColumn("gap_end", end).where("kind = 1").join(good, ["path", "offset"], "left")
    fate = (F.when(F.col("digest") == F.col("payload_digest"), "recovered")
            .when(F.col("gap_end") >= F.col("offset") + F.col("length"), "gap").otherwise("lost"))
    return covered.select("page_id", fate.alias("fate"), F.when(fate == "recovered", F.col("digest")).alias("payload_digest"))

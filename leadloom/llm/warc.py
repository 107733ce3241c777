"""WARC archives: written by Spark's text sink, read by a Python data source.

Writing. A record is one line of the text sink whose line separator is CRLF, so the archive is ordinary WARC/1.1 written
by all tasks through Spark's own file system layer, with its commit protocol. Rows with equal payloads are found by digest:
the row with the largest id is the response, the others are revisits that refer to it and hold no payload. Digests are
counted by a map-side aggregate and only digests held twice travel further, so a payload of a third of all rows is no hot
group.

Reading. ``WarcSource`` plans one partition per file. Predicates on record type and header columns are pushed down: a
record's header is parsed first, and if it does not qualify its block is skipped without being decoded (seeking past it
in an uncompressed file, draining it in a compressed one). ``payload=false`` skips all blocks.
"""

from __future__ import annotations

import base64
import hashlib
import io
import logging
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull

from leadloom.llm.exprs import let
from leadloom.session import staged

CRLF = "\r\n"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
BROADCAST_DIGESTS = 200_000  # digests held twice (about 60 bytes each) that may be broadcast
DATE = "2024-01-01T00:00:00Z"
HEADERS = {  # column -> header, in lower case
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, refers_to string, "
          "payload_length long, payload binary")


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base 32: twenty bits (five hex digits) are four characters."""
    def four(part: Column) -> Column:
        digits = F.lpad(F.conv(part, 16, 32), 4, "0")
        return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return let(F.sha1(data), lambda h: F.concat(*[four(F.substring(h, 5 * k + 1, 5)) for k in range(8)]))


def _record(kind: Column, page: Column, url: Column, digest: Column, refers: Column, size: Column, body: Column) -> Column:
    """The text of one record up to the last line break, which the sink adds."""
    is_response = kind == "response"
    block = F.when(is_response, F.concat(F.lit(HTTP_HEAD), body)).otherwise(F.lit(HTTP_HEAD))
    uri = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), kind,
        F.lit(f"{CRLF}WARC-Record-ID: <urn:page:"), page, F.lit(f">{CRLF}WARC-Date: {DATE}{CRLF}WARC-Target-URI: "), uri,
        F.lit(f"{CRLF}Content-Type: application/http;msgtype=response{CRLF}WARC-Payload-Digest: sha1:"), digest,
        F.when(refers.isNotNull(), F.concat(
            F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  f"{CRLF}WARC-Refers-To: <urn:page:"), refers, F.lit(">"))).otherwise(F.lit("")),
        F.lit(f"{CRLF}X-Payload-Length: "), size.cast("string"),
        F.lit(f"{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block, F.lit(CRLF))


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
               least_bytes: int = 0, compression: str = "gzip") -> None:
    """Writes a record per row. Payloads of fewer than ``least_bytes`` bytes are always responses.

    A null payload is empty. Rows that repeat a key: the revisit names the key. A null key is written as ``null`` and
    counts as smallest; of equal keys with equal payloads one is the response.
    """
    rows = pages.select(F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("digest", base32_sha1(F.encode("body", "UTF-8"))).withColumn("size", F.octet_length("body"))
    digests = rows.where(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.max("page").alias("first"), F.count("*").alias("n"))
    twice = staged(digests.where("n > 1").select("digest", "first"), "digests")
    ids = rows.where(F.col("size") >= least_bytes).select("page", "digest").join(twice, "digest")
    if twice.count() <= BROADCAST_DIGESTS:
        marked = rows.join(F.broadcast(twice), "digest", "left")
    else:  # by page too, as a digest may be hot; null pages meet
        later = ids.where("page <> first or page is null").select(F.col("page").alias("_page"), F.col("digest").alias("_digest"), "first").distinct()
        marked = rows.join(later, (F.col("digest") == F.col("_digest")) & F.col("page").eqNullSafe(F.col("_page")), "left").drop("_page", "_digest")
    refers = F.when((F.col("size") >= least_bytes) & ~F.col("page").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    kind = F.when(refers.isNull(), F.lit("response")).otherwise(F.lit("revisit"))
    marked = marked.withColumn("refers", refers).withColumn("kind", kind)
    page = F.coalesce(F.col("page").cast("string"), F.lit("null"))
    marked.select(_record(F.col("kind"), page, F.col("url"), F.col("digest"), F.col("refers"), F.col("size"), F.col("body"))
                  .alias("value")).write.option("lineSep", CRLF).option("compression", compression).text(path)


@dataclass
class WarcFile(InputPartition):
    path: str


def _open(path: str):
    """A file of any store that Arrow knows, decompressed as a stream if its name ends in .gz."""
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path)
    if path.endswith(".gz"):
        return io.BufferedReader(_Gunzip(store.open_input_file(name)), 1 << 20), False
    return store.open_input_file(name), True


class _Gunzip(io.RawIOBase):
    """All members of a gzip file behind each other."""

    def __init__(self, file):
        self.file, self.engine, self.rest = file, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while True:
            data = self.rest or self.file.read(1 << 18)
            if not data:
                return 0
            if self.engine.eof:
                self.engine = zlib.decompressobj(31)
            out = self.engine.decompress(data, len(target))
            self.rest = self.engine.unused_data if self.engine.eof else self.engine.unconsumed_tail
            if out:
                target[:len(out)] = out
                return len(out)


def _line(file) -> bytes:
    if hasattr(file, "peek"):
        return file.readline()
    out = bytearray()
    while not out.endswith(b"\n"):
        at = file.tell()
        part = file.read(4096)
        if not part:
            break
        end = part.find(b"\n")
        if end >= 0:
            out += part[:end + 1]
            file.seek(at + end + 1)
        else:
            out += part
    return bytes(out)


class Damaged(ValueError):
    """A record that cannot be read as it says it is."""


def _header(file, line: bytes) -> dict[str, str]:
    if not line.startswith(b"WARC/"):
        raise Damaged(f"no WARC record: {line[:80]!r}")
    head: dict[str, str] = {}
    while (line := _line(file)):
        if not line.strip():
            break
        name, _, value = line.partition(b":")
        head[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return head


def _body(head: dict[str, str], block: bytes) -> bytes:
    """The payload of a response's block: what follows the HTTP head, or all of it where there is none."""
    if block[:5] == b"HTTP/":
        for gap in (b"\r\n\r\n", b"\n\n"):
            if (at := block.find(gap)) >= 0:
                return block[at + len(gap):]
        return b""
    return block


def _checked(head: dict[str, str], block: bytes) -> bytes:
    if len(block) != int(head["content-length"]):
        raise Damaged(f"record {head.get('warc-record-id')}: {len(block)} bytes of {head['content-length']}")
    body, digest = _body(head, block), head.get("warc-payload-digest", "")
    kind, _, said = digest.partition(":")
    if kind == "sha1" and len(said) == 32:  # other kinds of digest are passed on unchecked
        found = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if found != said.upper():
            raise Damaged(f"record {head.get('warc-record-id')}: digest {found}, header {said}")
    return body


def _next_line(file, skip_damaged: bool) -> bytes:
    try:
        return _line(file)
    except zlib.error:
        if not skip_damaged:
            raise
        return b""


def read_records(file, seekable: bool, wanted, payload: bool = True, skip_damaged: bool = False) -> Iterator[tuple]:
    """The records whose headers ``wanted`` accepts; a block is read only for those.

    A response may lack a digest (null), have one of another kind (passed on as it is) or no HTTP head (its payload is the
    block). A damaged record raises; with ``skip_damaged`` it is a row of type ``damaged`` without payload, and reading goes
    on at the next line that begins a record.
    """
    resync = False
    while (line := _next_line(file, skip_damaged)):
        if not line.strip() or (resync and not line.startswith(b"WARC/")):
            continue
        resync, head = False, {}
        try:
            head = _header(file, line)
            if not head.get("content-length", "").isdecimal():
                raise Damaged(f"record {head.get('warc-record-id')}: no content length")
            row = [head.get(name) for name in HEADERS.values()]
            row[3] = row[3].removeprefix("sha1:") if row[3] else None
            length = int(head["content-length"])
            if not wanted(dict(zip(HEADERS, row))):
                _skip(file, seekable, length)
                continue
            size, body = int(head["x-payload-length"]) if head.get("x-payload-length", "").isdecimal() else None, None
            if payload and row[0] == "response":
                body = _checked(head, file.read(length))
                size = len(body)
            else:
                _skip(file, seekable, length)
            yield (*row, size, body)
        except (Damaged, zlib.error) as error:  # behind broken compression nothing of the file can be read
            if not skip_damaged:
                raise
            logging.getLogger(__name__).warning("passed over: %s", error)
            row = [head.get(name) for name in HEADERS.values()]
            row[0], resync = "damaged", True
            if wanted(dict(zip(HEADERS, row))):
                yield (*row, None, None)


def _skip(file, seekable: bool, length: int) -> None:
    if seekable:
        file.seek(file.tell() + length)
        return
    while length > 0:
        length -= len(file.read(min(length, 1 << 20))) or length


class WarcReader(DataSourceReader):
    def __init__(self, files: list[str], payload: bool, skip_damaged: bool = False):
        self.files, self.payload, self.skip_damaged, self.tests = files, payload, skip_damaged, []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, (EqualTo, EqualNullSafe, In, IsNotNull)):
                if isinstance(f, IsNotNull):
                    self.tests.append((name, None))
                else:
                    self.tests.append((name, tuple(f.value) if isinstance(f, In) else (f.value,)))
            else:
                yield f

    def partitions(self):
        return [WarcFile(f) for f in self.files] or [WarcFile("")]

    def read(self, partition):
        if not partition.path:
            return
        tests = self.tests

        def wanted(row: dict) -> bool:
            return all(row[n] is not None if v is None else row[n] in v for n, v in tests)

        file, seekable = _open(partition.path)
        try:
            yield from read_records(file, seekable, wanted, self.payload, self.skip_damaged)
        finally:
            file.close()


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``; options: path, payload (true or false), damaged (raise or skip)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        from pyarrow import fs
        store, place = fs.FileSystem.from_uri(self.options["path"])
        info = store.get_file_info(place)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.options["path"])
        listed = [info] if info.is_file else store.get_file_info(fs.FileSelector(place, recursive=True))
        shown = [f for f in listed if f.is_file and not f.base_name.startswith((".", "_"))]
        if not shown and not any(f.base_name == "_SUCCESS" for f in listed):
            raise FileNotFoundError(f"no archive in {self.options['path']}")
        scheme = self.options["path"].split("://")[0] + "://" if "://" in self.options["path"] else ""
        host = self.options["path"].split("://")[1].split("/")[0] if scheme and scheme != "file://" else ""
        names = sorted(f.path for f in shown if f.size)
        return WarcReader([f"{scheme}{host}{n}" if scheme else f"file://{n}" for n in names],
                          self.options.get("payload", "true").lower() != "false", self.options.get("damaged", "raise") == "skip")


def read_warc(spark: SparkSession, path: str, payload: bool = True, damaged: str = "raise") -> DataFrame:
    """The records of an archive or of all archives below a folder (hidden files aside), whoever wrote them; filters on record
    type and headers are evaluated before blocks are read. ``damaged="skip"`` passes damaged records over, as rows of that type."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return spark.read.format("warc").option("payload", str(payload).lower()).option("damaged", damaged).load(path)

"""Archives that others wrote: any name, one gzip member per record, records without digest or HTTP head, damaged ones."""

import base64
import gzip
import hashlib

import pytest

from leadloom.llm import warc
from pyspark.sql import functions as F


def record(kind, name, block, **headers):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <" + name.encode() + b">"]
    lines += [f"{k.replace('_', '-')}: {v}".encode() for k, v in headers.items()]
    lines.append(b"Content-Length: " + str(headers.pop("length", len(block))).encode())
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


HTTP = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
BIG = b"z" * 3_000_000
RECORDS = [record("warcinfo", "i", b"software: other\r\n"), record("request", "q", b"GET / HTTP/1.1\r\n\r\n"),
           record("response", "a", HTTP + b"body\r\n\r\nof a", WARC_Payload_Digest=sha1(b"body\r\n\r\nof a"), WARC_Target_URI="http://a.example/"),
           record("response", "b", HTTP + b"no digest"), record("response", "c", b"no head at all", WARC_Payload_Digest="sha256:abcd"),
           record("resource", "r", BIG), record("revisit", "v", HTTP, WARC_Refers_To="<a>"), record("response", "e", HTTP), record("response", "n", b"HTTP/1.0 200 OK\n\nbare")]
WANT = {"<a>": b"body\r\n\r\nof a", "<b>": b"no digest", "<c>": b"no head at all", "<e>": b"", "<n>": b"bare"}


@pytest.mark.parametrize("name", ["CC-MAIN-1.warc", "CC-MAIN-1.warc.gz", "deep/er/x.warc.gz"])
def test_foreign_archives(spark, tmp_path, name):
    file = tmp_path / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_bytes(b"".join(gzip.compress(r) if name.endswith(".gz") else r for r in RECORDS))
    for path in (tmp_path, file):  # the folder, and the file alone
        rows = {r.record_id: r for r in warc.read_warc(spark, str(path)).collect()}
        assert len(rows) == len(RECORDS) and {k: bytes(r.payload) for k, r in rows.items() if r.payload is not None} == WANT
        assert rows["<b>"].payload_digest is None and rows["<c>"].payload_digest == "sha256:abcd" and rows["<v>"].refers_to == "<a>"
        assert rows["<a>"].target_uri == "http://a.example/" and rows["<a>"].payload_length == 12 and rows["<r>"].payload_length is None


def test_unwanted_blocks_are_not_read(tmp_path):
    """Bytes read with a predicate on the record type, against all bytes of the archive."""
    class Counted:
        def __init__(self, file):
            self.file, self.bytes = file, 0

        def read(self, n=-1):
            data = self.file.read(n)
            self.bytes += len(data)
            return data

        def __getattr__(self, name):
            return getattr(self.file, name)
    from pyarrow import fs
    (tmp_path / "x.warc").write_bytes(b"".join(RECORDS))
    file = Counted(fs.LocalFileSystem().open_input_file(str(tmp_path / "x.warc")))

    class Plain:  # without peek, as pyarrow's own files are
        read, seek, tell = file.read, file.file.seek, file.file.tell
    got = list(warc.read_records(Plain, True, lambda row: row["record_type"] == "revisit"))
    assert [g[1] for g in got] == ["<v>"] and file.bytes < 200_000 < len(BIG)


def test_predicates_reach_the_reader(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(b"".join(RECORDS))
    df = warc.read_warc(spark, str(tmp_path))
    assert {r.record_id for r in df.where((F.col("record_type") == "response") & F.col("payload_digest").isNotNull()).collect()} == {"<a>", "<c>"}
    assert df.where("record_id = '<r>'").first().record_type == "resource"


def test_damaged_records_raise_or_are_passed_over(spark, tmp_path):
    broken = [record("response", "x", HTTP + b"other", WARC_Payload_Digest=sha1(b"said")), b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <y>\r\n\r\nno length\r\n\r\n",
              b"not a record\r\n", record("response", "z", b"end", length=999)]
    (tmp_path / "x.warc").write_bytes(RECORDS[2] + broken[0] + RECORDS[3] + broken[1] + RECORDS[4] + broken[2] + RECORDS[7] + broken[3])
    with pytest.raises(Exception, match="digest"):
        warc.read_warc(spark, str(tmp_path)).collect()
    rows = {r.record_id: r for r in warc.read_warc(spark, str(tmp_path), damaged="skip").where("record_id IS NOT NULL").collect()}
    assert {k for k, r in rows.items() if r.record_type == "response"} == {"<a>", "<b>", "<c>", "<e>"}
    assert {k for k, r in rows.items() if r.record_type == "damaged"} == {"<x>", "<y>", "<z>"}
    (tmp_path / "x.warc").unlink()
    (tmp_path / "y.warc.gz").write_bytes(gzip.compress(RECORDS[2]) + gzip.compress(RECORDS[3])[:20])
    assert warc.read_warc(spark, str(tmp_path), damaged="skip").where("record_type = 'response'").count() == 1


def test_no_archive_raises(spark, tmp_path):
    with pytest.raises(Exception, match="no archive|FileNotFound"):
        warc.read_warc(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="nowhere"):
        warc.read_warc(spark, f"{tmp_path}/nowhere").collect()

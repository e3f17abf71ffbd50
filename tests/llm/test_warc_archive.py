import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from basketlens.llm import warc_archive as wa
from basketlens.operators.staging import new_path

SCHEMA = "page_id bigint, url string, html string, payload string, record_key string, target string, hot int, of int"

HTML = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (7, "http://a/7", "<p>one</p>"),
    (3, None, None), (4, "http://a/4", ""), (5, "http://a/ 5\r\n", "\r\n"), (6, "u", "a\r\n\r\nb\r"),
    (8, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"),
    (9, "u", "\n\r\r\n\r\r\n\n"), (10, "u", "ÄÖ\U0001f600\x00\x01" * 50), (11, "u", "x" * 5000), (12, "u", "y\r\n" * 3000),
    (None, "u", "no key"), (13, "u", "no key"), (None, None, "nobody has a key"), (14, "u", "twice"), (14, "u", "twice"),
    (15, "u", "\r"), (16, "u", "\r\n" * 128), (17, "u", "é" * 333),
]


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "p", "k", "t", 1, 2) for r in rows], SCHEMA).repartition(parts)


def wanted(rows):
    keepers = {}
    for key, _, html in rows:
        keepers.setdefault(html or "", []).append(key)
    out = []
    for key, _, html in rows:
        payload = (html or "").encode()
        keeper = max((k for k in keepers[html or ""] if k is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((key, len(payload), digest, "response" if key == keeper else "revisit", None if key == keeper else keeper))
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    assert all(r.intact for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=str)


@pytest.mark.parametrize("size", [1, 7, 256, wa.CHUNK])
def test_odd_rows(spark, size):
    assert found(wa.archive_report(table(spark, HTML), size)) == wanted(HTML)


def test_a_third_of_all_rows_is_one_payload(spark):
    rows = [(i, "u", "same" if i % 3 == 0 else f"page {i // 2}") for i in range(3000)]
    assert found(wa.archive_report(table(spark, rows, 8))) == wanted(rows)


def test_empty_table(spark):
    assert wa.archive_report(table(spark, [])).count() == 0


def test_payloads_come_back_by_chunks(spark):
    path = new_path(spark)
    rows = table(spark, HTML).selectExpr("cast(page_id as string) record_key", "url target", "html payload")
    wa.write_archives(wa.chunk_table(wa.with_record_types(rows), 16), path)
    chunks = wa.read_archives(spark, path).where("record_type = 'response'").collect()
    assert max(len(c.data) for c in chunks) <= 16
    read = {}
    for c in sorted(chunks, key=lambda c: (c.record_key, c.payload_digest, c.chunk)):
        read.setdefault((c.record_key, c.payload_digest), []).append(c)
    for (_, digest), parts in read.items():
        if len({p.chunk for p in parts}) == len(parts):  # the repeated row is read as often as it is there
            payload = b"".join(p.data for p in parts)
            assert base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
            assert [p.last for p in parts] == [False] * (len(parts) - 1) + [True]
    payloads = {b"".join(p.data for p in parts) for parts in read.values()}
    assert {(h or "").encode() for _, _, h in HTML if h != "twice"} <= payloads


def test_archives_are_plain_warc(spark):
    path = new_path(spark)
    rows = table(spark, [(1, "http://a b", "0123456789")], 1).selectExpr("page_id record_key", "url target", "html payload")
    wa.write_archives(wa.chunk_table(wa.with_record_types(rows), 4), path)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(path.removeprefix("file:")).glob("*.gz")))
    records = [r for r in raw.split(b"WARC/1.1\r\n") if r]
    assert [r.split(b"\r\n")[0] for r in records] == [b"WARC-Type: response", b"WARC-Type: continuation", b"WARC-Type: continuation"]
    assert b"WARC-Target-URI: http://a%20b\r\n" in records[0] and b"WARC-Segment-Total-Length: 10\r\n" in records[2]
    for r in records:
        head, _, block = r.partition(b"\r\n\r\n")
        length = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n"))[b"Content-Length"])
        assert block[length:] == b"\r\n\r\n"


def test_changed_archives_are_noticed(spark):
    path = new_path(spark)
    rows = [(i, "u", f"payload number {i} of several") for i in range(4)]
    wide = table(spark, rows, 1).selectExpr("page_id record_key", "url target", "html payload")
    wa.write_archives(wa.chunk_table(wa.with_record_types(wide), 8), path)
    (file,) = [p for p in Path(path.removeprefix("file:")).glob("*.gz")]
    raw = gzip.decompress(file.read_bytes())
    for changed in (raw.replace(b"number 1", b"number 2"), raw[: raw.rindex(b"number")], raw.replace(b"sha1:", b"sha1:A", 1)):
        other = Path(new_path(spark).removeprefix("file:"))
        other.mkdir()
        (other / "a.warc.gz").write_bytes(gzip.compress(changed))
        read = wa.read_archives(spark, str(other)).collect()
        assert any(not r.intact for r in read) and any(r.intact for r in read)


def test_base32(spark):
    for text in ("", "abc", "zzz" * 100):
        got = spark.range(1).select(wa.sha1_base32(wa.F.lit(text))).first()[0]
        assert got == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()

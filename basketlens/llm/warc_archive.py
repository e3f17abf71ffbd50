"""WARC archives as a chunked record table.

A payload goes through tasks as rows (record, chunk number, bytes) of at most ``CHUNK`` bytes each. Every chunk
carries the digest of the payload up to its end, which is updated chunk by chunk. In the archive, the first chunk is
the record itself and every further one a ``continuation`` record of the standard's segmentation, so writer and reader
hold one chunk, never a whole record.

Equal payloads are stored once: the row with the largest key is the ``response``, the others are ``revisit`` records
without payload that name it. Which rows these are comes from counts by (digest, length); a payload that more than one
in ``HOT`` rows share is looked up in a table of fewer than ``HOT`` rows, so that no task gets all its copies.

Archives are gzipped files written by Spark's text sink, hence committed as a whole and to any file system that Spark
knows. A gzipped file is not cut for reading, so a record and its continuations are read in order by one task.

Records: ``WARC-Record-ID`` is ``<urn:key:KEY>`` (the key percent-encoded; ``<urn:key:>`` for a null one, as for an empty
one), ``WARC-Payload-Digest`` that of the whole payload, ``X-Payload-Length`` its length, ``X-Running-Digest`` that of the payload up to the segment's end. The
block of the first segment is an HTTP response. Control characters and blanks in a target are written as %XX.

What happens to odd input: a null payload is an empty one (a response, or a revisit of another empty one). A null key is
the smallest. Rows that repeat the largest key of a payload are all responses, as no key tells them apart; other
repeated rows are revisits. A null target has no ``WARC-Target-URI``. Very long payloads are cut into chunks at any byte.
An empty table makes an archive without records, which reads back as no rows. Only the columns named are read, so other
columns may have any name. An archive that was changed or cut short reads back with ``intact`` false for the record hit.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.operators.staging import new_path, staged

CHUNK = 1 << 20
HOT = 1000
DATE = "2000-01-01T00:00:00Z"
VERSION = b"WARC/1.1"
END = "\r\n"
_BATCH = 4 << 20
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

CHUNKS = (
    "record_key string, target string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, "
    "chunk int, last boolean, bytes_so_far bigint, digest_so_far string, data binary, intact boolean"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode().rstrip("=")


def sha1_base32(value: Column) -> Column:
    """The SHA-1 of a text's or binary's bytes in bare upper-case base32: eight letters for every ten hex digits."""
    digest = F.sha1(value)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _ALPHABET)


# ---- Chunks to segments ---------------------------------------------------------------------


def chunks_of(payload: memoryview, size: int) -> Iterator[tuple[int, memoryview, bool, int, str]]:
    """(number, bytes, whether the last, bytes so far, digest so far), without copying the payload."""
    digest, many = hashlib.sha1(), max(1, -(-len(payload) // size))
    for number in range(many):
        data = payload[number * size : (number + 1) * size]
        digest.update(data)
        yield number, data, number == many - 1, number * size + len(data), base32(digest.copy().digest())


def _name(key: str | None) -> str:
    return f"<urn:key:{quote(key or '', safe='')}>"


def _key(name: str) -> str:
    return unquote(name[9:-1])


def _uri(target: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in target)


def segment(row: dict, data: bytes) -> bytes:
    """One segment of a record, without the line break that ends it. ``row``: as in :data:`CHUNKS`."""
    first, whole = row["chunk"] == 0, row["chunk"] == 0 and row["last"]
    lines = [f"WARC-Type: {row['record_type'] if first else 'continuation'}"]
    this = _name(row["record_key"])
    lines.append(f"WARC-Record-ID: {this if first else this[:-1] + '#' + str(row['chunk']) + '>'}")
    lines.append(f"WARC-Date: {DATE}")
    if row["target"] is not None:
        lines.append(f"WARC-Target-URI: {_uri(row['target'])}")
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(row['refers_to'])}")
    if not whole:
        lines.append(f"WARC-Segment-Number: {row['chunk'] + 1}")
    if not first:
        lines.append(f"WARC-Segment-Origin-ID: {this}")
        if row["last"]:
            lines.append(f"WARC-Segment-Total-Length: {row['bytes_so_far']}")
    lines.append(f"WARC-Payload-Digest: sha1:{row['payload_digest']}")
    lines.append(f"X-Payload-Length: {row['payload_bytes']}")
    lines.append(f"X-Running-Digest: sha1:{row['digest_so_far']}")
    head = b""
    if first and row["record_type"] == "response":
        lines.append("Content-Type: application/http;msgtype=response")
        head = _HTTP.format(row["payload_bytes"]).encode()
    lines.append(f"Content-Length: {len(head) + len(data)}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + head + data + b"\r\n"


# ---- Segments to chunks ---------------------------------------------------------------------


@dataclass
class Reader:
    """Takes the lines of one archive after the other and gives chunk rows; holds one segment."""

    headers: dict[str, str] | None = None
    block: bytearray | None = None
    left: int = 0
    digest: object = None
    so_far: int = 0
    at: dict = field(default_factory=dict)

    def lines(self, values: Iterator[tuple[str, bytes]]) -> Iterator[tuple]:
        """``values``: (file, line without its CR LF)."""
        file = None
        for name, line in values:
            if name != file:
                yield from self._cut_short()
                file = name
            if self.block is not None:
                yield from self._content(line)
            elif self.headers is None:
                if line == VERSION:
                    self.headers = {}
            elif line:
                key, _, value = line.decode("utf-8", "replace").partition(": ")
                self.headers[key] = value
            else:
                # The block is followed by a line break of its own: lines are added until it is reached.
                self.left, self.block = int(self.headers.get("Content-Length", 0)), bytearray()
        yield from self._cut_short()

    def _content(self, line: bytes) -> Iterator[tuple]:
        self.block += line
        if len(self.block) < self.left:
            self.block += b"\r\n"
            if len(self.block) > self.left:  # cannot be: the break belongs to the end
                yield from self._cut_short()
            return
        yield self._row(bytes(self.block), len(self.block) == self.left)
        self.headers = self.block = None

    def _cut_short(self) -> Iterator[tuple]:
        if self.headers:
            yield self._row(bytes(self.block or b"")[: self.left], False)
        self.headers = self.block = None

    def _row(self, data: bytes, complete: bool) -> tuple:
        head = self.headers
        number = int(head.get("WARC-Segment-Number", 1)) - 1
        kind = head.get("WARC-Type", "")
        length, whole = int(head.get("X-Payload-Length", -1)), head.get("WARC-Payload-Digest", "")[5:]
        if number == 0:
            key = _key(head.get("WARC-Record-ID", ""))
            self.at = {"key": key, "kind": kind, "ok": True, "next": 0, "whole": (length, whole)}
            self.at["refers"] = _key(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None
            self.at["target"] = head.get("WARC-Target-URI")
            self.digest, self.so_far = hashlib.sha1(), 0
            if kind == "response":
                data = data.partition(b"\r\n\r\n")[2]
        elif _key(head.get("WARC-Segment-Origin-ID", "")) != self.at.get("key") or number != self.at["next"]:
            self.at = {"key": _key(head.get("WARC-Segment-Origin-ID", "")), "kind": "response", "ok": False, "refers": None}
            self.at["whole"] = (length, whole)
            self.at["target"], self.digest, self.so_far = head.get("WARC-Target-URI"), hashlib.sha1(), 0
        self.at["next"] = number + 1
        self.digest.update(data)
        self.so_far += len(data)
        last = "WARC-Segment-Total-Length" in head or "WARC-Segment-Number" not in head
        if self.at["kind"] == "revisit":
            running, last = head.get("X-Running-Digest", "")[5:], True
            ok = complete and not data
        else:
            running = base32(self.digest.copy().digest())
            ok = complete and running == head.get("X-Running-Digest", "")[5:] and self.at["whole"] == (length, whole)
            if last:
                ok = ok and self.so_far == length and running == whole
        self.at["ok"] = ok = self.at["ok"] and ok
        return (
            self.at["key"], self.at["target"], self.at["kind"], self.at["refers"], length, whole, number, last,
            self.so_far, running, data, ok,
        )


# ---- Spark ----------------------------------------------------------------------------------


def with_record_types(rows: DataFrame) -> DataFrame:
    """``rows`` (record_key, target, payload) with payload_bytes, payload_digest, record_type, refers_to.

    ``record_key`` may have any ordered type. The payload of a revisit is null.
    """
    known = rows.select(
        "record_key",
        "target",
        F.coalesce("payload", F.lit("")).alias("payload"),
        F.octet_length(F.coalesce("payload", F.lit(""))).cast("bigint").alias("payload_bytes"),
        sha1_base32(F.coalesce("payload", F.lit(""))).alias("payload_digest"),
    )
    on = ["payload_digest", "payload_bytes"]
    counts = known.groupBy(*on).agg(F.max("record_key").alias("keeper"), F.count("*").alias("many"))
    shared = staged(counts.where("many > 1"))
    least = known.count() / HOT
    # Fewer than HOT groups can have more than one in HOT of all rows, so this broadcast is bounded.
    hot = shared.where(F.col("many") > least).select(*on, F.struct("keeper").alias("hot"))
    found = known.join(F.broadcast(hot), on, "left")
    found = found.withColumn("payload", F.when(_kept("hot"), F.col("payload")))
    # A key without a partner, another one for each row, keeps what is settled from meeting in one task.
    settled = F.concat(F.lit("-"), F.xxhash64(F.col("record_key").cast("string"), F.rand(17)).cast("string"))
    found = found.withColumn("join_digest", F.when(F.col("hot").isNull(), F.col("payload_digest")).otherwise(settled))
    rest = shared.where(F.col("many") <= least).select(
        F.col("payload_digest").alias("join_digest"), "payload_bytes", F.struct("keeper").alias("cold")
    )
    found = found.join(rest, ["join_digest", "payload_bytes"], "left").withColumn("of", F.coalesce("hot", "cold"))
    kept = _kept("of")
    return found.select(
        "record_key",
        "target",
        F.when(kept, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(kept, "response").otherwise("revisit").alias("record_type"),
        F.when(~kept, F.col("of.keeper")).alias("refers_to"),
    )


def _kept(group: str) -> Column:
    """Whether a row holds the payload of its group of equal ones; a row without a group does."""
    return F.col(group).isNull() | F.col(f"{group}.keeper").eqNullSafe(F.col("record_key"))


def chunk_table(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunk rows (see :data:`CHUNKS`) of typed records, in the order of the rows and of their chunks."""
    text = records.select(
        F.col("record_key").cast("string"),
        "target",
        F.col("payload").cast("binary").alias("payload"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("string"),
    )
    kind = StructType.fromDDL(CHUNKS)
    kinds = {f.name: t for f, t in zip(kind.fields, _arrow_kinds(), strict=True)}

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], list(kinds))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            names = ("record_key", "target", "payload_bytes", "payload_digest", "record_type", "refers_to")
            meta = zip(*(batch.column(c).to_pylist() for c in names), strict=True)
            for payload, (key, target, length, whole, kind_, refers) in zip(batch.column("payload"), meta, strict=True):
                view = memoryview(payload.as_buffer() if payload.is_valid else b"")
                for number, data, last, so_far, digest in chunks_of(view, size):
                    if kind_ == "revisit":
                        digest = whole
                    out.append((key, target, kind_, refers, length, whole, number, last, so_far, digest, bytes(data), True))
                    held += len(data)
                    if held >= _BATCH:
                        yield batch_of(out)
                        out, held = [], 0
        yield batch_of(out)

    return text.mapInArrow(work, kind)


def _arrow_kinds() -> list[pa.DataType]:
    text, whole = pa.string(), pa.int64()
    return [text, text, text, text, whole, text, pa.int32(), pa.bool_(), whole, text, pa.binary(), pa.bool_()]


def write_archives(chunks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write chunk rows as gzipped archives, one for each partition. A record's chunks must follow one another."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.drop_columns(["data"]).to_pylist()
            lines = [segment(row, data.as_py()) for row, data in zip(rows, batch.column("data"), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["value"])

    # The sink ends every row with the second of the two line breaks that end a record.
    lines = chunks.mapInArrow(work, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.mode(mode).option("lineSep", END).option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The chunk rows of archives that :func:`write_archives` wrote."""
    lines = spark.read.option("lineSep", END).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    names = StructType.fromDDL(CHUNKS).names

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            files = batch.column("file").dictionary_encode()
            named = files.dictionary.to_pylist()
            for at, line in zip(files.indices.to_pylist(), batch.column("value"), strict=True):
                yield named[at], line.as_py()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for row in Reader().lines(values(batches)):
            out.append(row)
            held += len(row[10]) + 256
            if held >= _BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _arrow_kinds(), strict=True)], names)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _arrow_kinds(), strict=True)], names)

    return lines.mapInArrow(work, CHUNKS)


def archive_report(pages: DataFrame, size: int = CHUNK) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, target, chunks, intact: ``pages`` (page_id,
    url, html) written to archives in the shared folder and read back, a row for each record's last chunk."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("record_key"), F.col("url").alias("target"), F.col("html").alias("payload")
    )
    path = new_path(pages.sparkSession)
    write_archives(chunk_table(with_record_types(rows), size), path)
    last = read_archives(pages.sparkSession, path).where("last")
    key = F.nullif("record_key", F.lit("")).cast("bigint")
    read = F.col("record_type") == "response"
    return last.select(
        key.alias("page_id"),
        F.when(read, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        "record_type",
        F.nullif("refers_to", F.lit("")).cast("bigint").alias("refers_to"),
        "target",
        (F.col("chunk") + 1).alias("chunks"),
        "intact",
    )


_DIGITS = " || ".join(
    f"substr('{_ALPHABET}', 1 + (((('0x' || substr(h, {at}, 10))::BIGINT) >> {shift}) & 31)::INT, 1)"
    for at in (1, 11, 21, 31)
    for shift in range(35, -1, -5)
)
#: DuckDB SQL for :func:`archive_report`'s rows.
ARCHIVE_SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_DIGITS} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to,
  url AS target, greatest(1, (strlen(html) + {CHUNK - 1}) // {CHUNK})::INT AS chunks, TRUE AS intact
FROM k
"""

"""WARC archives: writing captures, reading records, and putting transactions
together again.

``write_archives`` writes three records per capture: a request, a response (or
a revisit, where the payload is stored elsewhere) and a metadata record, the
first and last pointing to the middle one by ``WARC-Concurrent-To``. Spark's
text writer makes the files: the two line breaks that end a WARC record are
its line separator, so no task opens a file by itself.

``read_records`` takes archives through Spark's binary file reader and cuts
records by their ``Content-Length``; payloads may hold anything, record ends
included. ``assemble`` joins the records of a transaction on the identifier
they share and gives one nested row per capture; ``resolve`` then finds each
revisit's original by ``WARC-Refers-To``.

Memory: an archive holds at most ``captures_per_file`` captures and about
``archive_bytes`` of payload: a page of more than one capture's share of that has
an archive of its own. Archives are unpacked as a stream, one record at a
time. Hot payloads: equal payloads meet in a map-side
aggregate of digests; the join that follows is one that Spark splits by itself
where a digest is frequent, and only one row of a group carries the payload.

Defined cases: a null payload is an empty one; a null id or URL is left out of
its header and comes back as null; rows that repeat the smallest id of a group
are all responses; an empty table writes no record and gives no rows; a very
long page is written and read whole (a record is one Spark string, 2 GB at
most); a transaction without request, response or metadata has null there; a
record without a readable length ends where the next one begins; one that names
neither itself nor another is a capture of its own, named by its archive and
place; other columns are not archived. The input must give the same rows each time it is
read (a table, not a sample).
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.common import row_number, stored

MIN_REVISIT_BYTES = 100
CAPTURES_PER_FILE = 1000
ARCHIVE_BYTES = 256 << 20
CAPTURE_DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
# Profile of the WARC 1.1 standard for revisits by equal digest.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("concurrent_to", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("capture_key", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _urn(kind: str, row: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.lit(kind), row.cast("string")).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    lines: list[Column] = [F.lit("WARC/1.1" + CRLF)]
    for name, value in headers:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    size = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("Content-Length: "), size, F.lit(CRLF + CRLF), block)


def _one_line(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    captures_per_file: int = CAPTURES_PER_FILE,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = CAPTURE_DATE,
) -> None:
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        _one_line(F.col(url_col)).alias("url"),
        payload.alias("body"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).alias("n"),
        row_number(pages).alias("row"),
    )
    # only digests that occur twice or more can have revisits
    firsts = stored(
        rows.where(F.col("n") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "row"))).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and first is not null")
        .select("digest", "first"),
        "warc-firsts",
    )
    rows = rows.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first.id"))
    main = _urn("response", F.col("row"))
    target = ("WARC-Target-URI", F.col("url"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "),
        F.col("n").cast("string"),
        F.lit(CRLF + CRLF),
    )
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    request = _record(
        [
            ("WARC-Type", "request"),
            ("WARC-Record-ID", _urn("request", F.col("row"))),
            ("WARC-Concurrent-To", main),
            ("WARC-Date", date),
            target,
            ("Content-Type", "application/http; msgtype=request"),
        ],
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{CRLF}{CRLF}")),
    )
    response = _record(
        [
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", main),
            ("WARC-Date", date),
            target,
            ("WARC-Payload-Digest", digest),
            ("WARC-Refers-To", F.when(revisit, _urn("response", F.col("first.row")))),
            ("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body"))),
    )
    metadata = _record(
        [
            ("WARC-Type", "metadata"),
            ("WARC-Record-ID", _urn("metadata", F.col("row"))),
            ("WARC-Concurrent-To", main),
            ("WARC-Date", date),
            target,
            ("Content-Type", "application/warc-fields"),
        ],
        F.coalesce(F.concat(F.lit("capture-key: "), F.col("id").cast("string"), F.lit(CRLF)), F.lit("")),
    )
    end = F.lit(CRLF + CRLF)
    long = F.col("n") > archive_bytes // captures_per_file
    for part, captures in ((rows.where(~long), captures_per_file), (rows.where(long), 1)):
        (
            part.select(F.concat(request, end, response, end, metadata).alias("value"))
            .write.mode("append")
            .option("lineSep", CRLF + CRLF)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", captures)
            .text(path)
        )


class _Stream:
    """Bytes of an archive, unpacked as they are asked for; gzip members may
    follow one another, and plain archives are read as they are."""

    def __init__(self, content: memoryview, step: int = 1 << 20):
        self.content, self.step, self.at = content, step, 0
        self.packed = bytes(content[:2]) == b"\x1f\x8b"
        self.unpacker = zlib.decompressobj(31) if self.packed else None
        self.buffer = bytearray()

    def _more(self) -> bool:
        while self.at < len(self.content):
            part = self.content[self.at : self.at + self.step]
            self.at += len(part)
            if not self.packed:
                self.buffer += part
                return True
            out = self.unpacker.decompress(part)
            if self.unpacker.eof:
                self.at -= len(self.unpacker.unused_data)
                self.unpacker = zlib.decompressobj(31)
            if out:
                self.buffer += out
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and without ``mark``; None at the end."""
        looked = 0
        while (to := self.buffer.find(mark, looked)) < 0:
            looked = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                return None
        out = bytes(self.buffer[:to])
        del self.buffer[: to + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _block(stream: _Stream, stated: str) -> bytes:
    if stated.isdecimal():
        block = stream.take(int(stated))
        stream.take(4)
        return block
    # no length to go by; the next record's first line is not needed
    block = stream.until(b"\r\n\r\nWARC/")
    return stream.take(sys.maxsize).removesuffix(b"\r\n\r\n") if block is None else block


def _records(content: memoryview, with_payload: bool, archive: str = "") -> Iterator[tuple]:
    stream, place = _Stream(content), -1
    while (head := stream.until(b"\r\n\r\n")) is not None:
        place += 1
        f = _fields(head)
        block = _block(stream, f.get("content-length", ""))
        kind, payload, size, digest, key = f.get("warc-type"), None, None, None, None
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            if kind == "revisit":  # payload is elsewhere: what the headers say of it
                stated = _fields(http).get("content-length")
                size = int(stated) if stated and stated.isdecimal() else None
                digest = f.get("warc-payload-digest", "").removeprefix("sha256:") or None
        elif kind == "metadata":
            key = _fields(b"\r\n" + block).get("capture-key")
        ident, concurrent = f.get("warc-record-id"), f.get("warc-concurrent-to")
        yield (
            f"<{archive}#{place}>" if ident is None and concurrent is None else ident,
            kind,
            concurrent,
            f.get("warc-refers-to"),
            f.get("warc-date"),
            f.get("warc-target-uri"),
            f.get("content-type"),
            size,
            digest,
            key,
            payload if with_payload else None,
        )


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives in ``path``. Digests and sizes of
    responses are taken from the bytes that were read."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in RECORD.names]
        )

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
            )

        for batch in batches:
            for content, archive in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                held = 0
                for row in _records(memoryview(content.as_buffer()), with_payload, archive):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content", "path")
    return files.mapInArrow(task, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture_id, request, response, metadata``, each
    the smallest of its kind, and the others of the kind, sorted, in
    ``more_requests, more_responses, more_metadata`` (mostly empty)."""
    each = F.struct(*[F.col(c) for c in RECORD.names])
    kind = F.col("type")
    sorted_records = lambda condition: F.array_sort(F.collect_list(F.when(condition, each)))
    lists = records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        sorted_records(kind == "request").alias("requests"),
        sorted_records(kind.isin("response", "revisit")).alias("responses"),
        sorted_records(kind == "metadata").alias("metadatas"),
    )
    more = lambda name: F.slice(name, F.lit(2), F.size(name))
    return lists.select(
        "capture_id",
        F.get("requests", F.lit(0)).alias("request"),
        F.get("responses", F.lit(0)).alias("response"),
        F.get("metadatas", F.lit(0)).alias("metadata"),
        more("requests").alias("more_requests"),
        more("responses").alias("more_responses"),
        more("metadatas").alias("more_metadata"),
    )


def resolve(captures: DataFrame) -> DataFrame:
    """``captures`` and ``original``: the capture key of what a revisit
    refers to, null for responses."""
    originals = captures.where("response.type = 'response'").select(
        F.col("capture_id").alias("original_id"), F.col("metadata.capture_key").alias("original")
    )
    return captures.join(
        originals, F.col("response.refers_to") == F.col("original_id"), "left"
    ).drop("original_id")

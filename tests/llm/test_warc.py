from __future__ import annotations

import gzip
import hashlib

from tickwise.llm.common import stored
from tickwise.llm.warc import _records, assemble, read_records, resolve, write_archives
from tickwise.session import scratch_path

PAGES = "page_id bigint, url string, html string, digest string, id string, row int"


def captures(spark, rows, **kwargs):
    pages = spark.createDataFrame([(*r, "d", "i", 1) for r in rows], PAGES)
    path = scratch_path(spark, "test-warc")
    write_archives(stored(pages, "test-pages"), path, **kwargs)
    return resolve(assemble(read_records(spark, path)))


def test_round_trip(spark):
    big, tricky = "x" * 300_000, "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nb" * 9
    copy = "é" * 60
    rows = [
        (1, "http://a/", big), (2, None, None), (3, "http://c/\r\nX: y", tricky), (4, "u", copy), (5, "u", copy), (6, "v", copy),
        (7, "w", "small"), (8, "w", "small"), (9, "e", ""), (None, "n", "no id " * 40), (10, "http://a/", tricky),
    ]
    got = captures(spark, rows, captures_per_file=3).collect()
    assert len(got) == len(rows)
    by = {r.metadata.capture_key and int(r.metadata.capture_key): r for r in got}
    for i, _url, html in rows:
        r, body = by[i], (html or "").encode()
        assert r.response.payload_bytes == len(body) and r.response.payload_digest == hashlib.sha256(body).hexdigest()
        assert r.request.concurrent_to == r.response.record_id == r.metadata.concurrent_to == r.capture_id
        assert bytes(r.response.payload) == (b"" if r.response.type == "revisit" else body)
    kinds = {i: (r.response.type, r.original) for i, r in by.items()}
    assert kinds[4] == ("response", None) and kinds[5] == kinds[6] == ("revisit", "4") and kinds[10] == ("revisit", "3")
    assert kinds[7] == kinds[8] == kinds[9] == ("response", None)
    assert by[3].response.target_uri == "http://c/%0D%0AX: y" and by[2].response.target_uri is None


def test_repeated_rows_are_captures_of_their_own(spark):
    body = "y" * 200
    got = captures(spark, [(1, "u", body), (1, "u", body), (2, "u", body), (2, "u", body)]).collect()
    assert sorted((r.metadata.capture_key, r.response.type, r.original or "") for r in got) == [
        ("1", "response", ""), ("1", "response", ""), ("2", "revisit", "1"), ("2", "revisit", "1"),
    ]


def test_copies_with_and_without_an_id(spark):
    """Pages without an id are no original; they revisit the smallest id."""
    body = "z" * 200
    got = captures(spark, [(None, "u", body), (2, "u", body), (1, "u", body)]).collect()
    assert sorted((r.metadata.capture_key or "", r.response.type, r.original or "") for r in got) == [
        ("", "revisit", "1"), ("1", "response", ""), ("2", "revisit", "1"),
    ]
    got = captures(spark, [(None, "u", body), (None, "u", body)]).collect()
    assert [r.response.type for r in got] == ["response", "response"]


def test_no_pages(spark):
    assert captures(spark, []).count() == 0


def record(kind, ident, block, **headers):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", *[f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_members_and_missing_parts(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    parts = [
        record("request", "<q1>", b"GET /", WARC_Concurrent_To="<r1>"),
        record("response", "<r1>", http),
        record("response", "<r2>", http),
        record("request", "<q3>", b"GET /", WARC_Concurrent_To="<r3>"),
    ]
    plain, members = b"".join(parts), b"".join(gzip.compress(p) for p in parts)
    assert list(_records(memoryview(plain), True)) == list(_records(memoryview(members), True))
    (tmp_path / "a.warc.gz").write_bytes(members)
    got = {r.capture_id: r for r in assemble(read_records(spark, str(tmp_path))).collect()}
    assert got["<r1>"].request.record_id == "<q1>" and bytes(got["<r1>"].response.payload) == b"body"
    assert got["<r2>"].request is None and got["<r2>"].metadata is None
    assert got["<r3>"].response is None


def test_long_pages_have_archives_of_their_own(spark):
    rows = [(i, "u", f"{i} " * (400 if i % 5 else 4000)) for i in range(40)]
    pages = spark.createDataFrame([(*r, "d", "i", 1) for r in rows], PAGES)
    path = scratch_path(spark, "test-warc")
    write_archives(stored(pages, "test-pages").coalesce(1), path, captures_per_file=10, archive_bytes=40_000)
    files = spark.read.format("binaryFile").load(path).collect()
    held = [[r[7] for r in _records(memoryview(bytes(f.content)), False) if r[1] == "response"] for f in files]
    assert all(len(h) <= 10 and (sum(h) <= 40_000 or len(h) == 1) for h in held)
    assert sorted(x for h in held for x in h) == sorted(len(html) for _, _, html in rows)
    assert sum(len(h) == 1 and h[0] > 4000 for h in held) == sum(len(html) > 4000 for _, _, html in rows)


def test_unreadable_lengths_and_unnamed_records(spark, tmp_path):
    """A record without a usable length ends at the next one; records without
    any identifier stay apart."""
    http = b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\nmore"

    def odd(length):
        return record("response", "<r0>", http).replace(f"Content-Length: {len(http)}".encode(), length)

    for length in (b"Content-Length: many", b"Content-Length: -7", b"Content-Length: \xc2\xb2", b"X-Other: 1"):
        for parts in ([odd(length), record("response", "<r1>", http)], [record("response", "<r1>", http), odd(length)]):
            for content in (b"".join(parts), b"".join(gzip.compress(p) for p in parts)):
                got = {r[0]: bytes(r[-1]) for r in _records(memoryview(content), True)}
                assert got == {"<r0>": b"body\r\n\r\nmore", "<r1>": b"body\r\n\r\nmore"}
    unnamed = record("metadata", "x", b"a: b").replace(b"WARC-Record-ID: x\r\n", b"")
    (tmp_path / "a.warc").write_bytes(unnamed * 3)
    (tmp_path / "b.warc").write_bytes(unnamed * 2)
    got = assemble(read_records(spark, str(tmp_path))).collect()
    assert len({r.capture_id for r in got}) == len(got) == 5 and all(r.more_metadata == [] for r in got)


def test_every_record_of_a_capture_is_kept(spark):
    from tickwise.llm.warc import RECORD

    def record(kind, name, key=None):
        row = dict.fromkeys(RECORD.names)
        row.update(type=kind, record_id=name, concurrent_to=None if kind == "response" else "r", capture_key=key)
        return tuple(row[n] for n in RECORD.names)

    rows = [record("response", "r"), record("metadata", "m2", "2"), record("metadata", "m1", "1"), record("request", "q1"), record("request", "q2")]
    (got,) = assemble(spark.createDataFrame(rows, RECORD)).collect()
    assert got.capture_id == got.response.record_id == "r" and got.more_responses == []
    assert sorted([got.metadata.record_id, *(m.record_id for m in got.more_metadata)]) == ["m1", "m2"]
    assert sorted([got.request.record_id, *(m.record_id for m in got.more_requests)]) == ["q1", "q2"]

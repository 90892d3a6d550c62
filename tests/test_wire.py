"""The frame codec against the protobuf runtime, all 33 fields and all enum
names, nulls, large integers, and bytes that are no message."""

from __future__ import annotations

import base64
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickwise.functions.quotes import FULL_NAME, decode_quotes, descriptor_set_bytes, encode_frames
from tickwise.functions.wire import decode, encode
from tickwise.schemas import ENUMS, QUOTE_FIELDS, QUOTE_SCHEMA

NAMES = [name for name, _, _ in QUOTE_FIELDS]
BIG = [0, 1, -1, 9007199254740993, -9007199254740993, 2**63 - 1, -(2**63), 300, -129]


@pytest.fixture(scope="module")
def message():
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    pool = descriptor_pool.DescriptorPool()
    for file in descriptor_pb2.FileDescriptorSet.FromString(descriptor_set_bytes()).file:
        pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(FULL_NAME))


def random_rows(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        row = {}
        for name, _, kind in QUOTE_FIELDS:
            if rng.random() < 0.3:
                row[name] = None
            elif kind == "string":
                row[name] = rng.choice(["", "A", "naïve €", "x" * rng.randrange(300)])
            elif kind == "sint64":
                row[name] = rng.choice(BIG)
            elif kind.startswith("enum:"):
                names = list(ENUMS[kind[5:]].values())
                row[name] = names[k % len(names)]
            else:
                row[name] = rng.choice([0.0, 0.5, -1.25, 2.0**99, 3.0])
        rows.append(row)
    return rows


def by_runtime(message, row):
    m = message()
    for name, _, kind in QUOTE_FIELDS:
        v = row.get(name)
        if v is not None:
            setattr(m, name, {n: c for c, n in ENUMS[kind[5:]].items()}[v] if kind.startswith("enum:") else v)
    return m.SerializeToString()


def expected(row):
    """Defaults are absent."""
    first = {name: ENUMS[kind[5:]].get(0) for name, _, kind in QUOTE_FIELDS if kind.startswith("enum:")}
    return {k: None if v in (0, "", None) or v == first.get(k, object()) else v for k, v in row.items()}


TYPE = pa.struct(
    [
        (name, pa.float32() if kind == "float" else pa.float64() if kind == "double" else pa.int64() if kind == "sint64" else pa.string())
        for name, _, kind in QUOTE_FIELDS
    ]
)


def test_encode_equals_the_runtime(message):
    rows = random_rows(400)
    assert encode(pa.array(rows, type=TYPE), QUOTE_FIELDS, ENUMS).to_pylist() == [by_runtime(message, r) for r in rows]


@pytest.mark.parametrize("fields", [NAMES, ["id"], ["dayVolume", "marketHours", "lastMarket"]])
def test_decode_of_runtime_frames(message, fields):
    rows = random_rows(400, 2)
    wanted = [f for f in QUOTE_FIELDS if f[0] in fields]
    got = decode(pa.array([by_runtime(message, r) for r in rows], type=pa.binary()), wanted, ENUMS).to_pylist()
    assert got == [{k: v for k, v in expected(r).items() if k in fields} for r in rows]


def test_any_bytes_are_judged_like_the_runtime(message):
    rng = random.Random(3)
    good = [by_runtime(message, r) for r in random_rows(60, 4)]
    cases = [b"", b"\x00", b"\x08", b"\x0a\x05abc", b"\x0a\x02\xff\xfe", b"\x07", b"\xff" * 11, b"\x9a\x06\x01x", b"\xa0\x06\x05", b"\xa5\x06abcd", b"\xa1\x06abcdefgh"]
    for g in good:
        cases += [g[: rng.randrange(len(g) + 1)], g + g, bytes(b ^ (1 << rng.randrange(8)) if rng.random() < 0.02 else b for b in g)]
    got = decode(pa.array(cases, type=pa.binary()), QUOTE_FIELDS, ENUMS).to_pylist()
    names = {name: kind[5:] for name, _, kind in QUOTE_FIELDS if kind.startswith("enum:")}
    for raw, row in zip(cases, got, strict=True):
        if b"\x0b" in raw or b"\x0c" in raw:
            continue  # may hold a group, which quotes never do
        try:
            m = message.FromString(raw)
        except Exception:
            assert row is None, raw
            continue
        want = dict.fromkeys(NAMES)
        for field, v in m.ListFields():
            want[field.name] = ENUMS[names[field.name]].get(v) if field.name in names else v
        assert str(row) == str(want), raw


def test_columns_through_spark(spark, message):
    rows = random_rows(50, 5)
    df = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], QUOTE_SCHEMA)
    frames = df.select(encode_frames(F.struct(*NAMES)).alias("frame"))
    got = sorted(r.frame for r in frames.collect())
    assert got == sorted(base64.b64encode(by_runtime(message, r)).decode() for r in rows)
    back = sorted(str(r.quote.asDict()) for r in decode_quotes(frames).collect())
    assert back == sorted(str(expected(r)) for r in rows)
    odd = spark.createDataFrame([(None,), ("%%%",), ("",), ("/w==",)], "frame string")
    assert [r.quote is None for r in decode_quotes(odd, fields=["id", "time"]).collect()] == [True, True, False, True]


def test_bytes_by_hand():
    """The wire format spelled out: tag, then varint, four bytes or a length and its bytes."""
    hands = [
        b"\x0a\x04AAPL" + b"\x15\x00\x00\x20\x41" + b"\x18\xd0\x0f" + b"\x38\x01",
        b"\x18\x03" + b"\x30\x08" + b"\x81\x02\x00\x00\x00\x00\x00\x00\xf8\x3f",
        b"",
    ]
    rows = [
        {"id": "AAPL", "price": 10.0, "time": 1000, "marketHours": "REGULAR_MARKET"},
        {"time": -2, "quoteType": "EQUITY", "circulatingSupply": 1.5},
        {},
    ]
    got = decode(pa.array(hands), QUOTE_FIELDS, ENUMS).to_pylist()
    assert got == [{name: row.get(name) for name in NAMES} for row in rows]
    assert encode(pa.array([{name: row.get(name) for name in NAMES} for row in rows], type=TYPE), QUOTE_FIELDS, ENUMS).to_pylist() == hands


def test_null_rows_part_structs_and_unknown_names():
    part = pa.struct([("other", pa.int32()), ("time", pa.int64()), ("quoteType", pa.string())])
    rows = pa.array([None, {"other": 1, "time": 1, "quoteType": "no such"}, {"other": None, "time": None, "quoteType": "ETF"}], type=part)
    assert encode(rows, QUOTE_FIELDS, ENUMS).to_pylist() == [None, b"\x18\x02", b"\x30\x14"]
    none = pa.array([None, {"other": 1}], type=pa.struct([("other", pa.int32())]))
    assert encode(none, QUOTE_FIELDS, ENUMS).to_pylist() == [None, b""]


def test_empty_batch():
    assert len(decode(pa.array([], type=pa.binary()), QUOTE_FIELDS, ENUMS)) == 0
    assert len(encode(pa.array([], type=TYPE), QUOTE_FIELDS, ENUMS)) == 0

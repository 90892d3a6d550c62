"""a sample batch -> 4 windowed means and 1 reject."""

import datetime as dt

from pyspark.sql import functions as F

from tickwise.functions.parse import parse_ticks, rejected_ticks, valid_ticks
from tickwise.operators.dedup import dedup_ticks
from tickwise.operators.windows import mean_per_key, tumbling_mean

SAMPLE = [
    '{"id": "KETO", "price": 412, "time": "1709290805250", "currency": "EUR"}',
    '{"id": "ZULA", "price": 7.25, "time": "1709290861000"}',
    '{"id": "ZULA", "price": 8.75, "time": "1709290999999", "exchange": "XET"}',
    "<html>502 Bad Gateway</html>",
    '{"id": "MIRO", "price": 0.5, "time": "1709291100000"}',
    '{"id": "ZULA", "price": 11, "time": "1709291099999"}',
    '{"id": "KETO", "price": 398.5, "time": "1709386200001"}',
]


def records(spark):
    rows = [(v, 0, i) for i, v in enumerate(SAMPLE)]
    return spark.createDataFrame(rows, "value string, partition int, offset long")


def test_sample_means(spark):
    parsed = parse_ticks(records(spark))
    out = tumbling_mean(dedup_ticks(valid_ticks(parsed))).orderBy("stock_ticker", "timestamp").collect()
    got = [(r.stock_ticker, r.timestamp.replace(tzinfo=None), r.price) for r in out]
    assert got == [
        ("KETO", dt.datetime(2024, 3, 1, 11, 5), 412.0),
        ("KETO", dt.datetime(2024, 3, 2, 13, 35), 398.5),
        ("MIRO", dt.datetime(2024, 3, 1, 11, 10), 0.5),
        ("ZULA", dt.datetime(2024, 3, 1, 11, 5), 9.0),
    ]
    rej = rejected_ticks(parsed).collect()
    assert [(r.offset, r.reason) for r in rej] == [(3, "malformed")]


def test_exact_millisecond_times(spark):
    # epoch ms must not be squeezed through a 32-bit float
    t = parse_ticks(records(spark)).where(F.col("offset") == 0).first()
    assert t.timestamp.replace(tzinfo=None) == dt.datetime(2024, 3, 1, 11, 0, 5, 250000)


def test_reject_reasons(spark):
    vals = [
        ('{"id":"a","price":1.5,"time":"1000"}',),
        ('{"id":"a","price":1.5,"ti',),
        ('{"x":1}',),
        ('{"id":"a","price":"abc","time":"1000"}',),
        ('{"id":"a","price":2,"time":"soon"}',),
        ('{"price":2,"time":"1000"}',),
        ('{"id":"a","time":"1000"}',),
        ('{"id":"","price":2,"time":"1000"}',),
        ('{"id":"a","price":"NaN","time":"1000"}',),
        ('{"id":"a","price":"-Infinity","time":"1000"}',),
        ('{"id":"a","price":1e39,"time":"1000"}',),
    ]
    parsed = parse_ticks(spark.createDataFrame(vals, "value string"))
    assert [r._reject for r in parsed.collect()] == [
        None, "malformed", "missing id", "missing price", "bad time", "missing id", "missing price",
        "missing id", "missing price", "missing price", "missing price",
    ]
    assert valid_ticks(parsed).count() == 1


def test_dedup_keeps_first_delivery(spark):
    rows = [
        ('{"id":"A","price":1,"time":"1000"}', 0, 5),
        ('{"id":"A","price":2,"time":"1000"}', 0, 3),
        ('{"id":"A","price":3,"time":"2000"}', 1, 9),
        # offsets count per partition: of a tie the lower partition survives
        ('{"id":"B","price":5,"time":"1000"}', 2, 4),
        ('{"id":"B","price":4,"time":"1000"}', 1, 4),
    ]
    for order in (rows, rows[::-1]):
        ticks = valid_ticks(parse_ticks(spark.createDataFrame(order, "value string, partition int, offset long")))
        got = sorted((r.price, r.offset) for r in dedup_ticks(ticks).collect())
        assert got == [(2.0, 3), (3.0, 9), (4.0, 4)]


def test_mean_per_key(spark):
    ticks = dedup_ticks(valid_ticks(parse_ticks(records(spark))))
    got = {r.stock_ticker: r.price for r in mean_per_key(ticks).collect()}
    assert got == {"KETO": 405.25, "ZULA": 9.0, "MIRO": 0.5}


def test_frames_golden(spark):
    """one quote frame and two bad frames."""
    from tickwise.functions.quotes import decode_quotes, encode_frames, quote_json

    frames = spark.createDataFrame(
        [("CgRBQVBMFaRwSEIYkNfqraJkMAg=",), ("!!notb64",), ("AAAA",)], "frame string")
    rows = decode_quotes(frames).select("frame", quote_json(F.col("quote")).alias("j"), "quote").collect()
    assert rows[0].j == '{"id":"AAPL","price":50.11,"time":"1722598381000","quoteType":"EQUITY"}'
    assert rows[0].quote.lastSize is None
    assert rows[1].quote is None and rows[2].quote is None
    q = spark.createDataFrame([("AAPL", 50.11, 1722598381000, "EQUITY", 0)],
                              "id string, price float, time long, quoteType string, lastSize long")
    assert q.select(encode_frames(F.struct(*q.columns)).alias("f")).first().f == "CgRBQVBMFaRwSEIYkNfqraJkMAg="


def test_enum_names(spark):
    from tickwise.functions.quotes import enum_name

    df = spark.createDataFrame([(8,), (1000,), (3,), (None,)], "c int")
    got = [r.n for r in df.select(enum_name(F.col("c"), "QuoteType").alias("n")).collect()]
    assert got == ["EQUITY", "INDUSTRY", None, None]


def test_message_rate_examples_bounded(spark):
    from tickwise.operators.rates import message_rate

    rows = [(f"m{i}".encode(), 0, i, i // 10) for i in range(30)]
    df = spark.createDataFrame(rows, "value binary, partition int, offset long, sec long")
    df = df.withColumn("timestamp", F.timestamp_seconds(F.col("sec") * 20))
    out = {r.interval_start.minute: r for r in message_rate(df).collect()}
    assert out[0].messages == 30 and out[0].example_offsets == "0,1,2,3"
    assert out[0].example_messages.split("\n") == ["m0", "m1", "m2", "m3"]


def test_watchlist_literal_and_semi_join(spark):
    from tickwise.operators.filters import watchlist

    ticks = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0)], "stock_ticker string, price double")
    assert {r.stock_ticker for r in watchlist(ticks, ["A", "C"]).collect()} == {"A", "C"}
    subs = spark.createDataFrame([("B",), ("B",)], "symbol string")
    assert [r.stock_ticker for r in watchlist(ticks, subs).collect()] == ["B"]


def test_topic_payload_names_without_faults(spark):
    """The producer's JSON keeps its field names in every configuration
    (with no replays the copy explode sits next to the payload struct)."""
    import json

    from conftest import SF_SMALL
    from tickwise.plans.events import events_to_topic

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for kw in ({}, {"replay_every": None}, {"corrupt_every": None}, {"replay_every": None, "corrupt_every": None}):
        topic = events_to_topic(events, **kw)
        values = [json.loads(r.v) for r in topic.selectExpr("cast(value as string) v").collect()
                  if r.v.endswith("}")]
        assert values and all(set(v) == {"id", "price", "time"} for v in values), kw
        if kw.get("corrupt_every", 1) is None:
            assert valid_ticks(parse_ticks(topic)).count() == topic.count(), kw

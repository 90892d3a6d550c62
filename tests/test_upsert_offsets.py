"""F4 (upsert) and F5 (lag and readiness)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickwise.operators.offsets import offsets_from_map, topic_lag, topic_ready
from tickwise.operators.upsert import key_violations, upsert_latest
from tickwise.schemas import OUTPUT_SCHEMA
from tickwise.sinks.keyed_table import KeyedTable

D = dt.datetime(2024, 1, 1, 0, 5, tzinfo=dt.timezone.utc)
D2 = dt.datetime(2024, 1, 2, 0, 5, tzinfo=dt.timezone.utc)


def frame(spark, rows):
    return spark.createDataFrame(rows, OUTPUT_SCHEMA)


def as_set(df):
    return {(r.stock_ticker, r.timestamp.replace(tzinfo=None), r.price) for r in df.collect()}


def test_upsert_frame(spark):
    target = frame(spark, [("A", D, 1.0), ("B", D, 2.0)])
    batch = frame(spark, [("A", D, 9.0)])
    assert as_set(upsert_latest(target, batch)) == {("A", D.replace(tzinfo=None), 9.0), ("B", D.replace(tzinfo=None), 2.0)}


def test_keyed_table_upsert_is_idempotent(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "table"))
    t.upsert(frame(spark, [("A", D, 1.0), ("B", D, 2.0), ("C", D2, 3.0)]))
    t.upsert(frame(spark, [("A", D, 9.0)]))
    expected = {("A", D.replace(tzinfo=None), 9.0), ("B", D.replace(tzinfo=None), 2.0), ("C", D2.replace(tzinfo=None), 3.0)}
    assert as_set(t.read()) == expected
    # replay of the batch (restart after a crash) changes nothing
    KeyedTable(spark, str(tmp_path / "table")).upsert(frame(spark, [("A", D, 9.0)]))
    assert as_set(t.read()) == expected
    assert key_violations(t.read()).count() == 0
    t.upsert(frame(spark, []))  # an empty batch
    assert as_set(t.read()) == expected


def files_of(table):
    import glob
    import os

    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table.data}/date=*/*.parquet")}


def test_upsert_leaves_other_dates_alone(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "table"))
    days = [D + dt.timedelta(days=i) for i in range(6)]
    table.upsert(frame(spark, [("A", d, float(i)) for i, d in enumerate(days)]))
    before = files_of(table)
    table.upsert(frame(spark, [("A", days[2], 20.0), ("B", days[4], 40.0), ("A", days[5] + dt.timedelta(days=1), 6.0)]))
    after = files_of(table)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("date=")[1][:10] for f in same} == {str(days[i].date()) for i in (0, 1, 3, 5)}
    assert sorted((r.stock_ticker, r.price) for r in table.read().collect()) == [
        ("A", 0.0), ("A", 1.0), ("A", 3.0), ("A", 4.0), ("A", 5.0), ("A", 6.0), ("A", 20.0), ("B", 40.0),
    ]
    import os

    assert sorted(os.listdir(table.path)) == ["data"]


def test_interrupted_upserts(spark, tmp_path, monkeypatch):
    """Cut short before the staging is finished: nothing has changed. Cut
    short while dates are replaced: the next upsert finishes it first."""
    path = str(tmp_path / "table")
    table = KeyedTable(spark, path)
    table.upsert(frame(spark, [("A", D, 1.0), ("B", D, 2.0)]))
    day, day2 = D.replace(tzinfo=None), D2.replace(tzinfo=None)
    old = {("A", day, 1.0), ("B", day, 2.0)}
    inner = KeyedTable._write

    def dies(folder):
        def write(self, df, target, mode):
            if target.endswith(folder):
                raise RuntimeError("driver lost")
            inner(self, df, target, mode)

        return write

    batch = [("A", D, 5.0), ("C", D2, 3.0)]
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_write", dies("staged"))
        with pytest.raises(RuntimeError):
            table.upsert(frame(spark, batch))
    assert as_set(table.read()) == old
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_write", dies("data"))
        with pytest.raises(RuntimeError):
            table.upsert(frame(spark, batch))
    # half of the replacement happened: a touched date is gone
    from tickwise.session import delete_path

    delete_path(spark, f"{table.data}/date={D.date()}")
    again = KeyedTable(spark, path)
    again.upsert(frame(spark, [("B", D, 7.0)]))
    assert as_set(again.read()) == {("A", day, 5.0), ("B", day, 7.0), ("C", day2, 3.0)}


def test_rate_of_a_far_off_timestamp(spark):
    """One outlier makes many empty intervals: made in chunks, none is one array."""
    from tickwise.operators.rates import message_rate

    rows = [(D, 0, 1, "m"), (dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc), 0, 2, "n")]
    records = spark.createDataFrame(rows, "timestamp timestamp, partition int, offset bigint, value string")
    every = message_rate(records, "1 hour", every_interval=True)
    got = every.agg(F.count("*").alias("n"), F.sum("messages").alias("m"), F.max("interval_start").alias("t")).first()
    assert (got.n, got.m) == ((rows[1][0] - D.replace(minute=0)).total_seconds() // 3600 + 1, 2)


def test_key_violations(spark):
    df = frame(spark, [("A", D, 1.0), ("B", D, 2.0)]).unionByName(frame(spark, [("A", D, 3.0)]))
    rows = key_violations(df).collect()
    assert [(r.stock_ticker, r.copies) for r in rows] == [("A", 2)]


CASES = [
    ("none new", {0: 10, 1: 10}, {0: 10, 1: 10}, {0: 0, 1: 0}, False),
    ("below", {0: 10, 1: 10}, {0: 20, 1: 12}, {0: 10, 1: 2}, False),
    ("at threshold", {0: 0}, {0: 25}, {0: 25}, True),
    ("low partition first", {0: 10, 1: 0}, {0: 12, 1: 100}, {0: 2, 1: 100}, True),
    ("unseen partition", {0: 10}, {0: 10, 1: 30}, {0: 0, 1: 30}, True),
]


@pytest.mark.parametrize("name,committed,end,lag,ready", CASES, ids=[c[0] for c in CASES])
def test_lag_and_ready(spark, name, committed, end, lag, ready):
    ends = offsets_from_map(spark, end, "end_offset")
    comm = offsets_from_map(spark, committed, "committed_offset")
    lags = topic_lag(ends, comm)
    assert {r.partition: r.lag for r in lags.collect()} == lag
    r = topic_ready(lags).first()
    assert r.ready is ready
    assert r.total_lag == sum(lag.values())


def test_bounded_read_ranges(spark, tmp_path):
    """[start, end) per named partition; a partition named in neither map is read whole."""
    from tickwise.schemas import TOPIC_SCHEMA
    from tickwise.sources.topic import DEFAULT_TOPIC, append_segment, bounded_read

    rows = [
        (None, b"x", DEFAULT_TOPIC, p, o, D, 0)
        for p in range(3)
        for o in range(10)
    ]
    path = str(tmp_path / "topic")
    append_segment(spark.createDataFrame(rows, TOPIC_SCHEMA), path)
    got = bounded_read(spark, path=path, starting={0: 3, 1: 8}, ending={0: 6})
    pairs = sorted((r.partition, r.offset) for r in got.select("partition", "offset").collect())
    assert pairs == [(0, 3), (0, 4), (0, 5), (1, 8), (1, 9)] + [(2, o) for o in range(10)]


def test_merge_statement_text():
    """K3/K4 JDBC path: the one statement sent to the database (text only;
    running it needs a database server)."""
    from tickwise.sinks.jdbc import merge_statement

    cols = ["stock_ticker", "timestamp", "price"]
    keys = ["stock_ticker", "timestamp"]
    pg = merge_statement("stock_data", "stage_q_7", cols, keys)
    assert pg == (
        'INSERT INTO stock_data ("stock_ticker", "timestamp", "price") '
        'SELECT "stock_ticker", "timestamp", "price" FROM stage_q_7 '
        'ON CONFLICT ("stock_ticker", "timestamp") DO UPDATE SET "price" = EXCLUDED."price"'
    )
    std = merge_statement("stock_data", "stage_q_7", cols, keys, dialect="merge")
    assert std == (
        'MERGE INTO stock_data t USING stage_q_7 s ON t."stock_ticker" = s."stock_ticker" '
        'AND t."timestamp" = s."timestamp" WHEN MATCHED THEN UPDATE SET "price" = s."price" '
        'WHEN NOT MATCHED THEN INSERT ("stock_ticker", "timestamp", "price") '
        'VALUES (s."stock_ticker", s."timestamp", s."price")'
    )

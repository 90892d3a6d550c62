"""Panes of a window: early, on time, late, expired; across restarts."""

import datetime as dt

import pytest

from tickwise.operators.panes import EARLY, LATE, ON_TIME, paned_mean

SCHEMA = "stock_ticker string, timestamp timestamp, price float, offset bigint"
START = dt.datetime(2024, 1, 1)


@pytest.fixture
def job(spark, tmp_path):
    """A function that appends rows ``(ticker, minute, price, offset)``, drains
    the stream on one checkpoint and gives the panes so far."""

    def run(rows, **kwargs):
        full = [(t, START + dt.timedelta(minutes=m), float(p), o) for t, m, p, o in rows]
        spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        panes = paned_mean(stream, allowed_lateness="1 hour", **kwargs)
        writer = panes.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out")).collect()
        minute = lambda t: int((t - START).total_seconds() // 60)
        return sorted((r.stock_ticker, minute(r.timestamp), r.pane_index, r.pane, r.price, r.rows) for r in got)

    return run


@pytest.mark.parametrize("slot_windows", [1, 12])
def test_panes_of_a_window(job, slot_windows):
    first = job([("a", 1, 1, 1), ("a", 2, 3, 2), ("a", 30, 5, 3), ("b", 8, 1, 4)], slot_windows=slot_windows)
    assert first == [
        ("a", 5, 0, EARLY, 2.0, 2),
        ("a", 5, 1, ON_TIME, 2.0, 2),
        ("a", 35, 0, EARLY, 5.0, 1),  # the watermark is at minute 15
        ("b", 10, 0, EARLY, 1.0, 1),
        ("b", 10, 1, ON_TIME, 1.0, 1),
    ]
    # late rows fire one by one in event-time order; a window that closed empty is late at once
    second = job([("a", 4, 4, 5), ("a", 3, 8, 6), ("c", 1, 7, 7), ("a", 31, 1, 8), ("a", 80, 1, 9)], slot_windows=slot_windows)
    assert [p for p in second if p not in first] == [
        ("a", 5, 2, LATE, 4.0, 3),
        ("a", 5, 3, LATE, 4.0, 4),
        ("a", 35, 1, EARLY, 3.0, 2),
        ("a", 35, 2, ON_TIME, 3.0, 2),
        ("a", 85, 0, EARLY, 1.0, 1),
        ("c", 5, 0, LATE, 7.0, 1),
    ]
    # the watermark is at minute 65: the window of minute 5 has expired, that of minute 10 has not
    third = job([("a", 3, 8, 10), ("b", 9, 4, 11)], slot_windows=slot_windows)
    assert [p for p in third if p not in second] == [("b", 10, 2, LATE, 2.5, 2)]


def test_without_early_panes(job):
    assert job([("a", 1, 1, 1), ("a", 60, 3, 2)], early=False) == [("a", 5, 0, ON_TIME, 1.0, 1)]

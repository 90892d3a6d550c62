"""Running rate monitor, first deliveries, changing watchlist, state reader."""

import datetime as dt

from pyspark.sql import functions as F

from tickwise.operators.dedup import first_deliveries
from tickwise.operators.live_rate import live_message_rate
from tickwise.operators.windows import tumbling_mean, with_event_time
from tickwise.sources.state import keys_per_partition, open_windows, state_operators
from tickwise.streaming.jobs import changelog_batches, latest_per_key, watched_batches

START = dt.datetime(2024, 1, 1)
RECORDS = "timestamp timestamp, partition int, offset bigint, value binary"
TICKS = "stock_ticker string, timestamp timestamp, price float, offset bigint"


def append(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def drain(df, base, mode, **how):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/c").trigger(availableNow=True)
    if "foreach_batch" in how:
        writer.foreachBatch(how["foreach_batch"]).start().awaitTermination()
    else:
        writer.format(how.get("sink", "parquet")).start(f"{base}/out").awaitTermination()


def test_no_progress_is_missed_between_two_polls(spark, tmp_path):
    """More micro-batches than a query remembers, seen by one poll at the end."""
    from tickwise.streaming.control import RunReadout, run_until_idle
    from tickwise.streaming.jobs import start

    n = 110
    spark.range(n).repartitionByRange(n, "id").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    readout = RunReadout()
    q = start(stream, name="many", checkpoint=f"{tmp_path}/c", mode="append", trigger={"availableNow": True}, sink="noop")
    assert run_until_idle(q, poll_seconds=600, on_progress=readout.on_progress) == "finished"
    assert len(q.recentProgress) <= 100
    assert readout.input_rows == n and [b for b, _ in readout.batch_rows] == list(range(len(readout.batch_rows)))
    assert len(readout.batch_rows) > 100


def test_rate_keeps_a_bounded_number_of_messages(spark, tmp_path):
    """A minute that is delivered in three batches, newest first, and one that
    many messages share."""
    base, seconds = str(tmp_path), lambda s: START + dt.timedelta(seconds=s)
    batches = [
        [(seconds(30 + i), 0, 100 + i, f"m{100 + i}".encode()) for i in range(20)],
        [(seconds(i), 1, i, f"m{i}".encode()) for i in range(3)] + [(seconds(70), 0, 200, None)],
        [(seconds(2), 0, 7, b"first of its second")],
    ]
    for rows in batches:
        stream = append(spark, rows, RECORDS, f"{base}/in")
        drain(live_message_rate(stream, slot_intervals=2), base, "update", foreach_batch=changelog_batches(f"{base}/log"))
    got = latest_per_key(spark.read.parquet(f"{base}/log"), ("interval_start",)).orderBy("interval_start").collect()
    assert [(r.messages, r.example_offsets) for r in got] == [(24, "0,1,7,2"), (1, "200")]
    assert got[0].example_messages == "m0\nm1\nfirst of its second\nm2"


def test_first_delivery_survives_whatever_comes_first(spark, tmp_path):
    base, at = str(tmp_path), lambda m: START + dt.timedelta(minutes=m)
    late_copies = [("a", at(1), 9.0, 5), ("a", at(2), 2.0, 4), ("b", at(1), 3.0, 6)]
    originals = [("a", at(1), 1.0, 1), ("a", at(60), 5.0, 7), ("a", at(2), 8.0, 9)]
    for rows in (late_copies, originals):
        stream = with_event_time(append(spark, rows, TICKS, f"{base}/in"), "timestamp", "15 minutes")
        drain(first_deliveries(stream), base, "append")
    got = spark.read.parquet(f"{base}/out").collect()
    assert sorted((r.stock_ticker, r.price, r.offset) for r in got) == [("a", 1.0, 1), ("a", 2.0, 4), ("b", 3.0, 6)]


def test_watchlist_changes_between_batches(spark, tmp_path):
    base = str(tmp_path)
    rows = [(t, START, 1.0, i) for i, t in enumerate("abca")]
    for symbols in ("a", "bc"):
        spark.createDataFrame([(s,) for s in symbols], "stock_ticker string").write.mode("overwrite").parquet(f"{base}/list")
        stream = append(spark, rows, TICKS, f"{base}/in")
        drain(stream, base, "append", foreach_batch=watched_batches(f"{base}/list", changelog_batches(f"{base}/log")))
    got = spark.read.parquet(f"{base}/log").groupBy("batch_id").agg(F.sort_array(F.collect_list("stock_ticker")).alias("t"))
    assert sorted((r.batch_id, r.t) for r in got.collect()) == [(0, ["a", "a"]), (1, ["b", "c"])]


def test_open_windows_are_in_the_state(spark, tmp_path):
    base, at = str(tmp_path), lambda m: START + dt.timedelta(minutes=m)
    stream = append(spark, [("a", at(m), float(m), m) for m in (0, 31, 32, 41)] + [("b", at(40), 2.0, 9)], TICKS, f"{base}/in")
    drain(tumbling_mean(with_event_time(stream, "timestamp", "15 minutes")), base, "append")
    got = open_windows(spark, f"{base}/c").collect()
    assert sorted((r.stock_ticker, r.timestamp, r.price, r.rows) for r in got) == [
        ("a", at(35), 31.5, 2), ("a", at(45), 41.0, 1), ("b", at(45), 2.0, 1),
    ]
    assert keys_per_partition(spark, f"{base}/c").agg(F.sum("keys")).first()[0] == 3
    assert [r.operator for r in state_operators(spark, f"{base}/c").collect()] == ["stateStoreSave"]

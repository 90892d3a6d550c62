"""End to end: gate -> run until drained -> keyed table + offsets -> gate closed."""

import pytest
from pyspark.sql import functions as F

from tickwise.plans.common import topic_records
from tickwise.sinks.keyed_table import KeyedTable
from tickwise.sources.topic import append_segment
from tickwise.streaming.app import ready_to_start, run_tick_job, waiting_options
from tickwise.operators.dedup import dedup_ticks
from tickwise.operators.windows import tumbling_mean
from tickwise.functions.parse import parse_ticks, valid_ticks
from tickwise.session import checkpoint_root
from tickwise.sources.topic import read_topic
from tickwise.streaming.control import RunReadout, run_until_idle
from tickwise.streaming.jobs import changelog_batches, start, tee_batches, tick_means, upsert_batches

SF = "/root/testdata/sf0.001"


def test_gated_job_end_to_end(spark, tmp_path):
    src, base = str(tmp_path / "topic"), str(tmp_path / "job")
    records = topic_records(spark, SF)
    append_segment(records, src)
    kw = dict(name="ticks_e2e", offsets_path=f"{base}/offsets", source_path=src)
    assert ready_to_start(spark, **kw).first().ready
    why = run_tick_job(spark, checkpoint=f"{base}/ckpt", table_path=f"{base}/table",
                       trigger={"availableNow": True}, poll_seconds=0.5,
                       changelog_path=f"{base}/changes", **{k: kw[k] for k in ("name", "offsets_path", "source_path")})
    assert why == "finished"
    gate = ready_to_start(spark, **kw).first()
    assert gate.ready is False and gate.total_lag == 0
    table = KeyedTable(spark, f"{base}/table").read()
    expected = tumbling_mean(dedup_ticks(valid_ticks(parse_ticks(records))))
    a = {(r.stock_ticker, r.timestamp, round(r.price, 6)) for r in table.collect()}
    b = {(r.stock_ticker, r.timestamp, round(r.price, 6)) for r in expected.collect()}
    assert a == b
    assert spark.read.parquet(f"{base}/changes").count() >= len(b)


def test_gate_closes_whatever_the_number_of_partitions(spark, tmp_path):
    src, base = str(tmp_path / "topic"), str(tmp_path / "job")
    append_segment(topic_records(spark, SF, partitions=6), src)
    kw = dict(name="six", offsets_path=f"{base}/offsets", source_path=src)
    readout = RunReadout()
    run_tick_job(spark, checkpoint=f"{base}/ckpt", table_path=f"{base}/table", trigger={"availableNow": True},
                 poll_seconds=0.5, readout=readout, **kw)
    gate = ready_to_start(spark, **kw).first()
    assert (gate.ready, gate.total_lag, gate.partitions) == (False, 0, 6)
    assert readout.input_rows == topic_records(spark, SF).count() and readout.late_rows == 0
    # what is appended afterwards waits
    append_segment(topic_records(spark, SF, partitions=6).withColumn("offset", F.col("offset") + 1_000_000), src)
    assert ready_to_start(spark, **kw).first().partitions_ready == 6


def test_kafka_branches_build_their_options(spark, monkeypatch):
    """No connector here: the options that the readers would get."""
    import tickwise.sources.topic as topic

    seen = []
    monkeypatch.setattr(topic, "read_topic", lambda *a, **k: seen.append(k["options"]))
    topic.bounded_read(spark, fmt="kafka", topic="t", starting={0: 5}, ending={1: 9})
    assert seen == [{"startingOffsets": '{"t": {"0": 5, "1": -2}}', "endingOffsets": '{"t": {"0": -1, "1": 9}}'}]
    assert waiting_options({1: 7, 0: 3}, "t", {"kafka.bootstrap.servers": "h"}) == {
        "kafka.bootstrap.servers": "h", "startingOffsets": '{"t": {"0": 3, "1": 7}}',
    }
    assert waiting_options({}, "t") == {}
    values = spark.createDataFrame([(b"v", 1)], "value binary, other int")
    assert topic.kafka_record(values).columns == ["value"]
    assert topic.kafka_record(values.withColumn("key", F.lit(None))).columns == ["key", "value"]


def test_tee_computes_a_batch_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    one = F.udf(count, "double").asNondeterministic()
    batch = spark.range(100).select(
        F.lit("A").alias("stock_ticker"), F.timestamp_seconds("id").alias("timestamp"), one(F.col("id").cast("double")).alias("price")
    )
    table = KeyedTable(spark, str(tmp_path / "t"))
    tee_batches(upsert_batches(table), changelog_batches(str(tmp_path / "log")))(batch, 0)
    assert seen.value == 100 and table.read().count() == 100 and spark.read.parquet(str(tmp_path / "log")).count() == 100


def test_fast_query_hands_over_its_progress(spark, tmp_path):
    append_segment(topic_records(spark, SF), str(tmp_path / "topic"))
    query = start(read_topic(spark, path=str(tmp_path / "topic")), name="fast", checkpoint=str(tmp_path / "c"),
                  mode="append", trigger={"availableNow": True}, sink="noop")
    query.awaitTermination()  # ended before the first poll
    seen = []
    assert run_until_idle(query, on_progress=seen.append) == "finished"
    assert sum(p["numInputRows"] for p in seen) == topic_records(spark, SF).count()


def test_state_partitions_follow_the_session(spark, tmp_path):
    src = str(tmp_path / "topic")
    append_segment(topic_records(spark, SF), src)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for wanted, given in ((3, None), (2, 2)):
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        try:
            q = start(tick_means(read_topic(spark, path=src)), name=f"state{wanted}", checkpoint=str(tmp_path / f"c{wanted}"),
                      trigger={"availableNow": True}, sink="noop", state_partitions=given)
            q.awaitTermination()
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        import os

        stores = [d for d in os.listdir(tmp_path / f"c{wanted}" / "state" / "0") if d.isdigit()]
        assert len(stores) == wanted


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())

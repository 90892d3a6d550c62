"""Checkpoint offset reader (Kafka-shaped and real file-source checkpoints),
idle stop and gated start."""

import json
import os

from tickwise.operators.offsets import offsets_from_map, topic_lag, topic_ready
from tickwise.sources.checkpoint import checkpoint_offsets, committed_topic_offsets
from tickwise.streaming.control import run_if_ready, run_until_idle
from tickwise.streaming.jobs import start, tick_means


def write_offsets(ckpt, batch, ts, offsets, committed):
    os.makedirs(os.path.join(ckpt, "offsets"), exist_ok=True)
    os.makedirs(os.path.join(ckpt, "commits"), exist_ok=True)
    meta = {"batchWatermarkMs": 0, "batchTimestampMs": ts, "conf": {}}
    with open(os.path.join(ckpt, "offsets", str(batch)), "w") as fh:
        fh.write("v1\n" + json.dumps(meta) + "\n" + json.dumps(offsets))
    if committed:
        with open(os.path.join(ckpt, "commits", str(batch)), "w") as fh:
            fh.write('v1\n{"nextBatchWatermarkMs":0}')


def test_kafka_shaped_checkpoint(spark, tmp_path):
    ckpt = str(tmp_path / "ckpt")
    write_offsets(ckpt, 0, 1000, {"data_stream": {"0": 5, "1": 7}}, True)
    write_offsets(ckpt, 1, 2000, {"data_stream": {"0": 9, "1": 7, "2": 3}}, True)
    write_offsets(ckpt, 2, 3000, {"data_stream": {"0": 20, "1": 30, "2": 40}}, False)  # write not finished
    with open(os.path.join(ckpt, "offsets", "1.bak"), "w") as fh:  # names with an extension are skipped
        fh.write("garbage")
    rows = checkpoint_offsets(spark, ckpt).collect()
    assert {(r.batch_id, r.partition, r.offset, r.committed) for r in rows} == {
        (0, 0, 5, True), (0, 1, 7, True),
        (1, 0, 9, True), (1, 1, 7, True), (1, 2, 3, True),
        (2, 0, 20, False), (2, 1, 30, False), (2, 2, 40, False),
    }
    committed = committed_topic_offsets(spark, ckpt, "data_stream")
    assert {r.partition: r.committed_offset for r in committed.collect()} == {0: 9, 1: 7, 2: 3}
    lag = topic_lag(offsets_from_map(spark, {0: 12, 1: 100, 2: 3}, "end_offset"), committed)
    assert {r.partition: r.lag for r in lag.collect()} == {0: 3, 1: 93, 2: 0}


def write_ticks(src, name, lines, mtime):
    os.makedirs(src, exist_ok=True)
    p = os.path.join(src, name)
    with open(p, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.utime(p, (mtime, mtime))


def test_real_checkpoint_and_idle_stop(spark, tmp_path):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    write_ticks(src, "a.json", ['{"id":"A","price":1,"time":"1000"}'], 1_000_000)
    stream = spark.readStream.text(src)
    q = start(tick_means(stream), name="idle_stop", checkpoint=ckpt, mode="update",
              trigger={"processingTime": "200 milliseconds"}, sink="noop")
    seen = []
    why = run_until_idle(q, max_idle_seconds=2, poll_seconds=0.3, on_progress=seen.append)
    assert why == "idle" and not q.isActive
    assert any(p.get("numInputRows", 0) > 0 for p in seen)
    rows = checkpoint_offsets(spark, ckpt).collect()
    assert rows and all(r.topic is None for r in rows)  # file source: one logOffset per batch
    assert any(r.committed for r in rows)


def test_gated_start(spark, tmp_path):
    started = []

    def start_fn():
        src = str(tmp_path / "src")
        write_ticks(src, "a.json", ['{"id":"A","price":1,"time":"1000"}'], 1_000_000)
        q = start(tick_means(spark.readStream.text(src)), name="gated", checkpoint=str(tmp_path / "ck"),
                  mode="update", trigger={"availableNow": True}, sink="noop")
        started.append(q)
        return q

    not_ready = topic_ready(topic_lag(offsets_from_map(spark, {0: 10}, "end_offset"),
                                      offsets_from_map(spark, {0: 0}, "committed_offset")))
    assert run_if_ready(not_ready, start_fn) is None and not started
    ready = topic_ready(topic_lag(offsets_from_map(spark, {0: 12, 1: 100}, "end_offset"),
                                  offsets_from_map(spark, {0: 10, 1: 0}, "committed_offset")))
    assert run_if_ready(ready, start_fn, poll_seconds=0.5) == "finished"
    assert len(started) == 1


def test_committed_offset_log_retention_and_restart(spark, tmp_path):
    """Only the newest snapshots are kept; a restarted logger seeds itself
    from the log, so partitions missing from its first batches survive."""
    from tickwise.session import list_names
    from tickwise.streaming.control import CommittedOffsetLog

    def progress(bid, offsets):
        return {"batchId": bid, "numInputRows": 1,
                "sources": [{"endOffset": {"data_stream": {str(p): o for p, o in offsets.items()}}}]}

    path = str(tmp_path / "log")
    log = CommittedOffsetLog(spark, path, query="q", topic="data_stream", retain=3)
    for b in range(6):
        log.on_progress(progress(b, {0: 10 + b, 1: 20 + b, 2: 30}))
    assert [b for _, b in log.snapshots()] == [3, 4, 5]
    restarted = CommittedOffsetLog(spark, path, query="q", topic="data_stream", retain=3)
    for b in range(6, 10):
        restarted.on_progress(progress(b, {0: 100 + b}))
    assert {r.partition: r.committed_offset for r in restarted.read().collect()} == {0: 109, 1: 25, 2: 30}
    assert len(restarted.snapshots()) == 3
    # a new checkpoint: batch ids start over, and the newest run still decides
    reset = CommittedOffsetLog(spark, path, query="q", topic="data_stream", retain=3)
    reset.on_progress(progress(0, {0: 503}))
    assert {r.partition: r.committed_offset for r in reset.read().collect()} == {0: 503, 1: 25, 2: 30}
    assert len(list_names(spark, f"{path}/query=q")) >= 1

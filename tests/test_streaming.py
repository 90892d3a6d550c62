"""F3 (late and duplicate ticks) and F6 (restart) on a real Structured
Streaming query: one JSON-lines file per micro-batch, rising modification
times, ``maxFilesPerTrigger=1``, ``availableNow``."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tickwise.streaming.control import late_rows, run_until_idle
from tickwise.streaming.jobs import start, tick_means

T0 = 1722598200000  # 2024-08-02 11:30:00 UTC
MIN = 60_000


def tick(i, price, offset_ms):
    return json.dumps({"id": i, "price": price, "time": str(T0 + offset_ms)})


FILES = {
    "a": [tick("A", 10, 0), tick("A", 10, 0), tick("A", 20, 1000), tick("B", 5, 2000), '{"x":1}'],
    "b": [tick("A", 10, 0), tick("A", 60, 2 * MIN), tick("A", 1, 6 * MIN)],
    "c": [tick("A", 7, 40 * MIN)],
    "d": [tick("A", 999, 3 * MIN), tick("B", 8, 41 * MIN)],
    "e": [tick("B", 9, 80 * MIN)],
}


def write_files(src, files, start_mtime=1_000_000):
    os.makedirs(src, exist_ok=True)
    for k, (name, lines) in enumerate(files.items()):
        p = os.path.join(src, f"{name}.json")
        with open(p, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(p, (start_mtime + 10 * k, start_mtime + 10 * k))


def run(spark, src, ckpt, mode, name, salt=None, watermark=None):
    out = {}

    def collect(batch, batch_id):
        rows = batch.select(
            "stock_ticker", F.date_format("timestamp", "HH:mm").alias("end"), "price"
        ).collect()
        if rows:
            out[batch_id] = sorted((r.stock_ticker, r.end, round(r.price, 4)) for r in rows)

    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    kw = {"watermark": watermark} if watermark else {}
    q = start(tick_means(stream, salt_buckets=salt, **kw), name=name, checkpoint=ckpt, mode=mode,
              trigger={"availableNow": True}, foreach_batch=collect)
    progress = []
    run_until_idle(q, max_idle_seconds=600, poll_seconds=0.5, on_progress=progress.append)
    return out, progress


@pytest.mark.parametrize("salt", [None, 4])
def test_update_mode_golden(spark, tmp_path, salt):
    write_files(str(tmp_path / "src"), FILES)
    out, _ = run(spark, str(tmp_path / "src"), str(tmp_path / "ckpt"), "update", f"f3_update_{salt}", salt)
    assert list(out.values()) == [
        [("A", "11:35", 15.0), ("B", "11:35", 5.0)],
        [("A", "11:35", 30.0), ("A", "11:40", 1.0)],
        [("A", "12:15", 7.0)],
        [("A", "11:35", 272.25), ("B", "12:15", 8.0)],
        [("B", "12:55", 9.0)],
    ]


@pytest.mark.parametrize("salt", [None, 4])
def test_append_mode_golden(spark, tmp_path, salt):
    write_files(str(tmp_path / "src"), FILES)
    out, _ = run(spark, str(tmp_path / "src"), str(tmp_path / "ckpt"), "append", f"f3_append_{salt}", salt)
    assert list(out.values()) == [
        [("A", "11:35", 272.25), ("A", "11:40", 1.0), ("B", "11:35", 5.0)],
        [("A", "12:15", 7.0), ("B", "12:15", 8.0)],
    ]


def test_late_tick_beyond_watermark_is_dropped(spark, tmp_path):
    files = dict(FILES)
    files["d"] = [tick("B", 8, 41 * MIN)]
    files["e"] = [tick("A", 999, 3 * MIN), tick("B", 9, 80 * MIN)]
    write_files(str(tmp_path / "src"), files)
    out, progress = run(spark, str(tmp_path / "src"), str(tmp_path / "ckpt"), "update", "f3_late")
    final = {}
    for rows in out.values():
        for t, e, p in rows:
            final[(t, e)] = p
    assert final[("A", "11:35")] == 30.0
    assert sum(late_rows(p) for p in progress) >= 1


def test_long_lateness_on_rocksdb_state(spark, tmp_path):
    """W8: a 30-day allowed lateness keeps the tick that the 15-minute
    watermark drops; state lives in RocksDB (set before the first start)."""
    from tickwise.session import ROCKSDB_STATE

    files = dict(FILES)
    files["d"] = [tick("B", 8, 41 * MIN)]
    files["e"] = [tick("A", 999, 3 * MIN), tick("B", 9, 80 * MIN)]
    write_files(str(tmp_path / "src"), files)
    saved = {k: spark.conf.get(k, None) for k in ROCKSDB_STATE}
    try:
        for k, v in ROCKSDB_STATE.items():
            spark.conf.set(k, v)
        out, progress = run(spark, str(tmp_path / "src"), str(tmp_path / "ckpt"), "update", "w8_rocksdb",
                            salt=4, watermark="30 days")
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert last_per_key(out)[("A", "11:35")] == 272.25
    assert sum(late_rows(p) for p in progress) == 0
    # the provider is recorded in the checkpoint's first offsets metadata
    with open(tmp_path / "ckpt" / "offsets" / "0") as fh:
        assert "RocksDBStateStoreProvider" in fh.read()


def last_per_key(out):
    final = {}
    for bid in sorted(out):
        for t, e, p in out[bid]:
            final[(t, e)] = p
    return final


def test_restart_resumes_state(spark, tmp_path):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    first = {k: FILES[k] for k in "ab"}
    write_files(src, first)
    out1, _ = run(spark, src, ckpt, "update", "f6_restart")
    rest = {k: FILES[k] for k in "cde"}
    write_files(src, rest, start_mtime=2_000_000)
    out2, _ = run(spark, src, ckpt, "update", "f6_restart")
    assert min(out2) >= 2  # batch ids continue on the same checkpoint
    combined = last_per_key({**out1, **out2})
    assert combined[("A", "11:35")] == 272.25
    assert combined == {
        ("A", "11:35"): 272.25, ("B", "11:35"): 5.0, ("A", "11:40"): 1.0,
        ("A", "12:15"): 7.0, ("B", "12:15"): 8.0, ("B", "12:55"): 9.0,
    }


def test_fresh_checkpoint_loses_state(spark, tmp_path):
    # the fault the explicit checkpoint guards against: a new checkpoint sees
    # only the tail of the straddling window
    src = str(tmp_path / "src")
    write_files(src, {k: FILES[k] for k in "cde"})
    out, _ = run(spark, src, str(tmp_path / "fresh"), "update", "f6_fresh")
    assert last_per_key(out)[("A", "11:35")] == 999.0


def test_console_sink_runs(spark, tmp_path):
    """K1: the debug console sink (final windows, append mode)."""
    write_files(str(tmp_path / "src"), FILES)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "src"))
    q = start(tick_means(stream), name="k1_console", checkpoint=str(tmp_path / "ckpt"), mode="append",
              trigger={"availableNow": True}, sink="console")
    assert run_until_idle(q, max_idle_seconds=600, poll_seconds=0.5) == "finished"
    assert sum(p.numInputRows for p in q.recentProgress) == sum(len(v) for v in FILES.values())

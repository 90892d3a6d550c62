"""Skew probe: one group of copies holding a third of all topic records.

Builds a topic from the ``events`` table in which one message is replayed
until its copies make up a third of all records (same key, same partition),
spread over the input files as a replaying producer would spread them. Runs
the batch chain (parse -> validate -> dedup -> tumbling mean) and the salted
stream chain over it with Spark's event log written to the scratch folder,
then reports, per stage that reads a shuffle, the records read by the
busiest task against the median task and the total. A hot group that was not
collapsed before the shuffle would show up as one task reading about a third
of all records.

Usage: python tools/skew_probe.py [sf_dir] > SKEW.md
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tickwise.functions.parse import parse_ticks, valid_ticks  # noqa: E402
from tickwise.operators.dedup import dedup_ticks  # noqa: E402
from tickwise.operators.windows import tumbling_mean  # noqa: E402
from tickwise.session import build_session, scratch_path  # noqa: E402
from tickwise.plans.events import events_to_topic  # noqa: E402
from tickwise.sources.topic import append_segment, read_topic  # noqa: E402
from tickwise.streaming.control import run_until_idle  # noqa: E402
from tickwise.streaming.jobs import start, tick_means  # noqa: E402

INPUT_FILES = 16


def hot_topic(events):
    """Every event once, plus ``n / 2`` copies of the first event's message
    (new offsets, same payload and partition): the copies are a third of
    the records."""
    n = events.count()
    first, top = events.agg(F.min("event_id"), F.max("event_id")).first()
    copies = (
        events.where(F.col("event_id") == first)
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_k"))
        .withColumn("event_id", F.col("_k") + F.lit(top))
        .drop("_k")
    )
    return events_to_topic(events.unionByName(copies), replay_every=None, corrupt_every=None)


def shuffle_reads(log_dir: str) -> list[dict]:
    """Per stage that read a shuffle: job group / description, tasks, total,
    max and median records read per task."""
    stages: dict[int, dict] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    stages.setdefault(ev["Stage ID"], {"reads": []})["reads"].append(recs)
                elif kind == "SparkListenerJobStart":
                    desc = ((ev.get("Properties") or {}).get("spark.job.description") or "").split("\n")[0]
                    for sid in ev.get("Stage IDs", []):
                        stages.setdefault(sid, {"reads": []})["job"] = desc
    out = []
    for sid, st in sorted(stages.items()):
        reads = st["reads"]
        if not reads or sum(reads) == 0:
            continue
        out.append({"stage": sid, "job": st.get("job", ""), "tasks": len(reads), "total": sum(reads),
                    "max": max(reads), "median": statistics.median(reads)})
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-", dir=os.environ.get("SKEW_LOG_ROOT", "/tmp"))
    spark = build_session("local[8]", shuffle_partitions=8, conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        # AQE would merge small shuffle partitions; keep one task per hash bucket
        # so the busiest bucket is visible as one task.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext

    topic_dir = scratch_path(spark, "skew_topic")
    records = hot_topic(spark.read.parquet(f"{sf_dir}/events.parquet"))
    append_segment(records.repartition(INPUT_FILES), topic_dir)
    total = spark.read.parquet(topic_dir).count()

    sc.setJobDescription("batch chain")
    topic = read_topic(spark, path=topic_dir, streaming=False)
    batch = tumbling_mean(dedup_ticks(valid_ticks(parse_ticks(topic))))
    # a full write, not count(): a count lets Catalyst drop the mean and
    # fold the de-duplication into the window grouping
    batch_dir = scratch_path(spark, "skew_batch")
    batch.write.parquet(batch_dir)
    sc.setJobDescription("result counts")
    batch_rows = spark.read.parquet(batch_dir).count()

    stream_rows = {}
    for label, salt in (("stream_salted", 16), ("stream_unsalted", None)):
        base = scratch_path(spark, f"skew_{label}")
        stream = read_topic(spark, path=topic_dir, streaming=True)
        q = start(tick_means(stream, salt_buckets=salt), name=label, checkpoint=f"{base}/checkpoint",
                  mode="append", trigger={"availableNow": True}, sink="parquet", path=f"{base}/out")
        run_until_idle(q, max_idle_seconds=600, poll_seconds=1)
        sc.setJobDescription("result counts")
        stream_rows[label] = spark.read.parquet(f"{base}/out").count()
    sc.setJobDescription(None)
    spark.stop()

    print("# Skew probe\n")
    print(f"Written by `tools/skew_probe.py` on `{sf_dir}`, local[8], {INPUT_FILES} input files. "
          f"Topic records: {total}; one group of copies holds a third of them. "
          f"Batch windows: {batch_rows}; stream final windows: {stream_rows}.\n")
    print("Jobs: `batch chain` = parse, validate, batch dedup, tumbling mean; `stream_salted` / "
          "`stream_unsalted` = the stream chain with and without the two-stage salted de-duplication "
          "(stages in plan order: dedup(s), then the windowed mean); unlabelled = topic write and its count.\n")
    print("Shuffle records read per task, for every stage that read a shuffle:\n")
    print("| stage | job | tasks | total | busiest task | median task |")
    print("| --- | --- | --- | --- | --- | --- |")
    for r in shuffle_reads(log_dir):
        print(f"| {r['stage']} | {r['job']} | {r['tasks']} | {r['total']} | {r['max']} | {r['median']} |")


if __name__ == "__main__":
    main()

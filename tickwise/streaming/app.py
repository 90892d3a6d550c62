"""The jobs in one call each: quote frames -> topic (the bridge), and topic ->
windowed means -> keyed table, with committed-offset log, idle stop and an
optional start gate."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.quotes import decode_quotes, quote_json
from tickwise.operators.offsets import START_THRESHOLD, end_offsets, topic_lag, topic_ready
from tickwise.operators.windows import WATERMARK, WINDOW
from tickwise.session import path_exists
from tickwise.sinks.keyed_table import KeyedTable
from tickwise.sources.topic import DEFAULT_TOPIC, publish_stream, read_topic, topic_extent
from tickwise.streaming.control import (
    IDLE_STOP_SECONDS,
    POLL_SECONDS,
    CommittedOffsetLog,
    RunReadout,
    run_until_idle,
)
from tickwise.streaming.jobs import changelog_batches, start, tee_batches, tick_means, upsert_batches

EARLY_RESULTS = {"processingTime": "1 minute"}


def bridge_records(frames: DataFrame, *, frame_col: str = "frame") -> DataFrame:
    """Quote frames -> messages as the topic takes them: decode, JSON as
    ``value``. Frames that are no quote are dropped; ``observe`` counts both
    under ``bridge``. All other columns pass through."""
    decoded = decode_quotes(frames, frame_col=frame_col)
    decoded = decoded.observe(
        "bridge", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("quote").isNull()).alias("bad_frames")
    )
    kept = [F.col(c) for c in frames.columns if c != frame_col]
    return decoded.where(F.col("quote").isNotNull()).select(*kept, quote_json(F.col("quote")).cast("binary").alias("value"))


def run_bridge_job(
    frames: DataFrame,
    *,
    name: str,
    checkpoint: str,
    target_format: str = "parquet",
    target_path: str | None = None,
    topic: str = DEFAULT_TOPIC,
    frame_col: str = "frame",
    trigger: dict | None = None,
    options: Mapping[str, str] | None = None,
    max_idle_seconds: float = IDLE_STOP_SECONDS,
    poll_seconds: float = POLL_SECONDS,
) -> str:
    """Run the ingest side: a stream of frames is decoded, turned into JSON
    and published. A file-backed target needs the topic's record columns
    beside the frame. Returns why it stopped."""
    query = publish_stream(
        bridge_records(frames, frame_col=frame_col),
        name=name, checkpoint=checkpoint, fmt=target_format, path=target_path, topic=topic, trigger=trigger, options=options,
    )
    return run_until_idle(query, max_idle_seconds=max_idle_seconds, poll_seconds=poll_seconds)


def offset_log(
    spark: SparkSession, offsets_path: str, *, name: str, topic: str, checkpoint: str, source_format: str, source_path: str | None
) -> CommittedOffsetLog:
    """The job's committed-offset log; of a file-backed topic it reads the
    checkpoint's log of files."""
    files = {} if source_format == "kafka" else {"checkpoint": checkpoint, "topic_path": source_path}
    return CommittedOffsetLog(spark, offsets_path, query=name, topic=topic, **files)


def run_tick_job(
    spark: SparkSession,
    *,
    name: str,
    checkpoint: str,
    table_path: str,
    offsets_path: str,
    source_format: str = "parquet",
    source_path: str | None = None,
    source_options: Mapping[str, str] | None = None,
    topic: str = DEFAULT_TOPIC,
    window: str = WINDOW,
    watermark: str = WATERMARK,
    mode: str = "update",
    trigger: dict | None = None,
    changelog_path: str | None = None,
    console: bool = False,
    salt_buckets: int | None = None,
    state_partitions: int | None = None,
    max_idle_seconds: float = IDLE_STOP_SECONDS,
    poll_seconds: float = POLL_SECONDS,
    readout: RunReadout | None = None,
) -> str:
    """Run the job until the topic goes idle (or drains, with
    ``trigger={"availableNow": True}``). Early results (``mode="update"``)
    are upserted every trigger; ``mode="append"`` writes final windows only.
    ``readout`` collects the run's totals. Returns why it stopped."""
    records = read_topic(spark, fmt=source_format, path=source_path, topic=topic,
                         streaming=True, options=source_options)
    table = KeyedTable(spark, table_path)
    writers = [upsert_batches(table)]
    if changelog_path:
        writers.append(changelog_batches(changelog_path))
    sink = writers[0] if len(writers) == 1 and not console else tee_batches(*writers, console=console)
    means = tick_means(records, window=window, watermark=watermark, salt_buckets=salt_buckets)
    q = start(means, name=name, checkpoint=checkpoint, mode=mode, trigger=trigger or EARLY_RESULTS,
              foreach_batch=sink, state_partitions=state_partitions)
    log = offset_log(spark, offsets_path, name=name, topic=topic, checkpoint=checkpoint,
                     source_format=source_format, source_path=source_path)

    def on_progress(progress: dict) -> None:
        log.on_progress(progress)
        if readout is not None:
            readout.on_progress(progress)

    return run_until_idle(q, max_idle_seconds=max_idle_seconds, poll_seconds=poll_seconds, on_progress=on_progress)


def waiting_options(committed: Mapping[int, int], topic: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a batch Kafka read of what waits behind the committed
    offsets; partitions that are not named start where the source says."""
    opts = dict(options or {})
    if committed:
        opts["startingOffsets"] = json.dumps({topic: {str(p): o for p, o in sorted(committed.items())}})
    return opts


def ready_to_start(
    spark: SparkSession,
    *,
    name: str,
    offsets_path: str,
    source_format: str = "parquet",
    source_path: str | None = None,
    source_options: Mapping[str, str] | None = None,
    topic: str = DEFAULT_TOPIC,
    threshold: int = START_THRESHOLD,
) -> DataFrame:
    """One-row readiness of a topic against the job's committed offsets
    (``ready, total_lag, partitions_ready, partitions``). From Kafka only records
    behind the committed offsets are read, of Parquet files none; a
    partition without any has no lag."""
    committed = None
    if path_exists(spark, offsets_path):
        committed = CommittedOffsetLog(spark, offsets_path, query=name, topic=topic).read()
    known = {} if committed is None else {r["partition"]: r["committed_offset"] for r in committed.collect()}
    if source_format != "parquet":
        options = waiting_options(known, topic, source_options) if source_format == "kafka" else source_options
        records = read_topic(spark, fmt=source_format, path=source_path, topic=topic, streaming=False, options=options)
        ends = end_offsets(records)
    else:  # one row a topic partition, from the files' statistics
        found = topic_extent(spark, source_path, topic).select("partition", "end_offset").collect()
        ends = spark.createDataFrame([(r.partition, r.end_offset) for r in found], "partition int, end_offset bigint")
    rows = [(int(p), int(o)) for p, o in sorted(known.items())]
    committed = spark.createDataFrame(rows, "partition int, committed_offset bigint")
    seen = committed.select("partition", F.col("committed_offset").alias("end_offset"))
    ends = ends.unionByName(seen).groupBy("partition").agg(F.max("end_offset").alias("end_offset"))
    return topic_ready(topic_lag(ends, committed, threshold=threshold), threshold=threshold)

"""Run control around a streaming query: stop when idle, start only when
enough input waits, late-row and committed-offset bookkeeping.

These are driver-side loops over *progress records* (a few numbers per
micro-batch), never over data.
"""

from __future__ import annotations

import json
import threading
import time
from collections import deque
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickwise.session import delete_path, list_names
from tickwise.sources.checkpoint import file_topic_offsets

IDLE_STOP_SECONDS = 15 * 60
POLL_SECONDS = 10


def _progress_dict(p) -> dict:
    if p is None:
        return {}
    if hasattr(p, "json"):  # StreamingQueryProgress: plain JSON types
        return json.loads(p.json)
    return dict(p)


class ProgressFeed(StreamingQueryListener):
    """Progress records of named queries, as Spark posts them. A query keeps
    only its newest 100 records, so polling it can miss some; events cannot be
    missed. One feed a session; it holds what was not fetched yet."""

    def __init__(self) -> None:
        self._new: dict[str, deque[dict]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._runs: dict[str, str] = {}

    def expect(self, name: str) -> None:
        """Collect the records of the query that starts next under ``name``."""
        self._new[name], self._ended[name] = deque(), threading.Event()

    def expects(self, name: str | None) -> bool:
        return name in self._new

    def fetch(self, name: str) -> list[dict]:
        """Records that came since the last call, oldest first."""
        waiting = self._new[name]
        return [waiting.popleft() for _ in range(len(waiting))]

    def wait_for_end(self, name: str, seconds: float = 30.0) -> None:
        """The end of a query is posted after its last record."""
        self._ended[name].wait(seconds)

    def release(self, name: str) -> None:
        self._new.pop(name, None)
        self._ended.pop(name, None)

    def onQueryStarted(self, event) -> None:
        if event.name in self._new:
            self._runs[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        waiting = self._new.get(event.progress.name)
        if waiting is not None:
            waiting.append(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        ended = self._ended.get(self._runs.pop(str(event.runId), None))
        if ended is not None:
            ended.set()


_feeds: dict[str, ProgressFeed] = {}


def progress_feed(spark: SparkSession) -> ProgressFeed:
    """The session's feed, made and registered on first use."""
    app = spark.sparkContext.applicationId
    if app not in _feeds:
        _feeds.clear()
        _feeds[app] = ProgressFeed()
        spark.streams.addListener(_feeds[app])
    return _feeds[app]


def run_until_idle(
    query: StreamingQuery,
    *,
    max_idle_seconds: float = IDLE_STOP_SECONDS,
    poll_seconds: float = POLL_SECONDS,
    on_progress: Callable[[dict], None] | None = None,
    clock: Callable[[], float] = time.monotonic,
    feed: ProgressFeed | None = None,
) -> str:
    """Watch the query; stop it once no batch has read input for
    ``max_idle_seconds``. Every progress record is handed to ``on_progress``
    exactly once, in order: from ``feed`` where the query was started with it
    (``jobs.start`` does), otherwise from the query's newest records. Returns
    why the loop ended."""
    last_input = clock()
    last_batch: tuple[int, str] = (-1, "")
    if feed is None and isinstance(query, StreamingQuery):
        feed = next((f for f in _feeds.values() if f.expects(query.name)), None)

    def records() -> list[dict]:
        nonlocal last_batch
        if feed is not None:
            return feed.fetch(query.name)
        new = []
        for d in map(_progress_dict, query.recentProgress):
            ident = (d.get("batchId", -1), d.get("timestamp", ""))
            if ident > last_batch:
                new.append(d)
                last_batch = ident
        return new

    def drain() -> bool:
        """Hand over what is new; whether it had input."""
        had_input = False
        for d in records():
            if on_progress is not None:
                on_progress(d)
            had_input = had_input or d.get("numInputRows", 0) > 0
        return had_input

    def finish() -> None:
        if feed is not None:
            feed.wait_for_end(query.name)
        drain()
        if feed is not None:
            feed.release(query.name)

    while query.isActive:
        try:
            query.awaitTermination(poll_seconds)
        except StreamingQueryException:
            break
        if drain():
            last_input = clock()
        if not query.isActive:
            break
        # input waiting (or a batch still reading it) is not idleness
        if (query.status or {}).get("isDataAvailable"):
            last_input = clock()
        if clock() - last_input > max_idle_seconds:
            query.stop()
            finish()
            return "idle"
    # a fast query may end, or post its last progress, between two polls
    finish()
    exc = query.exception()
    if exc is not None:
        raise exc
    return "finished"


class RunReadout:
    """Totals of a run, from its progress records: rows read, rows that came
    too late, batches, and the row counts of streaming stage taps.
    ``batch_rows`` has the rows of each micro-batch that read any."""

    def __init__(self) -> None:
        self.batch_rows: list[tuple[int, int]] = []
        self.batches = self.input_rows = self.late_rows = 0
        self.stages: dict[str, int] = {}

    def on_progress(self, progress: dict) -> None:
        self.batches += 1
        rows = progress.get("numInputRows", 0)
        self.input_rows += rows
        if rows:
            self.batch_rows.append((progress.get("batchId", -1), rows))
        self.late_rows += late_rows(progress)
        for stage, metrics in (progress.get("observedMetrics") or {}).items():
            if isinstance(metrics, dict) and "rows" in metrics:
                self.stages[stage] = self.stages.get(stage, 0) + int(metrics["rows"])


def run_if_ready(ready: DataFrame, start_fn: Callable[[], StreamingQuery], **idle_kw) -> str | None:
    """Gate: start the job only when the one-row ``topic_ready`` frame says
    so, then run it until it drains or goes idle. The cadence of the check
    belongs to the caller's scheduler."""
    row = ready.select("ready").first()
    if not row or not row["ready"]:
        return None
    q = start_fn()
    return run_until_idle(q, **idle_kw)


def late_rows(progress: dict) -> int:
    """Rows dropped for arriving behind the watermark in one micro-batch."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for op in progress.get("stateOperators", []))


def _end_offset(progress: dict):
    """The first source's end offset: a dict, or None."""
    for src in progress.get("sources", []):
        end = src.get("endOffset")
        if isinstance(end, str):
            try:
                end = json.loads(end)
            except ValueError:
                end = None
        if isinstance(end, dict):
            return end
    return None


def offsets_from_progress(progress: dict, topic: str) -> dict[int, int]:
    """Next offset to read per partition once this batch is committed, as
    Kafka sources report it: ``{topic: {partition: offset}}``."""
    end = _end_offset(progress) or {}
    per_topic = end.get(topic)
    return {int(p): int(o) for p, o in per_topic.items()} if isinstance(per_topic, dict) else {}


class CommittedOffsetLog:
    """Offsets of records whose results reached the sink, one small Parquet
    folder per (query, run, batch id): ``topic, partition, offset``.

    Fed from progress records (a progress is posted after the batch's sink
    write and commit), so an offset is never logged ahead of its data. A Kafka
    progress names the offsets. Of a file-backed topic (``checkpoint`` and
    ``topic_path`` given) it names how far the source's log of files was read:
    the offsets are then one grouped maximum over the files that came since
    the last snapshot, with whatever partitions they hold, so a progress
    record that was missed costs nothing.

    A run is one start of the logger, named by its time, so batch ids that
    start over with a new checkpoint sort after those of earlier runs. Every
    folder is a full snapshot (all partitions seen so far, seeded from the log
    after a restart); offsets only move forward. The newest ``retain``
    snapshots of a query are kept.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        query: str,
        topic: str,
        checkpoint: str | None = None,
        topic_path: str | None = None,
        retain: int = 10,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.query = query
        self.topic = topic
        self.checkpoint = checkpoint
        self.topic_path = topic_path
        self.retain = max(1, retain)
        self.run = time.time_ns() // 1000
        self._last: dict[int, int] | None = None
        self._log_offset = -1

    def _query_dir(self) -> str:
        return f"{self.path}/query={self.query}"

    def _seed(self) -> dict[int, int]:
        """Offsets already logged by an earlier run of the same query (one
        row per topic partition)."""
        if not list_names(self.spark, self._query_dir()):
            return {}
        return {r["partition"]: r["committed_offset"] for r in self.read().collect()}

    def _offsets(self, progress: dict) -> dict[int, int]:
        if self.checkpoint is None or self.topic_path is None:
            return offsets_from_progress(progress, self.topic)
        upto = (_end_offset(progress) or {}).get("logOffset")
        if upto is None or int(upto) <= self._log_offset:
            return {}
        new = file_topic_offsets(
            self.spark, self.checkpoint, self.topic_path, self.topic, after=self._log_offset, upto=int(upto)
        ).collect()  # one row a topic partition
        self._log_offset = int(upto)
        return {r["partition"]: r["committed_offset"] for r in new}

    def on_progress(self, progress: dict) -> None:
        if progress.get("numInputRows", 0) == 0:
            return
        offs = self._offsets(progress)
        if not offs:
            return
        if self._last is None:
            self._last = self._seed()
        for p, o in offs.items():
            self._last[p] = max(self._last.get(p, 0), o)
        rows = [(self.topic, p, o) for p, o in sorted(self._last.items())]
        (
            self.spark.createDataFrame(rows, "topic string, partition int, offset bigint")
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{self._query_dir()}/run={self.run}/batch_id={int(progress['batchId'])}")
        )
        self._prune()

    def snapshots(self) -> list[tuple[int, int]]:
        """``(run, batch id)`` of the snapshots that are there, oldest first."""
        out = []
        for run in list_names(self.spark, self._query_dir()):
            if run.startswith("run="):
                for batch in list_names(self.spark, f"{self._query_dir()}/{run}"):
                    if batch.startswith("batch_id="):
                        out.append((int(run[4:]), int(batch[9:])))
        return sorted(out)

    def _prune(self) -> None:
        """Delete all but the newest ``retain`` snapshots."""
        for run, batch in self.snapshots()[: -self.retain]:
            delete_path(self.spark, f"{self._query_dir()}/run={run}/batch_id={batch}")

    def read(self) -> DataFrame:
        """Committed offset per partition (``partition, committed_offset``)."""
        log = self.spark.read.schema(
            "topic string, partition int, offset bigint, query string, run bigint, batch_id bigint"
        ).parquet(self.path)
        order = F.col("run").cast("decimal(38,0)") * F.lit(1_000_000_000_000).cast("decimal(13,0)") + F.col("batch_id")
        return (
            log.where((F.col("query") == self.query) & (F.col("topic") == self.topic))
            .groupBy("partition")
            .agg(F.max_by("offset", order.cast("decimal(38,0)")).alias("committed_offset"))
        )

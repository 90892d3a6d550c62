"""Registered streaming queries.

Each one publishes the events-derived topic to a file-backed topic under the
shared checkpoint folder in ``SEGMENTS`` appends and runs a real Structured
Streaming query over it: one ``availableNow`` run per appended segment on
the same checkpoint, i.e. the gated start / drain / stop cycle, including
the restart in between. The returned DataFrame reads what the stream wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwise.functions.parse import parse_ticks, valid_ticks
from tickwise.functions.quotes import encode_frames
from tickwise.operators.dedup import dedup_ticks, first_deliveries
from tickwise.operators.live_rate import live_message_rate
from tickwise.operators.panes import ALLOWED_LATENESS, LATE, ON_TIME, PANE_SCHEMA, paned_mean
from tickwise.operators.rates import StageTaps
from tickwise.operators.windows import tumbling_mean, with_event_time
from tickwise.plans.common import ntz, rounded, table, topic_records
from tickwise.plans.oracle import ORACLE_SQL, TUMBLING_SQL, _tumbling, _with
from tickwise.schemas import TOPIC_SCHEMA
from tickwise.session import ROCKSDB_STATE, scratch_path, session_conf
from tickwise.sinks.keyed_table import KeyedTable
from tickwise.plans.events import CORRUPT_EVERY, OFFSET_STRIDE, TOPIC_PARTITIONS, epoch_millis, event_time
from tickwise.sources.checkpoint import batch_offsets
from tickwise.sources.state import open_windows
from tickwise.sources.topic import DEFAULT_TOPIC, append_segment, read_topic
from tickwise.streaming.app import ready_to_start, run_bridge_job, run_tick_job
from tickwise.streaming.control import CommittedOffsetLog, RunReadout, run_until_idle
from tickwise.streaming.jobs import (
    SALT_BUCKETS,
    changelog_batches,
    clean_tick_stream,
    latest_per_key,
    offset_batches,
    start,
    tee_batches,
    tick_means,
    upsert_batches,
    watched_batches,
)

SEGMENTS = 2
MANY_PARTITIONS = 11
DRAIN = {"availableNow": True}


# Every so many events one is delivered in the second part of the topic.
LATE_EVERY = 4
STREAM_LATENESS = "7 days"


def late_delivery(records: DataFrame) -> list[DataFrame]:
    """The topic in two parts: the records of one event in ``LATE_EVERY`` come
    after all others."""
    late = F.expr(f"offset div {OFFSET_STRIDE} % {LATE_EVERY} = 1")
    return [records.where(~late), records.where(late)]


def _segment(records: DataFrame, i: int, n: int) -> DataFrame:
    """Records of the i-th of n equal offset ranges (log order)."""
    top = records.agg(F.max("offset") + 1).scalar()
    lo = F.floor(top * F.lit(i) / F.lit(n))
    hi = F.floor(top * F.lit(i + 1) / F.lit(n))
    return records.where((F.col("offset") >= lo) & (F.col("offset") < hi))


def drive(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    build: Callable[[DataFrame, str], StreamingQuery],
    *,
    segments: int = SEGMENTS,
    on_progress: Callable[[dict], None] | None = None,
    partitions: int = TOPIC_PARTITIONS,
    newest_first: bool = False,
    parts: Callable[[DataFrame], list[DataFrame]] | None = None,
) -> str:
    """Publish the topic segment by segment (``segments`` offset ranges, or
    what ``parts`` makes of the records); after each append run the query built
    by ``build(stream, base)`` until it has drained the topic."""
    base = scratch_path(spark, name)
    topic_dir = f"{base}/topic"
    records = topic_records(spark, sf_dir, partitions=partitions)
    cut = parts(records) if parts else [_segment(records, i, segments) for i in range(segments)]
    for part in reversed(cut) if newest_first else cut:
        append_segment(part, topic_dir)
        stream = read_topic(spark, path=topic_dir, streaming=True)
        q = build(stream, base)
        run_until_idle(q, max_idle_seconds=3600, poll_seconds=1, on_progress=on_progress)
    return base


def _qname(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:8]}"


def q_stream_tumbling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early results (update mode) into a change log; last value per key."""
    qn = _qname("tumbling")

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        means = tick_means(stream)
        return start(means, name=qn, checkpoint=f"{base}/checkpoint", mode="update",
                     trigger=DRAIN, foreach_batch=changelog_batches(f"{base}/changes"))

    base = drive(spark, sf_dir, "stream_tumbling_mean", build)
    return ntz(rounded(latest_per_key(spark.read.parquet(f"{base}/changes")), "price"))


def q_stream_final_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final results only (append mode, file sink): windows closed by the watermark."""
    qn = _qname("final")

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        means = tick_means(stream)
        return start(means, name=qn, checkpoint=f"{base}/checkpoint", mode="append",
                     trigger=DRAIN, sink="parquet", path=f"{base}/final")

    base = drive(spark, sf_dir, "stream_final_mean", build)
    return ntz(rounded(spark.read.parquet(f"{base}/final"), "price"))


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid ticks, de-duplicated within the watermark (append, file sink)."""
    qn = _qname("dedup")
    keep = ("stock_ticker", "timestamp", "price", "partition")

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        ticks = clean_tick_stream(stream, keep=keep, salt_buckets=SALT_BUCKETS)
        return start(ticks, name=qn, checkpoint=f"{base}/checkpoint",
                     mode="append", trigger=DRAIN, sink="parquet", path=f"{base}/ticks")

    base = drive(spark, sf_dir, "stream_dedup", build)
    return ntz(spark.read.parquet(f"{base}/ticks"))


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early results upserted batch by batch into the keyed table."""
    qn = _qname("upsert")

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        return start(tick_means(stream), name=qn, checkpoint=f"{base}/checkpoint", mode="update", trigger=DRAIN,
                     foreach_batch=upsert_batches(KeyedTable(spark, f"{base}/table")))

    base = drive(spark, sf_dir, "stream_upsert", build)
    return ntz(rounded(KeyedTable(spark, f"{base}/table").read(), "price"))


def q_stream_upsert_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a new checkpoint for the second run, so that its batch
    ids start over and everything is read again."""
    qn = _qname("reset")
    runs: list[str] = []

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        table = KeyedTable(spark, f"{base}/table")
        runs.append(f"{base}/checkpoint{len(runs)}")
        return start(tick_means(stream), name=qn, checkpoint=runs[-1], mode="update", trigger=DRAIN,
                     foreach_batch=upsert_batches(table))

    base = drive(spark, sf_dir, "stream_upsert_reset", build)
    return ntz(rounded(KeyedTable(spark, f"{base}/table").read(), "price"))


def _offsets_run(spark: SparkSession, sf_dir: str, partitions: int) -> CommittedOffsetLog:
    """Drain the topic with a light query; the log of its offsets."""
    qn = _qname("offsets")
    logs: list[CommittedOffsetLog] = []

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        logs.append(
            CommittedOffsetLog(spark, f"{base}/committed", query=qn, topic=DEFAULT_TOPIC,
                               checkpoint=f"{base}/checkpoint", topic_path=f"{base}/topic")
        )
        return start(valid_ticks(parse_ticks(stream)), name=qn, checkpoint=f"{base}/checkpoint", mode="append",
                     trigger=DRAIN, sink="noop")

    drive(spark, sf_dir, "stream_offsets", build, on_progress=lambda p: logs[-1].on_progress(p), partitions=partitions)
    return logs[-1]


def q_stream_committed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets logged after each committed batch; after draining the whole
    topic they equal its end offsets."""
    return _offsets_run(spark, sf_dir, TOPIC_PARTITIONS).read()


def q_stream_offsets_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a topic of ``MANY_PARTITIONS`` partitions, which nobody
    told the log about."""
    return _offsets_run(spark, sf_dir, MANY_PARTITIONS).read()


def q_stream_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote frames through the bridge job to the topic, and from there to
    ticks: encode, publish as a stream, parse, de-duplicate."""
    base = scratch_path(spark, "stream_bridge")
    events = table(spark, sf_dir, "events")
    quote = F.struct(
        F.col("event_type").alias("id"), F.col("value").cast("float").alias("price"), epoch_millis(events, "ts").alias("time")
    )
    frames = events.select(
        F.lit(None).cast("binary").alias("key"),
        # every seventh frame is cut short and no quote any more
        F.when(F.col("event_id") % CORRUPT_EVERY == 0, F.lit("@@")).otherwise(encode_frames(quote)).alias("frame"),
        F.lit(DEFAULT_TOPIC).alias("topic"),
        (F.col("user_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        (F.col("event_id") * OFFSET_STRIDE).alias("offset"),
        event_time(events, "ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    frames.write.parquet(f"{base}/frames")
    schema = spark.read.parquet(f"{base}/frames").schema
    stream = spark.readStream.schema(schema).parquet(f"{base}/frames")
    run_bridge_job(stream, name=_qname("bridge"), checkpoint=f"{base}/checkpoint", target_path=f"{base}/topic",
                   trigger=DRAIN, max_idle_seconds=3600, poll_seconds=1)
    return ntz(dedup_ticks(valid_ticks(parse_ticks(read_topic(spark, path=f"{base}/topic", streaming=False)))))


def q_gated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate, run, gate: one row per check (``step``), with the whole tick job
    in between. Open before, closed after."""
    base, name = scratch_path(spark, "gated_run"), _qname("gated")
    append_segment(topic_records(spark, sf_dir), f"{base}/topic")
    where = {"name": name, "offsets_path": f"{base}/offsets", "source_path": f"{base}/topic"}

    def check(step: int) -> DataFrame:
        ready = ready_to_start(spark, **where).select(F.lit(step).alias("step"), "ready", "total_lag", "partitions_ready", "partitions")
        ready.write.parquet(f"{base}/checks/check={step}")
        return ready

    check(0)
    run_tick_job(spark, checkpoint=f"{base}/checkpoint", table_path=f"{base}/table", trigger=DRAIN,
                 max_idle_seconds=3600, poll_seconds=1, **where)
    check(1)
    return spark.read.parquet(f"{base}/checks").drop("check")


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the watermark drops, from the run's progress: the topic is
    delivered newest half first, so that a second run on the same checkpoint
    finds its ticks too late; taps count rows on the way."""
    qn = _qname("late")
    readout = RunReadout()

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        taps = StageTaps()
        ticks = taps.tap(valid_ticks(parse_ticks(taps.tap(stream, "records"))), "valid")
        timed = with_event_time(ticks.select("stock_ticker", "timestamp", "price"), "timestamp")
        return start(dedup_ticks(timed), name=qn, checkpoint=f"{base}/checkpoint", mode="append", trigger=DRAIN, sink="noop")

    drive(spark, sf_dir, "stream_late_rows", build, on_progress=readout.on_progress, newest_first=True)
    rows = [("records", readout.stages.get("records", 0)), ("valid", readout.stages.get("valid", 0)), ("late", readout.late_rows)]
    return spark.createDataFrame(rows, "stage string, rows bigint")


def _panes(spark: SparkSession, sf_dir: str, name: str, allowed_lateness: str) -> DataFrame:
    qn = _qname(name)

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        panes = paned_mean(valid_ticks(parse_ticks(stream)), allowed_lateness=allowed_lateness)
        return start(panes, name=qn, checkpoint=f"{base}/checkpoint", mode="append", trigger=DRAIN,
                     sink="parquet", path=f"{base}/panes")

    with session_conf(spark, ROCKSDB_STATE):  # windows are kept for days
        base = drive(spark, sf_dir, name, build, parts=late_delivery)
    return spark.read.schema(PANE_SCHEMA).parquet(f"{base}/panes")


def q_stream_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pane of every window: early ones, one on time, one for each late
    row, means accumulating."""
    return ntz(rounded(_panes(spark, sf_dir, "stream_panes", ALLOWED_LATENESS), "price"))


def q_stream_allowed_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows closed by the watermark: the result on time, and the last one
    after late rows; windows whose lateness had run out took none."""
    panes = _panes(spark, sf_dir, "stream_allowed_lateness", STREAM_LATENESS)
    on_time = F.col("pane") == ON_TIME
    rows = panes.groupBy("stock_ticker", "timestamp").agg(
        F.max(F.when(on_time, F.col("price"))).alias("on_time_price"),
        F.max(F.when(on_time, F.col("rows"))).alias("on_time_rows"),
        F.max_by("price", "pane_index").alias("last_price"),
        F.max("rows").alias("last_rows"),
        F.count_if(F.col("pane") == LATE).alias("late_panes"),
    )
    closed = rows.where("on_time_rows is not null or late_panes > 0")
    return ntz(rounded(closed, "on_time_price", "last_price"))


# One row a pane. Rows of the first and second delivery, the on-time
# watermarks after them, and the panes that each delivery and watermark fires.
def _panes_sql(lateness: str) -> str:
    return _with(
        f"""ticks_in AS (
  SELECT stock_ticker, time_bucket(INTERVAL '5 minutes', "timestamp") + INTERVAL '5 minutes' AS w, "timestamp" AS ts,
         CAST(price AS DOUBLE) AS p, "offset" AS o, "partition" AS q,
         "offset" // {OFFSET_STRIDE} % {LATE_EVERY} = 1 AS second
  FROM valid)""",
        """marks AS (
  SELECT max(ts) FILTER (NOT second) - INTERVAL '15 minutes' AS m1, max(ts) - INTERVAL '15 minutes' AS m2 FROM ticks_in)""",
        """first_part AS (SELECT stock_ticker, w, sum(p) AS s, count(*) AS n FROM ticks_in WHERE NOT second GROUP BY 1, 2)""",
        f"""second_part AS (
  SELECT t.* FROM ticks_in t, marks WHERE second AND w + INTERVAL '{lateness}' > m1)""",
        """second_sums AS (SELECT stock_ticker, w, sum(p) AS s, count(*) AS n FROM second_part GROUP BY 1, 2)""",
        """both_parts AS (
  SELECT stock_ticker, w, coalesce(a.s, 0) + coalesce(b.s, 0) AS s, coalesce(a.n, 0) + coalesce(b.n, 0) AS n,
         a.n IS NOT NULL AS in_first, b.n IS NOT NULL AS in_second
  FROM first_part a FULL JOIN second_sums b USING (stock_ticker, w))""",
        """late_rows AS (
  SELECT t.stock_ticker, t.w, coalesce(f.s, 0) + sum(p) OVER g AS s, coalesce(f.n, 0) + row_number() OVER g AS n,
         CASE WHEN f.n IS NULL THEN 0 ELSE 2 END + row_number() OVER g - 1 AS i
  FROM second_part t CROSS JOIN marks LEFT JOIN first_part f ON f.stock_ticker = t.stock_ticker AND f.w = t.w
  WHERE t.w <= m1 WINDOW g AS (PARTITION BY t.stock_ticker, t.w ORDER BY ts, o, q))""",
        """panes AS (
  SELECT stock_ticker, w, s / n AS price, n, 'EARLY' AS pane, 0 AS i FROM first_part
  UNION ALL SELECT stock_ticker, w, s / n, n, 'ON_TIME', 1 FROM first_part, marks WHERE w <= m1
  UNION ALL SELECT stock_ticker, w, s / n, n, 'LATE', i FROM late_rows
  UNION ALL SELECT stock_ticker, w, s / n, n, 'EARLY', CASE WHEN in_first THEN 1 ELSE 0 END
    FROM both_parts, marks WHERE w > m1 AND in_second
  UNION ALL SELECT stock_ticker, w, s / n, n, 'ON_TIME', CASE WHEN in_first THEN 1 ELSE 0 END + CASE WHEN in_second THEN 1 ELSE 0 END
    FROM both_parts, marks WHERE w > m1 AND w <= m2)""",
    )


RATE_SEGMENTS = 3
COPY_PRICE = 1.5
# subscriptions before and after the first segment
WATCHLISTS = (("click", "purchase", "view"), ("purchase", "signup"))


def q_stream_message_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and first examples per minute, as a running monitor last gave
    them."""
    qn = _qname("rate")

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        return start(live_message_rate(stream), name=qn, checkpoint=f"{base}/checkpoint", mode="update", trigger=DRAIN,
                     foreach_batch=changelog_batches(f"{base}/changes"))

    base = drive(spark, sf_dir, "stream_message_rate", build, segments=RATE_SEGMENTS)
    return ntz(latest_per_key(spark.read.parquet(f"{base}/changes"), ("interval_start",)))


def _priced_copies(records: DataFrame) -> list[DataFrame]:
    """The topic in two segments; second deliveries carry another price."""
    copy = F.col("offset") % OFFSET_STRIDE == 1
    text = F.regexp_replace(F.col("value").cast("string"), '"price":[^,}]*', f'"price":{COPY_PRICE}')
    priced = records.withColumn("value", F.when(copy, text.cast("binary")).otherwise(F.col("value")))
    return [_segment(priced, i, SEGMENTS) for i in range(SEGMENTS)]


def q_stream_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first delivery of every tick whose time the watermark has passed,
    though copies carry other prices."""
    qn = _qname("first")

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        ticks = with_event_time(valid_ticks(parse_ticks(stream)), "timestamp")
        return start(first_deliveries(ticks), name=qn, checkpoint=f"{base}/checkpoint", mode="append", trigger=DRAIN,
                     sink="parquet", path=f"{base}/ticks")

    base = drive(spark, sf_dir, "stream_dedup_first", build, parts=_priced_copies)
    return ntz(spark.read.parquet(f"{base}/ticks"))


def q_stream_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of subscribed symbols; the subscription changes after the first
    segment."""
    qn, runs = _qname("watched"), []

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        symbols = [(s,) for s in WATCHLISTS[len(runs)]]
        runs.append(base)
        spark.createDataFrame(symbols, "stock_ticker string").write.mode("overwrite").parquet(f"{base}/symbols")
        sink = watched_batches(f"{base}/symbols", changelog_batches(f"{base}/ticks"))
        return start(valid_ticks(parse_ticks(stream)), name=qn, checkpoint=f"{base}/checkpoint", mode="append", trigger=DRAIN,
                     foreach_batch=sink)

    base = drive(spark, sf_dir, "stream_watchlist", build)
    return ntz(spark.read.parquet(f"{base}/ticks").drop("batch_id"))


def q_stream_state_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that are still open after draining, read from the state."""
    qn = _qname("state")

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        ticks = with_event_time(valid_ticks(parse_ticks(stream)).select("stock_ticker", "timestamp", "price"), "timestamp")
        return start(tumbling_mean(ticks), name=qn, checkpoint=f"{base}/checkpoint", mode="append", trigger=DRAIN, sink="noop")

    base = drive(spark, sf_dir, "stream_state_keys", build)
    return ntz(rounded(open_windows(spark, f"{base}/checkpoint"), "price"))


COUNT_SEGMENTS = 6
IDLE_SECONDS = 10


def q_stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and running total of every micro-batch, from the progress that
    Spark posts; polled only once, when all batches are done."""
    readout = RunReadout()
    base = scratch_path(spark, "stream_batch_counts")
    records = topic_records(spark, sf_dir)
    for i in range(COUNT_SEGMENTS):
        # one file a segment, so that a segment is a micro-batch
        _segment(records, i, COUNT_SEGMENTS).coalesce(1).write.mode("append").parquet(f"{base}/topic/segment={i}")
    stream = spark.readStream.schema(TOPIC_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/topic")
    q = start(valid_ticks(parse_ticks(stream)), name=_qname("counts"), checkpoint=f"{base}/checkpoint", mode="append",
              trigger=DRAIN, sink="noop")
    run_until_idle(q, max_idle_seconds=3600, poll_seconds=600, on_progress=readout.on_progress)
    rows = spark.createDataFrame(readout.batch_rows, "batch_id bigint, rows bigint")
    so_far = Window.orderBy("batch_id")  # one row a micro-batch
    return rows.select("batch_id", "rows", F.sum("rows").over(so_far).alias("total_rows"))


def q_stream_tee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query, two sinks: the change log and the keyed table hold the same
    means."""
    qn = _qname("tee")

    def build(stream: DataFrame, base: str) -> StreamingQuery:
        sinks = tee_batches(changelog_batches(f"{base}/changes"), upsert_batches(KeyedTable(spark, f"{base}/table")))
        return start(tick_means(stream), name=qn, checkpoint=f"{base}/checkpoint", mode="update", trigger=DRAIN, foreach_batch=sinks)

    base = drive(spark, sf_dir, "stream_tee", build)
    changes = latest_per_key(spark.read.parquet(f"{base}/changes")).select(F.lit("changes").alias("sink"), "*")
    kept = KeyedTable(spark, f"{base}/table").read().select(F.lit("table").alias("sink"), "*")
    return ntz(rounded(changes.unionByName(kept), "price"))


def q_stream_idle_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that runs on by itself, with a segment that comes while it
    runs, is stopped once nothing has come for ``IDLE_SECONDS``: why it ended,
    the records it read and the ticks it wrote."""
    base, readout = scratch_path(spark, "stream_idle_stop"), RunReadout()
    records = topic_records(spark, sf_dir)
    cut = [_segment(records, i, SEGMENTS) for i in range(SEGMENTS)]
    append_segment(cut.pop(0), f"{base}/topic")

    def on_progress(progress: dict) -> None:
        readout.on_progress(progress)
        if readout.input_rows and cut:
            append_segment(cut.pop(0), f"{base}/topic")

    ticks = valid_ticks(parse_ticks(read_topic(spark, path=f"{base}/topic", streaming=True)))
    q = start(ticks, name=_qname("idle"), checkpoint=f"{base}/checkpoint", mode="append",
              trigger={"processingTime": "1 second"}, sink="parquet", path=f"{base}/ticks")
    why = run_until_idle(q, max_idle_seconds=IDLE_SECONDS, poll_seconds=1, on_progress=on_progress)
    written = spark.read.parquet(f"{base}/ticks").agg(F.count(F.lit(1)).alias("ticks"))
    return written.select(F.lit(why).alias("ended"), F.lit(readout.input_rows).cast("bigint").alias("records"), "ticks")


class SinkFailure(Exception):
    """A sink that breaks down after it has written."""


def q_stream_checkpoint_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets by micro-batch as the checkpoint has them after a sink broke
    down in the second one (step 0) and after the restart (step 1)."""
    qn, base = _qname("offsets"), scratch_path(spark, "stream_checkpoint_offsets")
    records = topic_records(spark, sf_dir)

    def fail(batch: DataFrame, batch_id: int) -> None:
        raise SinkFailure

    def run(*then: Callable[[DataFrame, int], None]) -> None:
        stream = read_topic(spark, path=f"{base}/topic", streaming=True).select("partition", "offset")
        q = start(stream, name=qn, checkpoint=f"{base}/checkpoint", mode="append", trigger=DRAIN,
                  foreach_batch=tee_batches(offset_batches(f"{base}/ends"), *then))
        run_until_idle(q, max_idle_seconds=3600, poll_seconds=1)

    def look(step: int) -> None:
        batch_offsets(spark, f"{base}/checkpoint", f"{base}/ends").write.parquet(f"{base}/seen/step={step}")

    append_segment(_segment(records, 0, SEGMENTS), f"{base}/topic")
    run()
    append_segment(_segment(records, 1, SEGMENTS), f"{base}/topic")
    try:
        run(fail)
    except StreamingQueryException as e:
        if SinkFailure.__name__ not in str(e):
            raise
    look(0)
    run()
    look(1)
    return spark.read.parquet(f"{base}/seen")


STREAM_QUERIES = {
    "stream_tee": q_stream_tee,
    "stream_idle_stop": q_stream_idle_stop,
    "stream_checkpoint_offsets": q_stream_checkpoint_offsets,
    "stream_batch_counts": q_stream_batch_counts,
    "stream_message_rate": q_stream_message_rate,
    "stream_dedup_first": q_stream_dedup_first,
    "stream_watchlist": q_stream_watchlist,
    "stream_state_keys": q_stream_state_keys,
    "stream_panes": q_stream_panes,
    "stream_allowed_lateness": q_stream_allowed_lateness,
    "stream_tumbling_mean": q_stream_tumbling_mean,
    "stream_final_mean": q_stream_final_mean,
    "stream_dedup": q_stream_dedup,
    "stream_upsert": q_stream_upsert,
    "stream_upsert_reset": q_stream_upsert_reset,
    "stream_bridge": q_stream_bridge,
    "gated_run": q_gated_run,
    "stream_late_rows": q_stream_late_rows,
    "stream_offsets_many": q_stream_offsets_many,
    "stream_committed_offsets": q_stream_committed_offsets,
}

_VALID = 'stock_ticker, "timestamp", price, "partition", "offset"'
_LISTS = [", ".join(f"'{s}'" for s in symbols) for symbols in WATCHLISTS]

STREAM_ORACLES = {
    "stream_tee": _with("means AS (" + _tumbling("ticks") + ")")
    + """SELECT sink, means.* FROM means, (VALUES ('changes'), ('table')) s(sink)""",
    "stream_idle_stop": _with()
    + """SELECT 'idle' AS ended, (SELECT count(*) FROM topic) AS records, (SELECT count(*) FROM valid) AS ticks""",
    "stream_checkpoint_offsets": _with("""segments AS (
  SELECT "partition", "offset", CAST("offset" >= floor(top / 2) AS BIGINT) AS batch_id
  FROM topic, (SELECT max("offset") + 1 AS top FROM topic))""")
    + """SELECT CAST(step AS INTEGER) AS step, batch_id, "partition", max("offset") + 1 AS end_offset,
       batch_id = 0 OR step = 1 AS committed
FROM segments, (VALUES (0), (1)) s(step) GROUP BY ALL""",
    "stream_batch_counts": _with(f"""segments AS (
  SELECT len(list_filter(range(1, {COUNT_SEGMENTS}), lambda i: floor(top * i / {COUNT_SEGMENTS}) <= "offset")) AS s
  FROM topic, (SELECT max("offset") + 1 AS top FROM topic))""")
    + """SELECT row_number() OVER (ORDER BY s) - 1 AS batch_id, count(*) AS rows,
       CAST(sum(count(*)) OVER (ORDER BY s) AS BIGINT) AS total_rows FROM segments GROUP BY s""",
    "stream_message_rate": ORACLE_SQL["message_rate"],
    "stream_dedup_first": _with()
    + f"""SELECT stock_ticker, "timestamp", arg_min(p, "offset") AS price, arg_min("partition", "offset") AS "partition",
       min("offset") AS "offset"
FROM (SELECT *, CASE WHEN "offset" % 2 = 1 THEN CAST({COPY_PRICE} AS FLOAT) ELSE price END AS p FROM valid)
WHERE "timestamp" <= (SELECT max("timestamp") FROM valid) - INTERVAL 15 MINUTES GROUP BY 1, 2""",
    "stream_watchlist": _with("""half AS (SELECT floor((max("offset") + 1) * 1 / 2) AS h FROM topic)""")
    + f"""SELECT {_VALID} FROM valid, half WHERE "offset" < h AND stock_ticker IN ({_LISTS[0]})
UNION ALL SELECT {_VALID} FROM valid, half WHERE "offset" >= h AND stock_ticker IN ({_LISTS[1]})""",
    "stream_state_keys": _with()
    + """SELECT * FROM (
  SELECT stock_ticker, time_bucket(INTERVAL '5 minutes', "timestamp") + INTERVAL '5 minutes' AS "timestamp",
         round(avg(CAST(price AS DOUBLE)), 6) AS price, count(*) AS rows FROM valid GROUP BY 1, 2)
WHERE "timestamp" > (SELECT max("timestamp") FROM valid) - INTERVAL 15 MINUTES""",
    "stream_panes": _panes_sql("30 days")
    + """SELECT stock_ticker, w AS "timestamp", round(price, 6) AS price, n AS rows, pane, CAST(i AS INTEGER) AS pane_index FROM panes""",
    "stream_allowed_lateness": _panes_sql(STREAM_LATENESS)
    + """SELECT stock_ticker, w AS "timestamp", round(max(price) FILTER (pane = 'ON_TIME'), 6) AS on_time_price,
       max(n) FILTER (pane = 'ON_TIME') AS on_time_rows, round(arg_max(price, i), 6) AS last_price, max(n) AS last_rows,
       count(*) FILTER (pane = 'LATE') AS late_panes
FROM panes GROUP BY 1, 2 HAVING count(*) FILTER (pane <> 'EARLY') > 0""",
    "stream_tumbling_mean": TUMBLING_SQL,
    "stream_upsert": TUMBLING_SQL,
    "stream_upsert_reset": TUMBLING_SQL,
    "stream_bridge": _with()
    + """SELECT event_type AS stock_ticker, date_trunc('millisecond', ts) AS "timestamp",
       arg_min(price, event_id) AS price, arg_min("partition", event_id) AS "partition", min(event_id) * 2 AS "offset"
FROM (SELECT *, CAST(value AS FLOAT) AS price, CAST(user_id % 3 AS INTEGER) AS "partition" FROM events
      WHERE event_id % 7 <> 0 AND CAST(value AS FLOAT) <> 0)
GROUP BY 1, 2""",
    "gated_run": _with()
    + """, ends AS (SELECT "partition", max("offset") + 1 AS lag FROM topic GROUP BY 1)
SELECT 0 AS step, bool_or(lag >= 25) AS ready, CAST(sum(lag) AS BIGINT) AS total_lag,
       CAST(count_if(lag >= 25) AS BIGINT) AS partitions_ready, count(*) AS partitions FROM ends
UNION ALL SELECT 1, false, 0, 0, count(*) FROM ends""",
    "stream_offsets_many": _with()
    + """SELECT CAST(user_id % 11 AS INTEGER) AS "partition", max(event_id * 2 + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) + 1
       AS committed_offset FROM events GROUP BY 1""",
    "stream_late_rows": _with()
    + """, half AS (SELECT max("offset") + 1 AS top FROM topic),
newest AS (SELECT max("timestamp") AS t FROM valid),
old AS (SELECT v.* FROM valid v, half WHERE v."offset" < floor(top * 1 / 2))
SELECT 'records' AS stage, count(*) AS rows FROM topic
UNION ALL SELECT 'valid', count(*) FROM valid
UNION ALL SELECT 'late', count(*) FROM old, newest
  WHERE "timestamp" <= t - INTERVAL '15 minutes'""",
    "stream_final_mean": _with("means AS (" + _tumbling("ticks") + ")")
    + """SELECT * FROM means WHERE "timestamp" <= (SELECT max("timestamp") FROM valid) - INTERVAL 15 MINUTES""",
    "stream_dedup": _with() + """SELECT stock_ticker, "timestamp", price, "partition" FROM ticks""",
    "stream_committed_offsets": _with()
    + """SELECT "partition", max("offset") + 1 AS committed_offset FROM topic GROUP BY 1""",
}

"""The tick stream: topic -> parse -> validate -> watermark -> dedup ->
tumbling mean -> sink, as one Structured Streaming query.

The transformation is the same chain of DataFrame functions the batch
queries use; only the de-duplication switches to its stateful form. Every
query gets an explicit ``checkpointLocation`` and ``queryName`` so a restart
resumes state and offsets instead of starting empty.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwise.functions.parse import parse_ticks, valid_ticks
from tickwise.operators.dedup import DEDUP_KEYS, dedup_ticks
from tickwise.operators.filters import watchlist
from tickwise.operators.windows import WATERMARK, WINDOW, tumbling_mean, with_event_time
from tickwise.sinks.keyed_table import KeyedTable
from tickwise.streaming.control import progress_feed

# Salt buckets for streams with hot groups of copies (opt-in).
SALT_BUCKETS = 16


def clean_tick_stream(
    records: DataFrame,
    *,
    watermark: str = WATERMARK,
    dedup_keys: Sequence[str] = DEDUP_KEYS,
    keep: Sequence[str] = ("stock_ticker", "timestamp", "price"),
    salt_buckets: int | None = None,
) -> DataFrame:
    """Valid ticks, de-duplicated within the watermark.

    ``salt_buckets`` splits a hot group of copies: a first de-duplication on
    the key plus a salt (a hash of the record's position) spreads the copies
    of one key over that many tasks and keeps at most one per salt; the
    second, on the key alone, then sees at most ``salt_buckets`` copies per
    key instead of all of them. Costs one more shuffle and state store.
    """
    parsed = valid_ticks(parse_ticks(records))
    if salt_buckets:
        pos = [F.col(c) for c in ("partition", "offset") if c in parsed.columns] or [F.col("price")]
        parsed = parsed.withColumn("_salt", F.pmod(F.xxhash64(*pos), F.lit(salt_buckets)))
        timed = with_event_time(parsed.select(*keep, "_salt"), "timestamp", watermark)
        timed = dedup_ticks(timed, [*dedup_keys, "_salt"]).drop("_salt")
    else:
        timed = with_event_time(parsed.select(*keep), "timestamp", watermark)
    return dedup_ticks(timed, dedup_keys)


def tick_means(
    records: DataFrame,
    *,
    window: str = WINDOW,
    watermark: str = WATERMARK,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Output rows ``(stock_ticker, timestamp = window end, price = mean)``."""
    return tumbling_mean(clean_tick_stream(records, watermark=watermark, salt_buckets=salt_buckets), window)


def start(
    df: DataFrame,
    *,
    name: str,
    checkpoint: str,
    mode: str = "update",
    trigger: dict | None = None,
    sink: str | None = None,
    path: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    options: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a query. ``trigger`` is passed to ``DataStreamWriter.trigger``
    (``{"processingTime": "1 minute"}`` for early results every minute,
    ``{"availableNow": True}`` for a run that drains the topic and stops).

    ``state_partitions`` sets the number of state-store partitions of a new
    query; without it the session's ``spark.sql.shuffle.partitions`` holds.
    Spark records the number in the checkpoint at the first start and keeps it
    for the query's lifetime. The setting is read when the query starts, so it
    is set for that moment only; start queries that pass a number from one
    thread.
    """
    spark = df.sparkSession
    progress_feed(spark).expect(name)  # before the start, so that no record is missed
    if state_partitions is None:
        return _start(df, name=name, checkpoint=checkpoint, mode=mode, trigger=trigger, sink=sink,
                      path=path, foreach_batch=foreach_batch, options=options)
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return _start(df, name=name, checkpoint=checkpoint, mode=mode, trigger=trigger, sink=sink,
                      path=path, foreach_batch=foreach_batch, options=options)
    finally:
        spark.conf.set(key, previous)


def _start(df, *, name, checkpoint, mode, trigger, sink, path, foreach_batch, options) -> StreamingQuery:
    w = df.writeStream.queryName(name).option("checkpointLocation", checkpoint).outputMode(mode)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif sink:
        w = w.format(sink)
    if path:
        return w.start(path)
    return w.start()


def upsert_batches(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: upsert each micro-batch into ``table``. The
    batch is used once, by the table's first write, so nothing is persisted
    here."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch)

    return fn


def tee_batches(
    *writers: Callable[[DataFrame, int], None], console: bool = False, console_rows: int = 20
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function feeding several sinks from one query: the
    micro-batch is computed once (persisted here and nowhere else), then
    handed to each writer, so the topic is read and the state kept once
    however many targets there are. ``console`` adds a debug print of
    ``console_rows`` rows of the batch."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if console:
                print(f"-- batch {batch_id}")
                batch.show(console_rows, truncate=False)
            for w in writers:
                w(batch, batch_id)
        finally:
            batch.unpersist()

    return fn


def watched_batches(
    list_path: str, write: Callable[[DataFrame, int], None], *, key: str = "stock_ticker"
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: only rows whose ``key`` is on the list go on
    to ``write``. The list is a Parquet folder with a column ``key``, read anew
    for each micro-batch, so a change of the subscription holds from the next
    micro-batch on, without a restart."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        symbols = batch.sparkSession.read.schema(f"`{key}` string").parquet(list_path)
        write(watchlist(batch, symbols, key=key), batch_id)

    return fn


def changelog_batches(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: append each micro-batch with its id to a
    Parquet change log (one folder per batch id, overwritten on replay, so
    a replayed batch does not add rows twice)."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        # the folder name carries the id (read back as a partition column)
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return fn


def offset_batches(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the next offset per topic partition behind
    the rows of each micro-batch (``partition, end_offset``), from the batch
    itself: one small folder per batch id, overwritten on replay. Rows that were
    filtered out before do not count. ``sources.checkpoint.batch_offsets`` tells
    which of them are committed."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        ends = batch.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))
        ends.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return fn


def latest_per_key(changelog: DataFrame, keys: Sequence[str] = ("stock_ticker", "timestamp")) -> DataFrame:
    """Last emitted value per key of an update-mode change log (what a
    consumer of early results ends up with)."""
    rest = [c for c in changelog.columns if c not in keys and c != "batch_id"]
    return changelog.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest])

"""Registered batch queries: ``(spark, sf_dir) -> DataFrame``.

Each one reads the driver tables (through the events-derived topic) whole;
parameters that pick ranges are the feature of the operator (a bounded read,
a watchlist), never a way to shrink the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.parse import parse_ticks, valid_ticks
from tickwise.functions.quotes import decode_quotes, encode_frames, enum_name, quote_json
from tickwise.operators.dedup import dedup_ticks
from tickwise.operators.filters import watchlist
from tickwise.operators.offsets import (
    committed_offsets_before,
    end_offsets,
    latest_offsets,
    topic_lag,
    topic_ready,
)
from tickwise.operators.rates import StageTaps, message_rate
from tickwise.operators.upsert import key_violations, last_write, upsert_latest
from tickwise.operators.windows import WINDOW, mean_per_key, tumbling_mean
from tickwise.plans.common import clean_ticks, ntz, parsed, rejects, rounded, table, topic_records
from tickwise.schemas import ENUMS, QUOTE_FIELDS
from tickwise.session import scratch_path
from tickwise.plans.events import epoch_millis, event_time, full_quotes, market_hours_code
from tickwise.sources.topic import append_segment, bounded_read, read_topic, topic_extent

# Query parameters (fixed so the SQL oracles can state the same thing).
WATCHLIST = ("click", "purchase", "view")
# A consumer that has processed everything up to 12 hours before the newest record.
CONSUMER_BEHIND = "INTERVAL 12 HOURS"
# Split of the upsert scenario: the target holds windows computed up to
# ten days before the newest tick, the update batch recomputes from seven
# minutes before that point on (the straddling windows conflict).
UPSERT_SPLIT = "INTERVAL 10 DAYS"
UPSERT_OVERLAP = "INTERVAL 7 MINUTES"


def q_parse_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parsed(spark, sf_dir)
    return ntz(p.withColumnRenamed("_reject", "reason"))


def q_valid_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(valid_ticks(parsed(spark, sf_dir)))


def q_rejected_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(rejects(spark, sf_dir))


def q_dedup_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(clean_ticks(spark, sf_dir))


def q_tumbling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(rounded(tumbling_mean(clean_ticks(spark, sf_dir)), "price"))


def q_mean_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mean_per_key(clean_ticks(spark, sf_dir)), "price")


def q_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(watchlist(clean_ticks(spark, sf_dir), list(WATCHLIST)))


def q_message_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(message_rate(topic_records(spark, sf_dir)))


def q_message_rate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a row for every interval between the first and the last."""
    rates = message_rate(topic_records(spark, sf_dir), every_interval=True)
    return ntz(rates.select("interval_start", "messages", "example_offsets"))


def q_topic_end_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return end_offsets(topic_records(spark, sf_dir))


def _lag_of(records: DataFrame) -> DataFrame:
    newest = records.agg(F.max("timestamp")).scalar()
    committed = committed_offsets_before(records, newest - F.expr(CONSUMER_BEHIND))
    return topic_lag(end_offsets(records), committed)


def _lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lag_of(topic_records(spark, sf_dir))


def q_topic_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lag(spark, sf_dir)


def q_topic_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_ready(_lag(spark, sf_dir))


def q_latest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(latest_offsets(topic_records(spark, sf_dir)))


def _upsert_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed means of the target (``side`` 0) and of the update batch (1)
    from one pass over the ticks: a tick of the overlap counts on both sides."""
    valid = valid_ticks(parsed(spark, sf_dir))
    split = valid.agg(F.max("timestamp")).scalar() - F.expr(UPSERT_SPLIT)
    ts = F.col("timestamp")
    sides = F.array_compact(
        F.array(F.when(ts < split, F.lit(0)), F.when(ts >= split - F.expr(UPSERT_OVERLAP), F.lit(1)))
    )
    ticks = dedup_ticks(valid).select("stock_ticker", "timestamp", "price", F.explode(sides).alias("side"))
    return (
        ticks.groupBy(F.window("timestamp", WINDOW).alias("window"), "stock_ticker", "side")
        .agg(F.avg("price").alias("price"))
        .select("stock_ticker", F.col("window.end").alias("timestamp"), "price", "side")
    )


def q_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(rounded(last_write(_upsert_sides(spark, sf_dir), "side"), "price"))


def q_upsert_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the two sides as frames of their own."""
    sides = _upsert_sides(spark, sf_dir)
    target, updates = (sides.where(F.col("side") == i).drop("side") for i in (0, 1))
    return ntz(rounded(upsert_latest(target, updates), "price"))


def q_target_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A plain append of the update batch (INSERT without ON CONFLICT) breaks
    # the primary key exactly where the batches overlap.
    return ntz(key_violations(_upsert_sides(spark, sf_dir).drop("side"), not_null=("price",)))


def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    taps = StageTaps()
    records = taps.tap(topic_records(spark, sf_dir), "records")
    ticks = taps.tap(valid_ticks(parse_ticks(records)), "valid")
    unique = taps.tap(dedup_ticks(ticks), "deduplicated")
    windows = taps.tap(tumbling_mean(unique), "windows")
    windows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(taps.counts(), "step int, stage string, rows bigint")


def quotes_from_events(events: DataFrame) -> DataFrame:
    """``(event_id, quote)`` with the quote fields an event carries: id,
    price, time (epoch ms) and the trading session of its time."""
    code = market_hours_code(event_time(events, "ts"))
    return events.select(
        "event_id",
        F.struct(
            F.col("event_type").alias("id"),
            F.col("value").cast("float").alias("price"),
            epoch_millis(events, "ts").alias("time"),
            enum_name(code, "MarketHoursType").alias("marketHours"),
        ).alias("quote"),
    )


def q_encode_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quotes_from_events(table(spark, sf_dir, "events"))
    return q.select("event_id", quote_json(F.col("quote"), ["id", "price", "time", "marketHours"]).alias("json"))


def q_decode_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quotes_from_events(table(spark, sf_dir, "events"))
    frames = q.select("event_id", encode_frames(F.col("quote")).alias("frame"))
    d = decode_quotes(frames, fields=("id", "price", "time", "marketHours"))
    return d.select(
        "event_id",
        F.col("quote.id").alias("id"),
        F.col("quote.price").alias("price"),
        F.col("quote.time").alias("time"),
        F.col("quote.marketHours").alias("market_hours"),
    )


def q_encode_quotes_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON of quotes with all 33 fields, with nulls and defaults among them."""
    q = full_quotes(table(spark, sf_dir, "events"))
    return q.select("event_id", quote_json(F.col("quote")).alias("json"))


def q_decode_frames_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same quotes through frames and back; integers as text, since readers
    of nullable integers may go through doubles."""
    q = full_quotes(table(spark, sf_dir, "events"))
    d = decode_quotes(q.select("event_id", encode_frames(F.col("quote")).alias("frame")))
    value = lambda name, kind: F.col(f"quote.{name}").cast("string") if kind == "sint64" else F.col(f"quote.{name}")
    return d.select("event_id", *[value(name, kind).alias(name) for name, _, kind in QUOTE_FIELDS])


def q_enum_names_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of all codes of the three enums, and of codes without a name."""
    code = (F.col("event_id") % 1100).cast("int")
    events = table(spark, sf_dir, "events").groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("events"))
    return events.select("code", "events", *[enum_name(F.col("code"), e).alias(e) for e in ENUMS])


def q_enum_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    code = market_hours_code(event_time(events, "ts"))
    return (
        events.select(code.alias("market_hours_code"))
        .groupBy("market_hours_code")
        .agg(F.count(F.lit(1)).alias("ticks"))
        .select("market_hours_code", enum_name(F.col("market_hours_code"), "MarketHoursType").alias("market_hours"), "ticks")
    )


def q_batch_topic_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the topic to files, then read what a gated run would consume:
    per partition, ``[committed offset, end offset)`` as found by the lag
    check. The ranges are one row per topic partition (the offset map a
    Kafka read takes as ``startingOffsets`` / ``endingOffsets``); the
    records themselves never leave the executors. Filters reach the Parquet
    scan: partition folders pruned, offset bounds pushed."""
    path = scratch_path(spark, "batch_topic_read")
    append_segment(topic_records(spark, sf_dir), path)
    ranges = _lag_of(read_topic(spark, path=path, streaming=False)).collect()
    starting = {r["partition"]: r["committed_offset"] for r in ranges}
    ending = {r["partition"]: r["end_offset"] for r in ranges}
    df = bounded_read(spark, path=path, starting=starting, ending=ending)
    return ntz(df.select("partition", "offset", F.col("value").cast("string").alias("value"), "timestamp"))


def q_topic_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, first and end offset of every partition of a stored topic,
    from the statistics of its files."""
    path = scratch_path(spark, "topic_extent")
    append_segment(topic_records(spark, sf_dir), path)
    return topic_extent(spark, path)


QUERIES = {
    "topic_extent": q_topic_extent,
    "parse_ticks": q_parse_ticks,
    "valid_ticks": q_valid_ticks,
    "rejected_ticks": q_rejected_ticks,
    "dedup_ticks": q_dedup_ticks,
    "tumbling_mean": q_tumbling_mean,
    "mean_per_key": q_mean_per_key,
    "watchlist": q_watchlist,
    "message_rate": q_message_rate,
    "message_rate_all": q_message_rate_all,
    "topic_end_offsets": q_topic_end_offsets,
    "topic_lag": q_topic_lag,
    "topic_ready": q_topic_ready,
    "latest_offsets": q_latest_offsets,
    "upsert_latest": q_upsert_latest,
    "upsert_frames": q_upsert_frames,
    "target_key_violations": q_target_key_violations,
    "stage_counts": q_stage_counts,
    "encode_quotes": q_encode_quotes,
    "decode_frames": q_decode_frames,
    "enum_names": q_enum_names,
    "encode_quotes_all": q_encode_quotes_all,
    "decode_frames_all": q_decode_frames_all,
    "enum_names_all": q_enum_names_all,
    "batch_topic_read": q_batch_topic_read,
}

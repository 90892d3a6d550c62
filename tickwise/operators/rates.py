"""Message rate per interval with bounded examples, and per-stage row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

RATE_INTERVAL = "60 seconds"
EXAMPLES = 4
CHUNK = 10_000  # intervals that are made at a time


def message_rate(
    records: DataFrame,
    interval: str = RATE_INTERVAL,
    examples: int = EXAMPLES,
    *,
    ts: str = "timestamp",
    order: Sequence[str] = ("timestamp", "partition", "offset"),
    every_interval: bool = False,
) -> DataFrame:
    """Messages per ``interval`` of record time, plus the first ``examples``
    messages of each interval in arrival order.

    The count is a partial + final aggregate. The examples use
    ``row_number() <= examples``; Catalyst turns that filter into a
    map-side ``WindowGroupLimit`` so each input task ships at most
    ``examples`` rows per interval to the shuffle, even for an interval that
    holds a third of the stream. The two per-interval results are joined
    on the interval: a shuffle join whose inputs are already partitioned by
    it, or a broadcast of the counts when they are small.

    ``every_interval`` adds the intervals without a message between the first
    and the last one, with a count of 0 and no examples.
    """
    bucket = F.window(ts, interval).start
    order_cols = [F.col(c) for c in order]
    keyed = records.select(bucket.alias("interval_start"), *[F.col(c) for c in dict.fromkeys([*order, "value"])])
    counts = keyed.groupBy("interval_start").agg(F.count(F.lit(1)).alias("messages"))
    rn = F.row_number().over(Window.partitionBy("interval_start").orderBy(*order_cols))
    first = (
        keyed.withColumn("rn", rn)
        .where(F.col("rn") <= examples)
        .groupBy("interval_start")
        .agg(F.array_sort(F.collect_list(F.struct("rn", "offset", F.col("value").cast("string").alias("msg")))).alias("ex"))
    )
    rates = counts.join(first, "interval_start").select(
        "interval_start",
        "messages",
        F.array_join(F.transform("ex", lambda x: x["offset"].cast("string")), ",").alias("example_offsets"),
        F.array_join(F.transform("ex", lambda x: x["msg"]), "\n").alias("example_messages"),
    )
    if not every_interval:
        return rates
    ends = counts.agg(F.min("interval_start").alias("a"), F.max("interval_start").alias("b")).where("a is not null")
    # numbered in chunks: a single far-off timestamp makes many rows, but no huge array
    length = f"unix_micros(timestamp_micros(0) + interval {interval})"
    numbers = ends.selectExpr("a", f"(unix_micros(b) - unix_micros(a)) div {length} as n").selectExpr(
        "a", "n", f"explode(sequence(0L, n div {CHUNK})) as c"
    )
    every = numbers.selectExpr("a", f"explode(sequence(c * {CHUNK}, least(n, c * {CHUNK} + {CHUNK - 1}))) as i").selectExpr(
        f"timestamp_micros(unix_micros(a) + i * {length}) as interval_start"
    )
    return every.join(rates, "interval_start", "left").select(
        "interval_start",
        F.coalesce("messages", F.lit(0)).cast("bigint").alias("messages"),
        F.coalesce("example_offsets", F.lit("")).alias("example_offsets"),
        F.coalesce("example_messages", F.lit("")).alias("example_messages"),
    )


class StageTaps:
    """Debug taps: row count and event-time range per named stage, gathered
    in the same pass as the real work (``DataFrame.observe``); rows are not
    changed. Batch frames use ``Observation`` objects; for streaming frames
    the metrics appear under ``observedMetrics`` of each query progress."""

    def __init__(self) -> None:
        self._obs: list[tuple[str, Observation | None]] = []

    def tap(self, df: DataFrame, name: str, ts: str | None = "timestamp") -> DataFrame:
        metrics = [F.count(F.lit(1)).alias("rows")]
        if ts and ts in df.columns:
            metrics += [F.min(ts).alias("min_time"), F.max(ts).alias("max_time")]
        if df.isStreaming:
            self._obs.append((name, None))
            return df.observe(name, *metrics)
        obs = Observation(name)
        self._obs.append((name, obs))
        return df.observe(obs, *metrics)

    def counts(self) -> list[tuple[int, str, int]]:
        """``(step, stage, rows)`` after the action that ran the plan."""
        out = []
        for i, (name, obs) in enumerate(self._obs):
            if obs is not None:
                out.append((i, name, int(obs.get.get("rows", 0))))
        return out

"""Event-time windows and per-key means.

``tumbling_mean`` is the core aggregate: mean price per (tumbling window,
ticker), labelled by the window *end*. It is one ``groupBy(window, key)``
whose hash aggregate is split by Catalyst into a partial (map-side) and a
final step, so the shuffle carries one row per (window, key, input task)
whatever the skew; in a stream the same call becomes a stateful aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = "5 minutes"
WATERMARK = "15 minutes"


def with_event_time(ticks: DataFrame, column: str = "timestamp", delay: str = WATERMARK) -> DataFrame:
    """Declare the event-time column and the late-data cutoff.

    A no-op on batch frames (Spark ignores watermarks there), so the same
    chain serves both modes.
    """
    return ticks.withWatermark(column, delay)


def window_means(
    ticks: DataFrame,
    window: str = WINDOW,
    *,
    key: str = "stock_ticker",
    ts: str = "timestamp",
    value: str = "price",
) -> DataFrame:
    """(window struct, key, mean) -- the raw aggregate."""
    return ticks.groupBy(F.window(ts, window).alias("window"), key).agg(F.avg(value).alias("avg_price"))


def to_output(windowed: DataFrame, *, key: str = "stock_ticker") -> DataFrame:
    """Output shape: ticker, window end as ``timestamp``, mean as ``price``."""
    return windowed.select(
        F.col(key).alias("stock_ticker"),
        F.col("window.end").alias("timestamp"),
        F.col("avg_price").alias("price"),
    )


def tumbling_mean(ticks: DataFrame, window: str = WINDOW, **kw) -> DataFrame:
    """Mean price per ticker in tumbling event-time windows, keyed by window end."""
    return to_output(window_means(ticks, window, **kw), key=kw.get("key", "stock_ticker"))


def mean_per_key(ticks: DataFrame, *, key: str = "stock_ticker", value: str = "price") -> DataFrame:
    """Mean per key over the whole input (the per-key combine without windows)."""
    return ticks.select(key, value).groupBy(key).agg(F.avg(value).alias("price"))

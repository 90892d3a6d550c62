"""Windowed mean with panes: early results, one on-time result, late firings.

A window has two cutoffs. The *on-time* watermark (newest event time less
``delay``) closes it: its on-time pane is emitted once. Rows that come later
still count until the window *expires* (on-time watermark ``allowed_lateness``
past its end): each of them emits a late pane of its own. Panes accumulate: a
pane's mean covers all rows of the window so far, and panes of a window are
numbered from 0.

Spark has one watermark per query, which drops rows. It is set behind both
cutoffs, so that the engine drops only rows of expired windows, and the
on-time watermark follows from it by a fixed distance. A key of the state is a
ticker and ``slot_windows`` neighbouring windows, five numbers each; its timer
is the next end or expiry among them. Early panes come with the micro-batches,
so the query's processing-time trigger (30 seconds, say) is their delay.

With a delay of hours and lateness of days, keep state in RocksDB
(``session.ROCKSDB_STATE``).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickwise.operators.windows import WATERMARK, WINDOW

ALLOWED_LATENESS = "30 days"
EARLY, ON_TIME, LATE = "EARLY", "ON_TIME", "LATE"

PANE_SCHEMA = "stock_ticker string, timestamp timestamp, price double, rows bigint, pane string, pane_index int"
_STATE = "ends array<bigint>, totals array<double>, rows array<bigint>, panes array<int>, closed array<boolean>"
SLOT_WINDOWS = 48


def _ms(duration: str) -> int:
    return int(pd.Timedelta(duration) / timedelta(milliseconds=1))


def paned_mean(
    ticks: DataFrame,
    *,
    window: str = WINDOW,
    delay: str = WATERMARK,
    allowed_lateness: str = ALLOWED_LATENESS,
    early: bool = True,
    slot_windows: int = SLOT_WINDOWS,
    order: tuple[str, ...] = ("timestamp", "offset", "partition"),
) -> DataFrame:
    """Panes of a stream of ``stock_ticker, timestamp, price`` (append mode):
    ``stock_ticker``, window end ``timestamp``, mean ``price`` and number of
    ``rows`` so far, ``pane``, ``pane_index``. Late rows of one micro-batch
    fire in the order of those columns of ``order`` that ``ticks`` has. A row
    for a window that was closed before any row came is late at once."""
    length, late_for = _ms(window), _ms(allowed_lateness)
    behind = late_for + length  # from the engine's watermark to the on-time one
    order = [c for c in order if c in ticks.columns]

    def fire(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ticker = key[0]
        on_time = state.getCurrentWatermarkMs() + behind
        # window end -> [total, rows, panes, closed]
        windows = {e: list(w) for e, *w in zip(*state.get, strict=True)} if state.exists else {}
        out: list[tuple] = []

        def pane(end: int, kind: str) -> None:
            w = windows[end]
            out.append((ticker, end, w[0] / w[1], w[1], kind, w[2]))
            w[2] += 1

        for end, w in sorted(windows.items()):
            if not w[3] and on_time >= end:
                w[3] = True
                pane(end, ON_TIME)
        if not state.hasTimedOut:
            parts = [b for b in batches if len(b)]
            new = pd.concat(parts) if len(parts) > 1 else parts[0]
            new = new.sort_values(order) if order else new
            touched = set()
            for end, price in zip(new["window_end"].tolist(), new["price"].tolist(), strict=True):
                if on_time >= end + late_for:  # the window is gone
                    continue
                w = windows.setdefault(end, [0.0, 0, 0, on_time >= end])
                w[0], w[1] = w[0] + price, w[1] + 1
                if w[3]:
                    pane(end, LATE)
                else:
                    touched.add(end)
            if early:
                for end in sorted(touched):
                    pane(end, EARLY)
        windows = {e: w for e, w in windows.items() if on_time < e + late_for}
        if windows:
            state.update(tuple(zip(*[(e, *w) for e, w in windows.items()], strict=True)))
            # a timer fires once the watermark is past it
            state.setTimeoutTimestamp(min(e - (length if w[3] else behind) for e, w in windows.items()) - 1)
        elif state.exists:
            state.remove()
        if out:
            panes = pd.DataFrame(out, columns=["stock_ticker", "timestamp", "price", "rows", "pane", "pane_index"])
            panes["timestamp"] = pd.to_datetime(panes["timestamp"], unit="ms")
            yield panes

    timed = ticks.withWatermark("timestamp", f"{_ms(delay) + behind} milliseconds")
    keyed = timed.select(
        *[c for c in timed.columns if c != "price"],
        F.col("price").cast("double").alias("price"),
        F.unix_millis(F.window("timestamp", window).end).alias("window_end"),
    ).withColumn("slot", F.floor((F.col("window_end") - 1) / F.lit(length * slot_windows)))
    return keyed.groupBy("stock_ticker", "slot").applyInPandasWithState(
        fire, PANE_SCHEMA, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )

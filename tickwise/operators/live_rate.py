"""Message rate of a running stream: count and first examples per interval.

A window keeps its count and its ``examples`` first messages, never the
messages themselves. Both merge: each input batch is cut down to that before
the shuffle, so an interval that holds a third of the stream sends a few rows
a batch, and the state of an interval is merged with them. A key of the state is
a slot of ``slot_intervals`` neighbouring intervals.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickwise.operators.rates import EXAMPLES, RATE_INTERVAL
from tickwise.operators.windows import WATERMARK

SLOT_INTERVALS = 60
RATE_SCHEMA = "interval_start timestamp, messages bigint, example_offsets string, example_messages string"
# one row an example of a batch; the first of an interval carries the count
_PART = "event_time timestamp, start bigint, messages bigint, at bigint, partition int, offset bigint, message string"
_STATE = (
    "starts array<bigint>, messages array<bigint>, at array<array<bigint>>, partitions array<array<int>>, "
    "offsets array<array<bigint>>, texts array<array<string>>"
)
_ORDER = ["start", "at", "partition", "offset"]


def _parts(records: DataFrame, interval: str, examples: int, ts: str) -> DataFrame:
    """Count and first examples of each interval in each input batch."""
    slim = records.select(
        F.unix_millis(F.window(ts, interval).start).alias("start"),
        F.unix_micros(ts).alias("at"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("value").cast("string").alias("message"),
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            batch = batch.sort_values(_ORDER, ignore_index=True)
            place = batch.groupby("start").cumcount()
            batch["messages"] = batch.groupby("start")["at"].transform("size").where(place == 0, 0)
            # the newest time of the batch's interval drives the watermark
            batch["event_time"] = pd.to_datetime(batch.groupby("start")["at"].transform("max"), unit="us")
            yield batch.loc[place < examples, ["event_time", "start", "messages", "at", "partition", "offset", "message"]]

    return slim.mapInPandas(cut, _PART)


def live_message_rate(
    records: DataFrame,
    interval: str = RATE_INTERVAL,
    examples: int = EXAMPLES,
    *,
    delay: str = WATERMARK,
    ts: str = "timestamp",
    slot_intervals: int = SLOT_INTERVALS,
) -> DataFrame:
    """``interval_start, messages, example_offsets, example_messages`` of a
    stream of topic records, in update mode: an interval comes again whenever
    it grows. Examples are the first by time, partition and offset. An
    interval's state goes once the watermark has passed its slot."""
    length = int(pd.Timedelta(interval).total_seconds() * 1000)

    def merge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        # interval start -> [messages, [(at, partition, offset, message), ...]]
        known = {}
        if state.exists:
            for start, n, *lists in zip(*state.get, strict=True):
                known[start] = [n, list(zip(*lists, strict=True))]
        changed: set[int] = set()
        for batch in batches:
            for _, start, n, *example in batch[["slot", "start", "messages", "at", "partition", "offset", "message"]].itertuples(
                index=False, name=None
            ):
                entry = known.setdefault(start, [0, []])
                entry[0] += n
                entry[1].append(tuple(example))
                changed.add(start)
        for start in changed:
            known[start][1] = sorted(known[start][1], key=lambda e: e[:3])[:examples]
        state.update(tuple(zip(*[(s, n, *map(list, zip(*ex, strict=True))) for s, (n, ex) in sorted(known.items())], strict=True)))
        state.setTimeoutTimestamp(max((int(key[0]) + 1) * length * slot_intervals, state.getCurrentWatermarkMs() + 1))
        rows = []
        for start in sorted(changed):
            n, first = known[start]
            messages = "\n".join(e[3] for e in first if e[3] is not None)
            rows.append((pd.Timestamp(start, unit="ms"), n, ",".join(str(e[2]) for e in first), messages))
        yield pd.DataFrame(rows, columns=["interval_start", "messages", "example_offsets", "example_messages"])

    timed = _parts(records, interval, examples, ts).withWatermark("event_time", delay)
    slotted = timed.withColumn("slot", F.floor(F.col("start") / F.lit(length * slot_intervals)))
    return slotted.groupBy("slot").applyInPandasWithState(
        merge, RATE_SCHEMA, _STATE, "update", GroupStateTimeout.EventTimeTimeout
    )

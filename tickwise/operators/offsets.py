"""Topic offsets: end offsets, committed offsets, lag and the start gate.

Every input here is a DataFrame of ``(partition, offset)`` rows (one per
topic partition after aggregation), so all of it runs as partial + final
aggregates over the topic and small joins keyed by partition. The joins are
left to AQE: both sides are aggregates with one row per topic partition and
AQE turns the join into a broadcast from their measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START_THRESHOLD = 25


def end_offsets(records: DataFrame) -> DataFrame:
    """High watermark per partition: ``max(offset) + 1`` (``partition, end_offset``)."""
    return records.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))


def committed_offsets_before(records: DataFrame, cutoff: Column) -> DataFrame:
    """Offsets a consumer has committed after processing every record whose
    timestamp is before ``cutoff``: ``max(offset) + 1`` of those records."""
    return (
        records.where(F.col("timestamp") < cutoff)
        .groupBy("partition")
        .agg((F.max("offset") + 1).alias("committed_offset"))
    )


def latest_offsets(df: DataFrame, *, by: str = "timestamp", keys: tuple[str, ...] = ("partition",)) -> DataFrame:
    """Offset of the newest row per partition (argmax of ``by``; ties go to
    the larger offset so the answer is deterministic).

    The (``by``, offset) order is packed into one DECIMAL(38,0) key --
    ``by`` in microseconds times 10^18 plus the offset -- so the aggregate
    buffer stays fixed-width and Spark plans a hash aggregate with a partial
    step; a struct-valued ordering would force a sort of every row.
    """
    dtype = df.schema[by].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        major = F.unix_micros(F.col(by).cast("timestamp"))
    else:
        major = F.col(by).cast("bigint")
    order = major.cast("decimal(20,0)") * F.lit(10**18).cast("decimal(19,0)") + F.col("offset").cast("decimal(19,0)")
    return df.groupBy(*keys).agg(
        F.max_by("offset", order).alias("offset"),
        F.max(by).alias(by),
    )


def topic_lag(
    ends: DataFrame,
    committed: DataFrame,
    *,
    threshold: int = START_THRESHOLD,
) -> DataFrame:
    """Lag per partition = end - committed (missing committed offset = 0; a
    committed offset past the end, e.g. after the topic was truncated, counts
    as no lag rather than a negative one).

    Every partition of the topic is reported, also ones the consumer never
    saw. ``committed`` needs ``partition`` and ``committed_offset``.
    """
    c = committed.select("partition", "committed_offset")
    joined = ends.join(c, "partition", "left")
    committed_or_zero = F.coalesce(F.col("committed_offset"), F.lit(0).cast("bigint"))
    lag = F.greatest(F.col("end_offset") - committed_or_zero, F.lit(0).cast("bigint"))
    return joined.select(
        "partition",
        committed_or_zero.alias("committed_offset"),
        "end_offset",
        lag.alias("lag"),
        (lag >= F.lit(threshold)).alias("ready"),
    )


def topic_ready(lag: DataFrame, *, threshold: int = START_THRESHOLD) -> DataFrame:
    """One row: start when *any* partition has ``threshold`` or more waiting
    records, plus the total lag and how many partitions qualify."""
    over = F.col("lag") >= F.lit(threshold)
    return lag.agg(
        F.coalesce(F.bool_or(over), F.lit(False)).alias("ready"),
        F.coalesce(F.sum("lag"), F.lit(0).cast("bigint")).alias("total_lag"),
        F.count_if(over).alias("partitions_ready"),
        F.count(F.lit(1)).alias("partitions"),
    )


def offsets_from_map(spark, offsets: dict[int, int], name: str = "committed_offset") -> DataFrame:
    """A ``{partition: offset}`` map (as a scheduler hands it over) as a DataFrame."""
    rows = [(int(p), int(o)) for p, o in sorted(offsets.items())]
    return spark.createDataFrame(rows, f"partition int, {name} bigint")

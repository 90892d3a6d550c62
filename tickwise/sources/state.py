"""What a streaming query's state holds, read from its checkpoint with
Spark's state data source (``statestore``, ``state-metadata``): one row a key,
as of the last committed batch. Useful to see open windows, and whether the
keys are spread evenly over the state partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``operator_id, operator, store, partitions`` of the query's operators."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorId").alias("operator_id"),
        F.col("operatorName").alias("operator"),
        F.col("stateStoreName").alias("store"),
        F.col("numPartitions").alias("partitions"),
    )


def state_rows(spark: SparkSession, checkpoint: str, *, operator_id: int = 0) -> DataFrame:
    """``partition_id`` and the structs ``key`` and ``value`` of every key."""
    rows = spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)
    return rows.select("partition_id", "key", "value")


def keys_per_partition(spark: SparkSession, checkpoint: str, *, operator_id: int = 0) -> DataFrame:
    """``partition_id, keys``; partitions without a key are not listed."""
    return state_rows(spark, checkpoint, operator_id=operator_id).groupBy("partition_id").agg(F.count(F.lit(1)).alias("keys"))


def open_windows(spark: SparkSession, checkpoint: str, *, operator_id: int = 0) -> DataFrame:
    """The windows of a mean that the watermark has not closed: key columns,
    window end ``timestamp``, mean ``price`` and number of ``rows`` so far."""
    rows = state_rows(spark, checkpoint, operator_id=operator_id)
    window = next(c for c in rows.schema["key"].dataType.names if c.startswith("window"))
    others = [c for c in rows.schema["key"].dataType.names if c != window]
    return rows.select(
        *[F.col(f"key.{c}").alias(c) for c in others],
        F.col(f"key.{window}.end").alias("timestamp"),
        (F.col("value.sum") / F.col("value.count")).alias("price"),
        F.col("value.count").alias("rows"),
    )

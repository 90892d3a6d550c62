"""Shared building blocks of the registered queries: table loading, the
events-derived topic, and output normalisation for oracle comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.functions.parse import parse_ticks, rejected_ticks, valid_ticks
from tickwise.operators.dedup import dedup_ticks
from tickwise.session import ensure_utc
from tickwise.plans.events import events_to_topic

# Means are rounded to 6 decimals in query outputs: the order of a distributed
# sum is not fixed, so the last bits of a double mean differ between engines.
MEAN_DIGITS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def topic_records(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """The ``events`` table delivered as tick messages on a topic (with the
    fixed replay / corruption faults)."""
    return events_to_topic(table(spark, sf_dir, "events"), **kw)


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ticks(topic_records(spark, sf_dir))


def clean_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid, de-duplicated ticks (batch)."""
    return dedup_ticks(valid_ticks(parsed(spark, sf_dir)))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_ticks(parsed(spark, sf_dir))


def ntz(df: DataFrame) -> DataFrame:
    """Cast ``TIMESTAMP`` columns to ``TIMESTAMP_NTZ`` (UTC wall time) so the
    output compares equal with engines whose timestamps are zone-less."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(
        *[F.round(F.col(c), MEAN_DIGITS).alias(c) if c in names else F.col(c) for c in df.columns]
    )

"""Topic sources: Kafka when its connector is on the classpath, otherwise a
file-backed topic with the same record layout (``TOPIC_SCHEMA``).

A file-backed topic is a Parquet folder partitioned by ``topic`` and
``partition``, records in offset order. Each append is one "segment" of the log;
a streaming reader picks segments up in commit order, which is how a producer
appends to a topic. Offset ranges are read from the row groups that hold them,
and end offsets from the files' statistics.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwise.schemas import TOPIC_SCHEMA
from tickwise.session import ensure_utc

DEFAULT_TOPIC = "data_stream"
FOLDERS = ("topic", "partition")


# ---------------------------------------------------------------------------
# Readers
# ---------------------------------------------------------------------------
def read_topic(
    spark: SparkSession,
    *,
    fmt: str = "parquet",
    path: str | None = None,
    topic: str = DEFAULT_TOPIC,
    streaming: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a topic as a (streaming) DataFrame of topic records.

    ``fmt="kafka"`` passes ``options`` straight to the Kafka source
    (``kafka.bootstrap.servers``, ``startingOffsets``, ``maxOffsetsPerTrigger``,
    ``minPartitions`` ...) and subscribes to ``topic``. ``fmt="parquet"``
    reads a file-backed topic at ``path``; ``maxFilesPerTrigger`` and the
    other file-source options are accepted in ``options``.
    """
    opts = dict(options or {})
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        reader = reader.format("kafka").option("subscribe", topic)
        for k, v in opts.items():
            reader = reader.option(k, v)
        return reader.load()
    if path is None:
        raise ValueError("a file-backed topic needs a path")
    reader = reader.format(fmt).schema(TOPIC_SCHEMA)
    for k, v in opts.items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return df.select(*TOPIC_SCHEMA.fieldNames()).where(F.col("topic") == topic)


def bounded_read(
    spark: SparkSession,
    *,
    fmt: str = "parquet",
    path: str | None = None,
    topic: str = DEFAULT_TOPIC,
    starting: Mapping[int, int] | None = None,
    ending: Mapping[int, int] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Batch read of a bounded offset range of a topic.

    Partitions that a map leaves out are read from the beginning or to the
    end. For Kafka the ranges become ``startingOffsets`` / ``endingOffsets``
    JSON (-2 and -1 stand for a partition's beginning and end; the source wants
    every partition of the topic named in one map or the other). Of files, each
    named partition is a scan of its own folder with its bounds pushed to the
    row groups, and the others are one scan without a bound.
    """
    starting, ending = dict(starting or {}), dict(ending or {})
    parts = sorted({int(p) for p in (*starting, *ending)})
    if fmt == "kafka":
        opts = dict(options or {})
        if starting:
            opts["startingOffsets"] = json.dumps({topic: {str(p): starting.get(p, -2) for p in parts}})
        if ending:
            opts["endingOffsets"] = json.dumps({topic: {str(p): ending.get(p, -1) for p in parts}})
        return read_topic(spark, fmt="kafka", topic=topic, streaming=False, options=opts)
    df = read_topic(spark, fmt=fmt, path=path, topic=topic, streaming=False, options=options)
    out = df.where(~F.col("partition").isin(parts)) if parts else df
    for p in parts:  # one a topic partition
        ranged = df.where(F.col("partition") == p)
        if p in starting:
            ranged = ranged.where(F.col("offset") >= starting[p])
        if p in ending:
            ranged = ranged.where(F.col("offset") < ending[p])
        out = out.unionAll(ranged)
    return out


def topic_extent(spark: SparkSession, path: str, topic: str = DEFAULT_TOPIC, *, files: Sequence[str] | None = None) -> DataFrame:
    """``partition, records, first_offset, end_offset`` of a file-backed topic,
    or of some of its ``files``, one row a partition. Parquet keeps counts and bounds of a column in a
    file's footer; with Spark's aggregate push-down no record is read. The
    settings are those of a session of its own, which shares the context."""
    own = spark.newSession()
    ensure_utc(own)
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    reader = own.read.schema(TOPIC_SCHEMA).option("basePath", path)
    records = reader.parquet(*(files or [path])).where(F.col("topic") == topic)
    extent = records.groupBy(*FOLDERS).agg(F.count(F.lit(1)).alias("records"), F.min("offset").alias("low"), F.max("offset").alias("high"))
    return extent.select("partition", "records", F.col("low").alias("first_offset"), (F.col("high") + 1).alias("end_offset"))


# ---------------------------------------------------------------------------
# Writers (producer side)
# ---------------------------------------------------------------------------
def append_segment(records: DataFrame, path: str) -> None:
    """Append one log segment to a file-backed topic."""
    (
        records.select(*TOPIC_SCHEMA.fieldNames())
        .sortWithinPartitions(*FOLDERS, "offset")
        .write.mode("append")
        .partitionBy(*FOLDERS)
        .parquet(path)
    )


def publish(records: DataFrame, *, fmt: str = "parquet", path: str | None = None,
            topic: str = DEFAULT_TOPIC, options: Mapping[str, str] | None = None) -> None:
    """Publish a DataFrame with a ``value`` column to a topic (batch).

    Kafka: the connector writes ``value`` and, where there is one, ``key``.
    Files: ``records`` must already carry the full topic record layout.
    """
    if fmt == "kafka":
        w = kafka_record(records).write.format("kafka").option("topic", topic)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
        return
    if path is None:
        raise ValueError("a file-backed topic needs a path")
    append_segment(records, path)


def kafka_record(records: DataFrame) -> DataFrame:
    """The columns that Kafka's writer takes: ``value`` and, if present, ``key``."""
    return records.select(*[c for c in ("key", "value") if c in records.columns])


def publish_stream(
    records: DataFrame,
    *,
    name: str,
    checkpoint: str,
    fmt: str = "parquet",
    path: str | None = None,
    topic: str = DEFAULT_TOPIC,
    trigger: dict | None = None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Publish a stream of records to a topic, batch by batch."""
    if fmt == "kafka":
        w = kafka_record(records).writeStream.format("kafka").option("topic", topic)
    elif path is None:
        raise ValueError("a file-backed topic needs a path")
    else:
        w = records.select(*TOPIC_SCHEMA.fieldNames()).writeStream.format("parquet").partitionBy(*FOLDERS).option("path", path)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.queryName(name).option("checkpointLocation", checkpoint).outputMode("append").start()

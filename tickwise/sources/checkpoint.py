"""Offsets recorded in a Structured Streaming checkpoint.

Spark's checkpoint layout: ``offsets/<batchId>`` is written *before* a
batch runs (line 1 ``v1``, line 2 batch metadata with ``batchTimestampMs``,
then one line per source), ``commits/<batchId>`` *after* its sink write.
Only batches present in both are committed. Kafka sources store
``{"topic": {"partition": offset}}``; other sources store their own JSON,
kept as ``source_offset`` text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.session import path_exists
from tickwise.sources.topic import topic_extent

_ID = r"^([0-9]+)$"


def _batch_files(spark: SparkSession, path: str) -> DataFrame:
    # hidden files (``.0.crc``, temp files) are skipped by the file source;
    # names with an extension are dropped by the numeric-name rule
    df = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), _ID, 1).alias("_id"), "value"
    )
    return df.where(F.col("_id") != "").select(F.col("_id").cast("bigint").alias("batch_id"), "value")


def checkpoint_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per (batch, source, topic partition):
    ``batch_id, batch_timestamp_ms, source, source_offset, topic, partition,
    offset, committed``. ``topic``/``partition``/``offset`` are NULL for
    sources whose offsets are not per partition."""
    checkpoint = checkpoint.rstrip("/")
    offs = _batch_files(spark, f"{checkpoint}/offsets")
    lines = F.split(F.col("value"), "\n")
    batches = offs.select(
        "batch_id",
        F.get_json_object(lines.getItem(1), "$.batchTimestampMs").cast("bigint").alias("batch_timestamp_ms"),
        F.posexplode(F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0)))).alias("source", "source_offset"),
    ).where(F.length(F.trim("source_offset")) > 0)
    per_topic = F.from_json(F.col("source_offset"), "map<string,map<string,bigint>>")
    exploded = batches.select(
        "*", F.explode_outer(F.coalesce(per_topic, F.create_map())).alias("topic", "_parts")
    ).select(
        "batch_id", "batch_timestamp_ms", "source", "source_offset", "topic",
        F.explode_outer(F.coalesce(F.col("_parts"), F.create_map())).alias("_p", "offset"),
    ).select(
        "batch_id", "batch_timestamp_ms", "source", "source_offset", "topic",
        F.col("_p").cast("int").alias("partition"), "offset",
    )
    if path_exists(spark, f"{checkpoint}/commits"):
        commits = _batch_files(spark, f"{checkpoint}/commits").select("batch_id", F.lit(True).alias("committed"))
        exploded = exploded.join(commits, "batch_id", "left")
    else:
        exploded = exploded.withColumn("committed", F.lit(None).cast("boolean"))
    return exploded.withColumn("committed", F.coalesce("committed", F.lit(False)))


def committed_topic_offsets(spark: SparkSession, checkpoint: str, topic: str) -> DataFrame:
    """Next offset per partition after the newest *committed* batch
    (``partition, committed_offset``); batches whose write did not finish
    are ignored."""
    rows = checkpoint_offsets(spark, checkpoint).where(F.col("committed") & (F.col("topic") == topic))
    return rows.groupBy("partition").agg(F.max_by("offset", "batch_id").alias("committed_offset"))


def batch_offsets(spark: SparkSession, checkpoint: str, path: str) -> DataFrame:
    """What ``jobs.offset_batches`` wrote to ``path``, and whether the batch is
    committed: ``batch_id, partition, end_offset, committed``. A batch that
    wrote its rows but did not finish is there as not committed."""
    known = checkpoint_offsets(spark, checkpoint).groupBy("batch_id").agg(F.bool_or("committed").alias("committed"))
    ends = spark.read.schema("partition int, end_offset bigint, batch_id bigint").parquet(path)
    return ends.join(known, "batch_id", "left").select(
        "batch_id", "partition", "end_offset", F.coalesce("committed", F.lit(False)).alias("committed")
    )


def source_files(spark: SparkSession, checkpoint: str, *, after: int = -1, upto: int, source: int = 0) -> DataFrame:
    """Files that a file source handed to batches: ``log_offset, file`` for
    log offsets in ``(after, upto]``. The source log holds one JSON line per
    file; a compacted log file repeats those of earlier ones."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/sources/{source}").where(F.col("value").startswith("{"))
    entry = F.from_json("value", "path string, batchId bigint")
    found = lines.select(entry.alias("e")).select(F.col("e.batchId").alias("log_offset"), F.col("e.path").alias("file"))
    return found.where((F.col("log_offset") > after) & (F.col("log_offset") <= upto)).distinct()


def file_topic_offsets(spark: SparkSession, checkpoint: str, topic_path: str, topic: str, *, after: int = -1, upto: int) -> DataFrame:
    """Next offset per partition (``partition, committed_offset``) behind the
    records of a file-backed topic that those batches read: whatever
    partitions the files hold. The reader is given these files and takes the
    maximum from their footers, so neither other files nor any record is read."""
    named = source_files(spark, checkpoint, after=after, upto=upto).select(F.url_decode("file").alias("file")).distinct()
    files = [r.file for r in named.collect()]  # names only, of the files since the last snapshot
    if not files:
        return spark.createDataFrame([], "partition int, committed_offset bigint")
    return topic_extent(spark, topic_path, topic, files=files).select("partition", F.col("end_offset").alias("committed_offset"))

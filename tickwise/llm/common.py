"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.session import ensure_utc, scratch_path

# Word of the decontamination contract after lower-casing A-Z: a run of
# characters that are no ASCII punctuation, white space or control.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back: cuts
    lineage without ``localCheckpoint``, and what reads it twice computes it
    once. Only slim frames (ids, hashes, counts) should be stored."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_number(docs: DataFrame) -> Column:
    """A number of each row of a stored table that is the same in every scan.

    The number counts rows within input splits. Spark cuts a small input by
    the number of cores it sees, which changes when executors come or go, so
    the session is told the count it has now, unless it has one."""
    spark = docs.sparkSession
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return F.monotonically_increasing_id()


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs``, a stored table, without the rows whose ``row_number`` is in
    ``rows(row)``."""
    document = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    numbered = docs.select(document, row_number(docs).alias("row"))
    return numbered.join(rows, "row", "left_anti").select("document.*")


def lower_ascii(text):
    """``text`` with A-Z, and nothing else, in lower case."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def worker_cache(name: str, make: Callable[[], Any]) -> Any:
    """An object kept for the life of the Python worker. UDF code of this
    package travels by value, so a module global would be new in each task."""
    holder = sys.modules.setdefault("_tickwise_worker_cache", types.ModuleType("_tickwise_worker_cache"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)

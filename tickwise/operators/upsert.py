"""Keyed upsert (last write wins) and the target-table contract check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.schemas import OUTPUT_KEYS


def last_write(rows: DataFrame, order: str, keys: Sequence[str] = OUTPUT_KEYS) -> DataFrame:
    """The row with the largest ``order`` per key, without ``order``: one
    partial + final aggregate, so a key with many versions collapses inside
    each input task."""
    values = [c for c in rows.columns if c not in (*keys, order)]
    aggs = [F.max_by(c, order).alias(c) for c in values]
    return rows.groupBy(*keys).agg(*aggs).select(*[c for c in rows.columns if c != order])


def upsert_latest(target: DataFrame, updates: DataFrame, keys: Sequence[str] = OUTPUT_KEYS) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE`` as a DataFrame: the rows of
    both sides, the update's where a key is in both. Each side is read once.
    Both must be unique on ``keys`` (windowed aggregates are).
    """
    old = target.withColumn("_side", F.lit(0))
    new = updates.select(*target.columns).withColumn("_side", F.lit(1))
    return last_write(old.unionByName(new), "_side", list(keys))


def key_violations(df: DataFrame, keys: Sequence[str] = OUTPUT_KEYS, not_null: Sequence[str] = ()) -> DataFrame:
    """Rows breaking ``PRIMARY KEY (keys)`` or ``NOT NULL``: one row per key
    that occurs more than once or has a NULL part, and per key with NULLs in
    the ``not_null`` columns. Empty result = contract holds. One partial +
    final aggregate; a hot key collapses map-side.
    """
    keys = list(keys)
    null_values = F.lit(0).cast("bigint")
    for c in not_null:
        null_values = null_values + F.count_if(F.col(c).isNull())
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), null_values.alias("null_values"))
    return agg.where((F.col("copies") > 1) | null_key | (F.col("null_values") > 0)).select(
        *keys, "copies", null_key.alias("null_key"), "null_values"
    )

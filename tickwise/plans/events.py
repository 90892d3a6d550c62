"""Producer side for the driver's ``events`` table: each event becomes one
tick message on a topic, exactly as the quote bridge publishes them.

Mapping: ``event_type -> id``, ``ts -> time`` (epoch ms), ``value -> price``,
``user_id % partitions -> partition``, ``event_id -> offset``.

Delivery faults can be injected so that the consumer's validation and
de-duplication have real work: every ``replay_every``-th event is delivered
twice (the copy lands right after its original, in the next offset slot),
and every ``corrupt_every``-th message is cut in half (not parseable). Both
rules are deterministic so a SQL oracle can mirror them; neither removes
rows. Offsets advance by 2 per event so a redelivered copy has a slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.schemas import ENUMS, QUOTE_FIELDS, QUOTE_SCHEMA
from tickwise.sources.topic import DEFAULT_TOPIC

# Fixed fault-injection parameters shared by the registered queries and their
# SQL oracles.
REPLAY_EVERY = 10
CORRUPT_EVERY = 7
TOPIC_PARTITIONS = 3
OFFSET_STRIDE = 2


def epoch_millis(df: DataFrame, col: str) -> Column:
    """Epoch milliseconds of a timestamp column, independent of time zone for
    ``TIMESTAMP_NTZ`` input (it is read as UTC wall time)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_millis(F.col(col))


def event_time(df: DataFrame, col: str) -> Column:
    """The column as ``TIMESTAMP`` (an instant), which watermarks require.
    ``TIMESTAMP_NTZ`` is read as UTC wall time (sessions run in UTC)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(col).cast("timestamp")
    return F.col(col)


def tick_payload(id_col: Column, price_col: Column, time_ms_col: Column) -> Column:
    """The tick JSON the bridge publishes: ``{"id":..,"price":..,"time":"<ms>"}``.

    Field names are given as literals (``named_struct``): ``struct`` of
    aliased columns loses the aliases when the same ``select`` also holds a
    generator that Spark extracts before the struct is resolved."""
    return F.to_json(
        F.named_struct(
            F.lit("id"), id_col,
            F.lit("price"), price_col.cast("float"),
            F.lit("time"), time_ms_col.cast("string"),
        )
    )


def events_to_topic(
    events: DataFrame,
    *,
    topic: str = DEFAULT_TOPIC,
    partitions: int = TOPIC_PARTITIONS,
    replay_every: int | None = REPLAY_EVERY,
    corrupt_every: int | None = CORRUPT_EVERY,
) -> DataFrame:
    """Topic records for every event (narrow: one scan, no shuffle)."""
    payload = tick_payload(F.col("event_type"), F.col("value"), epoch_millis(events, "ts"))
    copies = F.array(F.lit(0))
    if replay_every:
        copies = F.when(F.col("event_id") % F.lit(replay_every) == 0,
                        F.array(F.lit(0), F.lit(1))).otherwise(copies)
    staged = events.select(
        "event_id", "user_id",
        event_time(events, "ts").alias("timestamp"),
        payload.alias("_payload"),
        F.explode(copies).alias("_copy"),
    )
    value = F.col("_payload")
    if corrupt_every:
        broken = F.col("event_id") % F.lit(corrupt_every) == 0
        value = F.when(broken, F.expr("substring(_payload, 1, length(_payload) div 2)")).otherwise(value)
    return staged.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("user_id") % F.lit(partitions)).cast("int").alias("partition"),
        (F.col("event_id") * F.lit(OFFSET_STRIDE) + F.col("_copy")).alias("offset"),
        F.col("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def market_hours_code(ts: Column) -> Column:
    """Trading session code of a US listing by UTC time of day (winter
    hours, UTC-5): 09:00-14:30 pre-market (0), 14:30-21:00 regular (1),
    21:00-01:00 post-market (2), 01:00-09:00 overnight/extended (3)."""
    minute = F.hour(ts) * 60 + F.minute(ts)
    return (
        F.when(minute < 60, F.lit(2))
        .when(minute < 9 * 60, F.lit(3))
        .when(minute < 14 * 60 + 30, F.lit(0))
        .when(minute < 21 * 60, F.lit(1))
        .otherwise(F.lit(2))
    )


# All fields of a quote from an event, by one rule per kind (``k`` is the field
# number), with nulls, defaults and integers past 2^53. Plain SQL that both
# engines read alike; the oracles use the same text.
BIG = 9007199254740993


def field_sql(number: int, kind: str) -> str:
    """SQL for a field's value (null where the quote lacks it)."""
    k = number
    if kind == "string":
        return f"case when (event_id + {k}) % 5 = 0 then null when (event_id + {k}) % 7 = 0 then '' else concat(event_type, '-{k}') end"
    if kind == "sint64":
        value = f"(case when event_id % 2 = 0 then 1 else -1 end) * (cast({BIG} as bigint) + event_id * {k})"
        return f"case when (event_id + {k}) % 4 = 0 then null when (event_id + {k}) % 9 = 0 then cast(0 as bigint) else {value} end"
    if kind in ("float", "double"):
        scale = "4" if kind == "float" else "8"
        whole = f"(event_id * {k}) % 1000 - 300" if kind == "float" else f"(event_id * {k}) % 100000 + 1"
        return f"case when (event_id + {k}) % 6 = 0 then null else cast(({whole}) as double) / {scale} end"
    names = [name for _, name in sorted(ENUMS[kind[5:]].items())]
    whens = " ".join(f"when {i} then '{name}'" for i, name in enumerate(names))
    return f"case (event_id + {k}) % {len(names)} {whens} end"


def full_quotes(events: DataFrame) -> DataFrame:
    """``(event_id, quote)`` with all fields of the message."""
    types = {f.name: f.dataType for f in QUOTE_SCHEMA.fields}
    fields = [F.expr(field_sql(number, kind)).cast(types[name]).alias(name) for name, number, kind in QUOTE_FIELDS]
    return events.select("event_id", F.struct(*fields).alias("quote"))

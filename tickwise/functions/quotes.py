"""Quote frames: base64 text holding one protobuf quote message.

The message definition is declared once (``schemas.QUOTE_FIELDS`` and
``schemas.ENUMS``). Spark's ``from_protobuf`` and ``to_protobuf`` do the work
when the spark-protobuf package is on the classpath; otherwise an Arrow UDF
around the protobuf runtime (``functions.wire``), only the fields asked for.
Both return NULL for frames that are not valid base64 or not a valid message.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.functions.wire import FULL_NAME, decode, descriptor_set, encode
from tickwise.schemas import ENUMS, QUOTE_FIELDS, QUOTE_SCHEMA


def descriptor_set_bytes() -> bytes:
    """Serialized ``FileDescriptorSet`` of the quote message, as
    ``from_protobuf`` takes it."""
    return descriptor_set(QUOTE_FIELDS, ENUMS)


def builtin_protobuf_available(spark) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.protobuf.ProtobufDataToCatalyst")
        return True
    except Exception:
        return False


# ---------------------------------------------------------------------------
# decode
# ---------------------------------------------------------------------------
def frame_bytes(frame: Column) -> Column:
    """base64 text -> bytes; NULL (not an error) for text that is not base64."""
    return F.try_to_binary(frame, F.lit("base64"))


def decode_quotes(
    frames: DataFrame, *, frame_col: str = "frame", fields: Sequence[str] | None = None, builtin: bool | None = None
) -> DataFrame:
    """Add ``quote`` (a struct of ``fields``, by default all 33; enums as
    names) decoded from ``frame_col`` (base64 text). Invalid frames give a
    NULL quote. Fields holding the proto3 default are NULL."""
    spark = frames.sparkSession
    raw = frame_bytes(F.col(frame_col))
    wanted = [f for f in QUOTE_FIELDS if fields is None or f[0] in fields]
    use_builtin = builtin_protobuf_available(spark) if builtin is None else builtin
    if use_builtin:
        from pyspark.sql.protobuf.functions import from_protobuf

        quote = from_protobuf(
            raw, FULL_NAME, binaryDescriptorSet=descriptor_set_bytes(),
            options={"mode": "PERMISSIVE", "enums.as.ints": "false"},
        )
        picked = F.struct(*[quote[name].alias(name) for name, _, _ in wanted])
        return frames.withColumn("quote", F.when(quote.isNotNull(), picked))
    schema = T.StructType([f for f in QUOTE_SCHEMA.fields if f.name in {name for name, _, _ in wanted}])

    @F.arrow_udf(schema)
    def quotes_of(payload: pa.Array) -> pa.Array:
        return decode(payload, wanted, ENUMS)

    return frames.withColumn("quote", quotes_of(raw))


# ---------------------------------------------------------------------------
# encode (producer side)
# ---------------------------------------------------------------------------
def encode_frames(quotes: Column, *, builtin: bool | None = None) -> Column:
    """Quote struct (any subset of the 33 fields, enums as names) -> base64
    frame; NULL for a NULL struct."""
    if builtin_protobuf_available(SparkSession.active()) if builtin is None else builtin:
        from pyspark.sql.protobuf.functions import to_protobuf

        message = to_protobuf(quotes, FULL_NAME, binaryDescriptorSet=descriptor_set_bytes())
    else:

        @F.arrow_udf(T.BinaryType())
        def message_of(rows: pa.Array) -> pa.Array:
            return encode(rows, QUOTE_FIELDS, ENUMS)

        message = message_of(quotes)
    # a frame is one line of text, however long
    return F.translate(F.base64(message), "\r\n", "")


# ---------------------------------------------------------------------------
# JSON (proto3 JSON mapping: camelCase keys, 64-bit ints as strings, enums as
# names, fields holding the default value are left out)
# ---------------------------------------------------------------------------
def _json_name(name: str) -> str:
    parts = name.split("_")
    return parts[0] + "".join(p[:1].upper() + p[1:] for p in parts[1:])


def quote_json(quote: Column, fields: list[str] | None = None) -> Column:
    """Quote struct -> JSON text as the bridge publishes it."""
    kinds = {n: k for n, _num, k in QUOTE_FIELDS}
    chosen = fields or [n for n, _num, _k in QUOTE_FIELDS]
    parts = []
    for n in chosen:
        c = quote[n]
        k = kinds[n]
        if k == "string":
            v = F.nullif(c, F.lit(""))
        elif k == "sint64":
            v = F.nullif(c, F.lit(0).cast("bigint")).cast("string")
        elif k.startswith("enum:"):
            default = ENUMS[k[5:]][0] if 0 in ENUMS[k[5:]] else None
            v = F.nullif(c, F.lit(default)) if default else c
        else:
            v = F.nullif(c, F.lit(0).cast(T.FloatType() if k == "float" else T.DoubleType()))
        parts.append(v.alias(_json_name(n)))
    return F.to_json(F.struct(*parts))


def enum_name(code: Column, enum: str) -> Column:
    """Enum code -> name through a literal map (no join, no UDF)."""
    values = ENUMS[enum]
    pairs = []
    for c, n in sorted(values.items()):
        pairs += [F.lit(c), F.lit(n)]
    return F.create_map(*pairs)[code]

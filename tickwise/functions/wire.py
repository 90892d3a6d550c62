"""Protobuf messages on Arrow batches, by the protobuf runtime.

Stands in for Spark's ``from_protobuf`` and ``to_protobuf`` where the
spark-protobuf package is not on the classpath. ``fields`` is a list of
``(name, number, kind)`` with kinds ``string``, ``float``, ``double``,
``sint64`` and ``enum:<name>``; fields that are not listed are stepped over.
As in proto3, a field that holds its default (zero, empty) is absent: null in
the decoded row, left out when encoded.
"""

from __future__ import annotations

import pyarrow as pa

PACKAGE = "quotes"
MESSAGE = "PricingData"
FULL_NAME = f"{PACKAGE}.{MESSAGE}"
ARROW = {"string": pa.string(), "float": pa.float32(), "double": pa.float64(), "sint64": pa.int64()}

Fields = list[tuple[str, int, str]]
Enums = dict[str, dict[int, str]]


def descriptor_set(fields: Fields, enums: Enums) -> bytes:
    """Serialized ``FileDescriptorSet`` of a message of ``fields``."""
    from google.protobuf.descriptor_pb2 import FieldDescriptorProto, FileDescriptorProto, FileDescriptorSet

    file = FileDescriptorProto(name="quotes.proto", package=PACKAGE, syntax="proto3")
    message = file.message_type.add(name=MESSAGE)
    for enum_name, values in enums.items():
        enum = message.enum_type.add(name=enum_name)
        for code, name in sorted(values.items()):
            enum.value.add(name=name, number=code)
    for name, number, kind in fields:
        field = message.field.add(name=name, number=number, label=FieldDescriptorProto.LABEL_OPTIONAL)
        if kind.startswith("enum:"):
            field.type, field.type_name = FieldDescriptorProto.TYPE_ENUM, f".{FULL_NAME}.{kind[5:]}"
        else:
            field.type = FieldDescriptorProto.Type.Value(f"TYPE_{kind.upper()}")
    return FileDescriptorSet(file=[file]).SerializeToString()


def message_class(fields: Fields, enums: Enums) -> type:
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    pool = descriptor_pool.DescriptorPool()
    pool.Add(descriptor_pb2.FileDescriptorSet.FromString(descriptor_set(fields, enums)).file[0])
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(FULL_NAME))


def decode(column: pa.Array, fields: Fields, enums: Enums) -> pa.StructArray:
    """The messages of a binary column as a struct of ``fields`` (enums as
    names, null for a code without one); null where the value is null or no
    message."""
    from google.protobuf.message import DecodeError

    message = message_class(fields, enums)
    names = {name: enums[kind[5:]] for name, _, kind in fields if kind.startswith("enum:")}

    def row(raw: bytes | None) -> dict | None:
        try:
            held = [] if raw is None else message.FromString(raw).ListFields()
        except DecodeError:
            return None
        return None if raw is None else {f.name: names[f.name].get(v) if f.name in names else v for f, v in held}

    return pa.array([row(v) for v in column.to_pylist()], pa.struct([(n, ARROW.get(k, pa.string())) for n, _, k in fields]))


def encode(rows: pa.StructArray, fields: Fields, enums: Enums) -> pa.Array:
    """One message per row; null for a null row. Fields that the struct lacks
    are left out, and so is an enum name without a code."""
    message = message_class(fields, enums)
    codes = {n: {name: code for code, name in enums[k[5:]].items()} for n, _, k in fields if k.startswith("enum:")}
    columns = {}
    for name, _, kind in fields:
        if rows.type.get_field_index(name) >= 0:
            values = rows.field(name).fill_null(0 if kind in ARROW and kind != "string" else "").to_numpy(zero_copy_only=False).tolist()
            columns[name] = [codes[name].get(v, 0) for v in values] if name in codes else values
    made = [message(**dict(zip(columns, v, strict=True))).SerializeToString() for v in zip(*columns.values(), strict=True)]
    return pa.array(made or [b""] * len(rows), pa.binary(), mask=rows.is_null().to_numpy(zero_copy_only=False))

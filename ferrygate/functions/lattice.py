"""The least type that holds two types, and casts to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_BINARY = (FloatType, DoubleType)


def join(a: DataType, b: DataType) -> DataType:
    """Nothing, whole numbers, decimals, doubles, text in this order; lists and structs join part by part, everything else is text."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return LongType()
    numbers = (*_WHOLE, *_BINARY, DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, _BINARY) or isinstance(b, _BINARY):
            return DoubleType()
        (p, s), (q, t) = (_digits(x) for x in (a, b))
        whole, scale = max(p - s, q - t), max(s, t)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(join(a.elementType, b.elementType))
    if isinstance(a, StructType) and isinstance(b, StructType):
        return join_structs(a, b)
    return StringType()


def _digits(kind: DataType) -> tuple[int, int]:
    return (kind.precision, kind.scale) if isinstance(kind, DecimalType) else (19, 0)


def join_structs(a: StructType, b: StructType) -> StructType:
    """All fields of both, in the order in which they come."""
    types = {f.name: f.dataType for f in a.fields}
    for field in b.fields:
        types[field.name] = join(types[field.name], field.dataType) if field.name in types else field.dataType
    return StructType([StructField(name, kind) for name, kind in types.items()])


def cast_to(column: Column, kind: DataType, wanted: DataType) -> Column:
    """``column`` of type ``kind`` as ``wanted``, which holds it; what becomes text from a list or struct is its JSON."""
    if kind == wanted:
        return column
    if isinstance(kind, NullType):
        return F.lit(None).cast(wanted)
    if isinstance(wanted, StringType) and isinstance(kind, (ArrayType, StructType, MapType)):
        return F.to_json(column)
    if isinstance(kind, ArrayType):
        return F.transform(column, lambda item: cast_to(item, kind.elementType, wanted.elementType))
    if isinstance(kind, StructType):
        types = {f.name: f.dataType for f in kind.fields}
        fields = [
            (cast_to(column.getField(f.name), types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column.cast(wanted)

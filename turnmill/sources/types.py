"""Bringing columns of one name and different types to one type.

What two types share without loss is a plain type: the wider number, text for a scalar and text, a
timestamp for a date. Anything else becomes VARIANT, in which each value keeps its own shape: a list, an
object, or JSON text that is read as the document it holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from turnmill.functions import messages as ms

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONS = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_SCALARS = (*_INTEGERS, *_FRACTIONS, *_TIMES, T.DecimalType, T.StringType, T.BooleanType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    both = lambda kinds: isinstance(a, kinds) and isinstance(b, kinds)
    if both(_INTEGERS):
        return T.LongType()
    if both((*_INTEGERS, *_FRACTIONS)):
        return T.DoubleType()
    if both(T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if both(_TIMES):
        return T.TimestampType()
    # A long number, a date or a flag would lose as another kind of number; as text none does.
    return T.StringType() if both(_SCALARS) else T.VariantType()


def _as_variant(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.VariantType):
        return value
    if isinstance(kind, T.StringType):
        # Text that is no JSON, or too deep, is itself the value.
        return F.coalesce(ms.parse_messages(value), value.cast("variant"))
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_variant_object(value)
    return value.cast("variant")


def as_type(value: Column, kind: T.DataType, target: T.DataType) -> Column:
    if kind == target:
        return value
    return _as_variant(value, kind) if isinstance(target, T.VariantType) else value.cast(target)


def reconciled(tables: list[DataFrame]) -> list[DataFrame]:
    """The tables with each column in a type that all of them share. Names compare without case."""
    kinds: dict[str, list[T.DataType]] = {}
    for table in tables:
        for field in table.schema:
            kinds.setdefault(field.name.lower(), []).append(field.dataType)
    target = {name: reduce(common_type, found) for name, found in kinds.items()}
    made = []
    for table in tables:
        made.append(
            table.select(
                *[
                    as_type(table[f"`{f.name}`"], f.dataType, target[f.name.lower()]).alias(f.name)
                    for f in table.schema
                ]
            )
        )
    return made

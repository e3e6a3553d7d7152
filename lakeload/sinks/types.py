"""Which type holds the values of two types, so that a column may widen from run to run.

Only widenings that keep every value are made: whole numbers by size, float to double, whole numbers up to int to
double, decimals by their digits on both sides of the point. Anything else is two types and no column.
"""

from __future__ import annotations

from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Digits before the point that a whole number of the type may have, as the Parquet reader counts them.
_DIGITS = {T.ByteType: 10, T.ShortType: 10, T.IntegerType: 10, T.LongType: 20}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The smallest type that holds all values of both, or None if there is none."""
    if a.simpleString() == b.simpleString():
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _structs(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = wider(a.elementType, b.elementType)
        return T.ArrayType(inner) if inner else None
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        inner = wider(a.valueType, b.valueType)
        return T.MapType(a.keyType, inner) if inner else None
    return _numbers(a, b)


def _structs(a: T.StructType, b: T.StructType) -> T.StructType | None:
    if a.fieldNames() != b.fieldNames():
        return None
    inner = [wider(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields)]
    return None if None in inner else T.StructType([T.StructField(n, t) for n, t in zip(a.fieldNames(), inner)])


def _numbers(a: T.DataType, b: T.DataType) -> T.DataType | None:
    whole = [t for t in (a, b) if isinstance(t, _WHOLE)]
    if len(whole) == 2:
        return max(whole, key=lambda t: _WHOLE.index(type(t)))
    if any(isinstance(t, T.DecimalType) for t in (a, b)):
        return _decimals(a, b)
    if all(isinstance(t, (T.FloatType, T.DoubleType)) or t in whole for t in (a, b)):
        return None if T.LongType() in whole else T.DoubleType()
    return None


def _decimals(a: T.DataType, b: T.DataType) -> T.DecimalType | None:
    sides = []
    for t in (a, b):
        if isinstance(t, T.DecimalType):
            sides.append((t.precision - t.scale, t.scale))
        elif type(t) in _DIGITS:
            sides.append((_DIGITS[type(t)], 0))
        else:
            return None
    before, after = (max(part) for part in zip(*sides))
    return T.DecimalType(before + after, after) if before + after <= 38 else None

"""Which column types a stored table can take on without being rewritten."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed value: digits of the longest decimal.
MOST_DIGITS = 38
# Whole numbers by width, with the decimal digits they may need.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


class TypeConflict(ValueError):
    """A column has a type that the stored one cannot be read as, nor the other way round."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that files of either type can be read as; None when there is none.

    Only what the Parquet reader widens by itself counts, so that files written earlier stay as they are.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = (type(a), type(b))
    if all(k in WHOLE for k in kinds):
        return a if WHOLE[kinds[0]] >= WHOLE[kinds[1]] else b
    if T.DoubleType in kinds and all(k in (T.DoubleType, T.FloatType, T.ByteType, T.ShortType, T.IntegerType) for k in kinds):
        return T.DoubleType()
    if T.DecimalType in kinds and all(k is T.DecimalType or k in WHOLE for k in kinds):
        (whole_a, scale_a), (whole_b, scale_b) = _digits(a), _digits(b)
        whole, scale = max(whole_a, whole_b), max(scale_a, scale_b)
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else None
    if set(kinds) == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def _digits(kind: T.DataType) -> tuple[int, int]:
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else (WHOLE[type(kind)], 0)


def evolved(stored: T.StructType | None, batch: T.StructType, fixed: tuple[str, ...] = ()) -> T.StructType:
    """The stored columns, widened where the batch needs it, then the batch's new ones.

    ``fixed`` columns keep the type they have. Names are compared without case, the stored spelling stays.
    """
    if stored is None:
        return T.StructType([T.StructField(f.name, f.dataType) for f in batch.fields])
    given = {f.name.lower(): f for f in batch.fields}
    fields = []
    for field in stored.fields:
        other = given.pop(field.name.lower(), None)
        kind = field.dataType
        if other is not None and field.name not in fixed:
            kind = wider(field.dataType, other.dataType)
            if kind is None:
                raise TypeConflict(f"Column {field.name} is {other.dataType.simpleString()}, the stored one {field.dataType.simpleString()}")
        fields.append(T.StructField(field.name, kind))
    fields += [T.StructField(f.name, f.dataType) for f in batch.fields if f.name.lower() in given]
    return T.StructType(fields)

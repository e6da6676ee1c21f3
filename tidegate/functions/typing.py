"""Type tokens and casts that never fail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Configuration token -> Spark type.
TYPE_TOKENS = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}
DEFAULT_PRECISION, DEFAULT_SCALE = 38, 18

# Text Spark reads as a number or a boolean. Surrounding control characters are allowed.
BLANK = r"[\x00-\x20\x7f]*"
INTEGER_TEXT = rf"^{BLANK}[+-]?[0-9]+{BLANK}$"
PLAIN_NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?$"
NUMBER_TEXT = rf"^{BLANK}[+-]?(\.?\p{{Nd}}[\p{{Nd}}a-fA-FpPxX.+-]*|(?i:inf(inity)?|nan)){BLANK}$"
BOOLEAN_TEXT = ("t", "true", "y", "yes", "1", "f", "false", "n", "no", "0")


def spark_type(token: str | None, precision: int | None = None, scale: int | None = None) -> T.DataType:
    word = (token or "").strip().upper()
    if word == "DECIMAL":
        return T.DecimalType(
            DEFAULT_PRECISION if precision is None else precision, DEFAULT_SCALE if scale is None else scale
        )
    return TYPE_TOKENS.get(word, T.StringType())


def is_temporal(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DateType, T.TimestampType))


def decimal_point(col: Column) -> Column:
    """Decimal comma to point."""
    return F.translate(col, ",", ".")


def castable(col: Column, data_type: T.DataType) -> Column | None:
    """Whether text looks like a value of the type; may let bad text through, never stops good text.

    A failed cast costs an exception inside the JVM, several hundred times the price of this test.
    """
    if isinstance(data_type, T.IntegralType):
        return col.rlike(INTEGER_TEXT)
    if isinstance(data_type, T.NumericType):
        # The short pattern settles nearly all numbers at a fraction of the cost.
        return col.rlike(PLAIN_NUMBER) | col.rlike(NUMBER_TEXT)
    if isinstance(data_type, T.BooleanType):
        return F.lower(F.trim(col)).isin(*BOOLEAN_TEXT)
    return None


def safe_cast(col: Column, data_type: T.DataType) -> Column:
    """Typed value, or NULL when the text does not represent one."""
    if isinstance(data_type, T.StringType):
        return col
    text = decimal_point(col) if isinstance(data_type, T.NumericType) else col
    likely = castable(text, data_type)
    value = text.try_cast(data_type)
    return value if likely is None else F.when(likely, value)

"""Typed single values for metadata: emptiness tests, first value, numeric narrowing, ISO times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The ranges of the two integer types.
INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = (T.FloatType, T.DoubleType)


def is_empty_string(col: Column) -> Column:
    """NULL or ''. A blank such as ' ' is not empty."""
    return col.isNull() | (col == "")


def is_empty_array(col: Column) -> Column:
    """NULL or an array without elements."""
    return F.coalesce(F.size(col), F.lit(0)) <= 0


# The part of an item that holds the values of each type of metadata field.
_VALUE_PARTS = {"integer": "numbers", "long": "numbers", "double": "numbers", "temporal": "times"}


def first_value(col: Column, dtype: T.DataType, field_type: str = "string") -> tuple[Column, T.DataType]:
    """The first element of a multi-value (NULL when it has none) and its type.

    An item with values of several types gives those that the field can have.
    """
    if isinstance(dtype, T.StructType):
        parts = {name.lower(): name for name in dtype.names}
        if "vals" in parts:
            wanted = parts.get(_VALUE_PARTS.get(field_type, "vals"), parts["vals"])
            return first_value(col[wanted], dtype[wanted].dataType)
    if isinstance(dtype, T.ArrayType):
        return F.get(col, F.lit(0)), dtype.elementType
    return col, dtype


def item_first_text(col: Column, dtype: T.StructType) -> Column:
    """The first value of an item as text, whatever its type."""
    parts = {name.lower(): name for name in dtype.names}
    texts = [F.get(col[parts["vals"]], F.lit(0)).cast("string")]
    for part in ("numbers", "times"):
        if part in parts:
            inner = dtype[parts[part]].dataType.elementType
            value = F.get(col[parts[part]], F.lit(0))
            texts.append(to_iso(value, inner) if part == "times" else value.cast("string"))
    return F.coalesce(*texts)


def _nothing(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def _truncated(value: Column, low: int, high: int, sql_type: str) -> Column:
    """A double without its fraction, held at the ends of the range; NaN becomes 0."""
    return (
        F.when(F.isnan(value), F.lit(0).cast(sql_type))
        .when(value >= float(high), F.lit(high).cast(sql_type))
        .when(value <= float(low), F.lit(low).cast(sql_type))
        .otherwise(value.cast(sql_type))
    )


def _decimal_to_long(col: Column) -> Column:
    overflow = F.when(col > 0, F.lit(LONG_MAX).cast("bigint")).when(col < 0, F.lit(LONG_MIN).cast("bigint"))
    return F.coalesce(col.try_cast("bigint"), overflow)


def to_string(col: Column, dtype: T.DataType) -> Column:
    return col.cast("string")


def to_integer(col: Column, dtype: T.DataType) -> Column:
    """Whole numbers wrap to 32 bits, fractions truncate and saturate, anything else is absent."""
    if isinstance(dtype, T.LongType):
        return F.shiftright(F.shiftleft(col, 32), 32).cast("int")
    if isinstance(dtype, _WHOLE):
        return col.cast("int")
    if isinstance(dtype, _FRACTION):
        return _truncated(col.cast("double"), INT_MIN, INT_MAX, "int")
    if isinstance(dtype, T.DecimalType):
        whole = _decimal_to_long(col)
        return F.when(whole > INT_MAX, F.lit(INT_MAX)).when(whole < INT_MIN, F.lit(INT_MIN)).otherwise(whole.cast("int"))
    return _nothing(T.IntegerType())


def to_long(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, _WHOLE):
        return col.cast("bigint")
    if isinstance(dtype, _FRACTION):
        return _truncated(col.cast("double"), LONG_MIN, LONG_MAX, "bigint")
    if isinstance(dtype, T.DecimalType):
        return _decimal_to_long(col)
    return _nothing(T.LongType())


def to_double(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (*_WHOLE, *_FRACTION, T.DecimalType)):
        return col.cast("double")
    return _nothing(T.DoubleType())


def to_iso(col: Column, dtype: T.DataType, utc_session: bool = False) -> Column:
    """ISO text in UTC with whole seconds, such as 2024-01-31T08:15:00Z; dates stay dates."""
    if isinstance(dtype, T.DateType):
        return col.cast("string")
    if utc_session and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if isinstance(dtype, T.TimestampType):
        # Counting from the epoch gives UTC whatever the session's time zone is.
        epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
        col = F.timestamp_add("MICROSECOND", F.unix_micros(col), epoch)
    elif not isinstance(dtype, T.TimestampNTZType):
        return _nothing(T.StringType())
    seconds = F.substring_index(col.cast("string"), ".", 1)
    return F.concat(F.replace(seconds, F.lit(" "), F.lit("T")), F.lit("Z"))


CONVERTERS = {
    "string": to_string,
    "integer": to_integer,
    "long": to_long,
    "double": to_double,
}


def typed_value(col: Column, dtype: T.DataType, field_type: str, utc_session: bool = False) -> Column:
    """First value of ``col`` as a metadata value of ``field_type``; NULL stands for an absent key.

    The static column type decides, values are never parsed: a string is not an integer. In a session
    whose time zone is UTC times are formatted faster.
    """
    if field_type == "string" and isinstance(dtype, T.StructType) and "vals" in {n.lower() for n in dtype.names}:
        return item_first_text(col, dtype)
    value, value_type = first_value(col, dtype, field_type)
    if field_type == "temporal":
        return to_iso(value, value_type, utc_session)
    return CONVERTERS[field_type](value, value_type)

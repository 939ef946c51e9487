"""Column expressions shared by the operators. Built-in functions only: no UDF."""

from __future__ import annotations

import datetime
import decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MILLIS_PER_DAY = 86_400_000
_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


def quoted(name: str) -> str:
    """A column name in backticks, for names with dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def null_of(dt: T.DataType) -> Column:
    return F.lit(None).cast(dt)


# A value of each plain type; any would do.
_SOME = {
    T.BooleanType: False,
    T.StringType: "",
    T.BinaryType: b"",
    T.ByteType: 0,
    T.ShortType: 0,
    T.IntegerType: 0,
    T.LongType: 0,
    T.FloatType: 0.0,
    T.DoubleType: 0.0,
    T.DateType: datetime.date(1970, 1, 1),
    T.TimestampType: datetime.datetime(1970, 1, 2),
}


def some_value(dt: T.DataType) -> Column | None:
    """A constant of type ``dt`` that Spark knows not to be null; None where there is none."""
    if isinstance(dt, T.StructType):
        parts = [null_of(f.dataType) if f.nullable else some_value(f.dataType) for f in dt.fields]
        if any(p is None for p in parts):
            return None
        return F.struct(*[p.alias(f.name) for p, f in zip(parts, dt.fields)])
    if isinstance(dt, T.ArrayType):
        element = null_of(dt.elementType) if dt.containsNull else some_value(dt.elementType)
        return None if element is None else F.array(element)
    if isinstance(dt, T.MapType):
        key = some_value(dt.keyType)
        value = null_of(dt.valueType) if dt.valueContainsNull else some_value(dt.valueType)
        return None if key is None or value is None else F.create_map(key, value)
    if isinstance(dt, T.DecimalType):
        return F.lit(decimal.Decimal(0).scaleb(-dt.scale)).cast(dt)
    if isinstance(dt, T.TimestampNTZType):
        return F.expr("TIMESTAMP_NTZ '1970-01-02'")
    return F.lit(_SOME[type(dt)]).cast(dt) if type(dt) in _SOME else None


def session_is_utc(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.session.timeZone") in _UTC_NAMES


def date_millis(c: Column) -> Column:
    """Epoch milliseconds of a date at midnight UTC."""
    return F.unix_date(c).cast("bigint") * F.lit(MILLIS_PER_DAY)


def ntz_millis(c: Column, utc_session: bool) -> Column:
    """Epoch milliseconds of a zone-less timestamp, read as UTC and floored.

    The cast to a zoned timestamp takes the session's zone, so it serves in a
    UTC session only (three times faster); elsewhere the parts are added up.
    """
    if utc_session:
        return F.unix_millis(c.cast("timestamp"))
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    within_minute = F.floor(F.extract(F.lit("SECOND"), c) * 1000).cast("bigint")
    return date_millis(c.cast("date")) + seconds.cast("bigint") * F.lit(1000) + within_minute


def decimal_text(c: Column) -> Column:
    """A decimal in plain digits where a cast may give an exponent (outside ANSI mode).

    The exponent is always negative: scales are not.
    """
    text = c.cast("string")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(F.regexp_extract(text, r"([0-9.]+)E", 1), "[.]", "")
    zeros = F.regexp_extract(text, r"E-([0-9]+)$", 1).cast("int") - 1
    plain = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), zeros), digits)
    return F.when(text.contains("E"), plain).otherwise(text)


def null_safe_struct(c: Column, fields: list[Column]) -> Column:
    """A rebuilt struct that stays null where ``c`` is null."""
    return F.when(c.isNotNull(), F.struct(*fields))


def refuse_nulls(values: Column, checked: Column, message: str) -> Column:
    """``checked``, or a run-time error where the array ``values`` holds a null.

    The check is part of the column itself, so that the optimizer cannot drop it
    while the column is in use.
    """
    broken = F.exists(values, lambda v: v.isNull())
    return F.when(broken, F.raise_error(F.lit(message))).otherwise(checked)

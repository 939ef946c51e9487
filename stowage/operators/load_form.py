"""Load form: a frame with every column in the type a table load takes.

====================================  ==================
Spark type                            load form
====================================  ==================
tinyint, smallint, int                int
bigint, float, double                 unchanged
string, binary, boolean               unchanged
decimal (any)                         string, declared scale kept
timestamp, timestamp_ntz, date        bigint, epoch milliseconds at UTC
array, map with string keys, struct   the same around converted parts
anything else                         refused
====================================  ==================

Decimals are written as plain digits. A cast does that under ANSI mode, Spark's default;
outside it, an exponent that the cast gives is written out. The schema is checked on the driver before any job runs. Columns that need no
change are passed on as they are, so a scan below stays pruned and pushed down.
A column without times in it takes one cast under ANSI mode, however deep it is: casts of arrays,
maps and structs are compiled, while ``transform`` runs interpreted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stowage.errors import NamespaceError, NestedArrayError, UnsupportedTypeError
from stowage.functions.columns import (
    column,
    date_millis,
    decimal_text,
    ntz_millis,
    null_safe_struct,
    session_is_utc,
)
from stowage.functions.types import dotted, require_unique_columns

_TO_INT = (T.ByteType, T.ShortType, T.IntegerType)
_TO_LONG = (T.TimestampType, T.TimestampNTZType, T.DateType)
_KEPT = (T.LongType, T.FloatType, T.DoubleType, T.BinaryType, T.BooleanType)


def load_type(dt: T.DataType, path: tuple[str, ...] = ()) -> T.DataType:
    """The outgoing type of ``dt``; raises where there is none."""
    if isinstance(dt, _TO_INT):
        return T.IntegerType()
    if isinstance(dt, _TO_LONG):
        return T.LongType()
    if isinstance(dt, (T.DecimalType, T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(dt, _KEPT) or isinstance(dt, T.StringType):
        return dt
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(load_type(dt.elementType, path), dt.containsNull)
    if isinstance(dt, T.MapType) and isinstance(dt.keyType, T.StringType):
        return T.MapType(dt.keyType, load_type(dt.valueType, path), dt.valueContainsNull)
    if isinstance(dt, T.StructType):
        return T.StructType(
            [
                T.StructField(f.name, load_type(f.dataType, (*path, f.name)), f.nullable)
                for f in dt.fields
            ]
        )
    raise UnsupportedTypeError(
        f"type {dt.simpleString()} at {dotted(path)} has no load form", dotted(path)
    )


def load_schema(schema: T.StructType) -> T.StructType:
    """The schema that :func:`load_form` gives for a frame of ``schema``."""
    return load_type(schema)


@dataclass(frozen=True)
class Session:
    """The settings that decide which expression gives a load form; never what it gives."""

    utc: bool
    ansi: bool

    @classmethod
    def of(cls, spark: SparkSession) -> Session:
        return cls(session_is_utc(spark), spark.conf.get("spark.sql.ansi.enabled") == "true")

    @property
    def beyond_casts(self) -> tuple[type[T.DataType], ...]:
        """Types of which a cast does not give the load form."""
        return _TO_LONG if self.ansi else (*_TO_LONG, T.DecimalType)


def holds(kinds: tuple[type[T.DataType], ...], dt: T.DataType) -> bool:
    if isinstance(dt, T.ArrayType):
        return holds(kinds, dt.elementType)
    if isinstance(dt, T.MapType):
        return holds(kinds, dt.valueType)
    if isinstance(dt, T.StructType):
        return any(holds(kinds, f.dataType) for f in dt.fields)
    return isinstance(dt, kinds)


def load_column(c: Column, dt: T.DataType, session: Session) -> Column:
    """``c`` of type ``dt`` in load form; ``c`` itself where nothing changes."""
    out = load_type(dt)
    if out == dt:
        return c
    if not holds(session.beyond_casts, dt):
        return c.cast(out)
    if isinstance(dt, T.DecimalType):
        return decimal_text(c)
    if isinstance(dt, T.TimestampType):
        return F.unix_millis(c)
    if isinstance(dt, T.TimestampNTZType):
        return ntz_millis(c, session.utc)
    if isinstance(dt, T.DateType):
        return date_millis(c)
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda e: load_column(e, dt.elementType, session))
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda _, v: load_column(v, dt.valueType, session))
    return null_safe_struct(
        c,
        [load_column(c.getField(f.name), f.dataType, session).alias(f.name) for f in dt.fields],
    )


def load_form(df: DataFrame) -> DataFrame:
    """``df`` with every column in load form (see the module table)."""
    require_unique_columns(df.columns)
    if load_schema(df.schema) == df.schema:
        return df
    session = Session.of(df.sparkSession)
    return df.select(
        *[load_column(column(f.name), f.dataType, session).alias(f.name) for f in df.schema.fields]
    )


def refuse_nested_arrays(schema: T.StructType) -> None:
    """A table load takes no array directly inside an array."""

    def walk(dt: T.DataType, path: tuple[str, ...]) -> None:
        if isinstance(dt, T.ArrayType):
            if isinstance(dt.elementType, T.ArrayType):
                raise NestedArrayError(f"array of arrays at {dotted(path)}", dotted(path))
            walk(dt.elementType, path)
        elif isinstance(dt, T.MapType):
            walk(dt.valueType, path)
        elif isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(f.dataType, (*path, f.name))

    walk(schema, ())


def record_namespaces(schema: T.StructType, namespace: str = "") -> dict[str, str]:
    """Namespace of each nested record, keyed by its path.

    A record at field ``f`` gets ``namespace.f``, also as an element of an array
    or a value of a map there. Below a second container level the namespace
    stays that of the level above.
    """
    found: dict[str, str] = {}

    def record(struct: T.StructType, ns: str, path: tuple[str, ...]) -> None:
        for f in struct.fields:
            value(f.dataType, f.name, ns, (*path, f.name))

    def value(dt: T.DataType, name: str, ns: str, path: tuple[str, ...]) -> None:
        depth = 0
        while isinstance(dt, (T.ArrayType, T.MapType)):
            dt = dt.elementType if isinstance(dt, T.ArrayType) else dt.valueType
            depth += 1
        if isinstance(dt, T.StructType):
            inner = ns if depth > 1 else f"{ns}.{name}"
            found[dotted(path)] = inner
            record(dt, inner, path)

    record(schema, namespace, ())
    return found


def require_namespaces(schema: T.StructType, namespace: str) -> None:
    """Refuse nested records whose namespace would start with a dot."""
    for path, ns in record_namespaces(schema, namespace).items():
        if ns.startswith(".") or not ns:
            raise NamespaceError(
                f"nested record at {path} needs a recordNamespace option (it would be '{ns}')",
                path,
            )

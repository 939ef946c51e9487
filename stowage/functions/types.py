"""Helpers on Spark data types. They run on the driver and touch no data."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import types as T

from stowage.errors import DuplicateColumnError


def loosen(dt: T.DataType) -> T.DataType:
    """The same type with every field, element and value nullable."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, loosen(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(loosen(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(loosen(dt.keyType), loosen(dt.valueType), True)
    return dt


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for nullability."""
    return loosen(a) == loosen(b)


def dotted(path: Iterable[str]) -> str:
    return ".".join(path)


def require_unique_columns(names: list[str]) -> None:
    """Refuse names that a table could not tell apart (letter case is ignored)."""
    twice = sorted(n for n, k in Counter(n.lower() for n in names).items() if k > 1)
    if twice:
        raise DuplicateColumnError(
            f"column names used more than once: {', '.join(twice)}; give each an alias"
        )

"""Merge frames whose same-named fields have different types, by the union rule.

For the types that meet in one place (nulls put aside):

* one type: that type;
* exactly {int, bigint}: bigint; exactly {float, double}: double; values widened;
* structs meet field by field, arrays element by element, maps value by value;
* any other mix: a struct ``member0 .. memberN``, in order of first appearance,
  where exactly the member of the value's own type is set. A null value gives a
  null struct.

A field that an input lacks is filled with null. With an explicit ``schema`` the
frames are merged into that schema instead: a mix needs a target struct with as
many fields as there are member types, and each member must conform to its field.
Records of different types are such a mix where the target has a field for each of
them that it conforms to; elsewhere they go field by field, and a record of which the
target keeps no field is an error. Without a schema, ``records="members"`` gives
different records a member struct instead of going field by field.

Which member a row sets depends only on the frame it comes from, so the choice is
made on the driver; the merge is one projection per input and a union, with no
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stowage.errors import SchemaError, SpecError, UnionShapeError
from stowage.functions.columns import column, null_of
from stowage.functions.types import dotted, loosen, require_unique_columns, same_type
from stowage.operators.conform import (
    CastTo,
    Convert,
    array_rule,
    conform_rule,
    has_string_keys,
    map_rule,
    mismatch,
    missing_field,
    struct_rule,
    untouched,
)

# The ways in which unlike records meet.
RECORDS = ("fields", "members")

# The two pairs of types that widen, and what they widen to.
WIDENINGS = [
    ({T.IntegerType(), T.LongType()}, T.LongType()),
    ({T.FloatType(), T.DoubleType()}, T.DoubleType()),
]


def members(types: Sequence[T.DataType]) -> list[T.DataType]:
    """The distinct types in order of first appearance; null is no member."""
    out: list[T.DataType] = []
    for dt in types:
        if not isinstance(dt, T.NullType) and not any(same_type(dt, seen) for seen in out):
            out.append(loosen(dt))
    return out


def widened(types: list[T.DataType]) -> T.DataType | None:
    return next((wide for pair, wide in WIDENINGS if len(types) == 2 and set(types) == pair), None)


def all_are(kind: type[T.DataType], types: Sequence[T.DataType]) -> bool:
    return bool(types) and all(isinstance(t, kind) for t in types)


def field_types(structs: Sequence[T.StructType]) -> dict[str, list[T.DataType]]:
    """The types that meet at each field name, names in order of first appearance."""
    out: dict[str, list[T.DataType]] = {}
    for struct in structs:
        for f in struct.fields:
            out.setdefault(f.name, []).append(f.dataType)
    return out


def merged_type(types: Sequence[T.DataType], apart: bool = False) -> T.DataType:
    """The type that the union rule gives for ``types``; ``apart`` keeps unlike records apart."""
    mem = members(types)
    if not mem:
        return T.NullType()
    if all_are(T.StructType, mem) and not (apart and len(mem) > 1):
        return merged_fields(mem, apart)
    if all_are(T.ArrayType, mem):
        return T.ArrayType(merged_type([t.elementType for t in mem], apart), True)
    if all(has_string_keys(t) for t in mem):
        return T.MapType(mem[0].keyType, merged_type([t.valueType for t in mem], apart), True)
    if len(mem) == 1:
        return mem[0]
    return widened(mem) or T.StructType(
        [T.StructField(f"member{i}", t, True) for i, t in enumerate(mem)]
    )


def merged_fields(structs: Sequence[T.StructType], apart: bool) -> T.StructType:
    """Structs field by field."""
    met = field_types(structs)
    return T.StructType([T.StructField(n, merged_type(ts, apart), True) for n, ts in met.items()])


def merge_rule(
    source: T.DataType,
    peers: Sequence[T.DataType],
    target: T.DataType,
    path: tuple[str, ...] = (),
) -> Convert:
    """How a value of ``source`` becomes one of ``target``, ``peers`` being all types met there."""
    if isinstance(source, T.NullType):
        return lambda _: null_of(target)
    mem = members(peers)
    if all_are(T.StructType, mem) and isinstance(target, T.StructType):
        return record_rule(source, mem, target, path)
    if all_are(T.ArrayType, mem) and isinstance(target, T.ArrayType):
        inner = merge_rule(
            source.elementType, [t.elementType for t in mem], target.elementType, path
        )
        return array_rule(source, target, inner, path)
    if all(has_string_keys(t) for t in [*mem, target]):
        inner = merge_rule(source.valueType, [t.valueType for t in mem], target.valueType, path)
        return map_rule(source, target, inner, path)
    if len(mem) == 1:
        return conform_rule(source, target, path)
    if widened(mem) == target:
        return untouched if same_type(source, target) else CastTo(target)
    return member_rule(source, mem, target, path)


def record_rule(
    source: T.StructType, mem: list[T.StructType], target: T.StructType, path: tuple[str, ...]
) -> Convert:
    """As a member, where the target has a field for each record type; else field by field."""
    if len(mem) > 1 and len(target.fields) == len(mem):
        try:
            return member_rule(source, mem, target, path)
        except SchemaError:
            pass  # the fields do not stand for the members
    require_kept(source, target, path)
    return struct_rule(source.names, merge_fields(source, mem, target, path))


def require_kept(source: T.DataType, target: T.DataType, path: tuple[str, ...]) -> None:
    """Refuse a target record that would keep no field of the source record."""
    both = isinstance(source, T.StructType) and isinstance(target, T.StructType)
    if both and source.names and not set(source.names) & set(target.names):
        raise UnionShapeError(
            f"at {dotted(path)}: {target.simpleString()} keeps no field of {source.simpleString()}",
            dotted(path),
        )


def member_rule(
    source: T.DataType, mem: list[T.DataType], target: T.DataType, path: tuple[str, ...]
) -> Convert:
    """Set the one field of the target struct that stands for the source's type."""
    if not isinstance(target, T.StructType):
        raise mismatch("|".join(t.simpleString() for t in mem), target, path)
    if len(target.fields) != len(mem):
        raise UnionShapeError(
            f"at {dotted(path)}: {len(mem)} member types "
            f"but {len(target.fields)} fields in {target.simpleString()}",
            dotted(path),
        )
    own = next(i for i, t in enumerate(mem) if same_type(t, source))
    require_kept(source, target.fields[own].dataType, (*path, target.fields[own].name))
    rules = [
        conform_rule(source if i == own else t, f.dataType, (*path, f.name))
        for i, (t, f) in enumerate(zip(mem, target.fields))
    ]

    def build(c: Column) -> Column:
        fields = [
            (rules[i](c) if i == own else null_of(f.dataType)).alias(f.name)
            for i, f in enumerate(target.fields)
        ]
        return F.when(c.isNotNull(), F.struct(*fields))

    return build


def merge_fields(
    source: T.StructType,
    peers: Sequence[T.StructType],
    target: T.StructType,
    path: tuple[str, ...] = (),
) -> list[tuple[str, Convert]]:
    """The rule of each target field, in target order."""
    own = {f.name: f.dataType for f in source.fields}
    met = field_types(peers)
    return [
        (
            f.name,
            merge_rule(own[f.name], met[f.name], f.dataType, (*path, f.name))
            if f.name in own
            else missing_field(f, path),
        )
        for f in target.fields
    ]


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union of many frames, paired up so that the plan stays shallow."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def merge_union(
    frames: Sequence[DataFrame], schema: T.StructType | None = None, records: str = "fields"
) -> DataFrame:
    """One frame of all rows of ``frames``, types merged by the union rule.

    ``records``: how unlike records meet where there is no ``schema``, ``fields`` (one
    record of all fields) or ``members`` (a member struct).
    """
    if not frames:
        raise ValueError("merge_union needs at least one frame")
    if records not in RECORDS:
        raise SpecError(f"records must be one of {', '.join(RECORDS)}; got {records!r}")
    for df in frames:
        require_unique_columns(df.columns)
    schemas = [df.schema for df in frames]
    target = schema or merged_fields(schemas, records == "members")
    require_unique_columns(target.names)
    return union_all(
        [
            df.select(
                *[
                    rule(column(name)).alias(name)
                    for name, rule in merge_fields(df.schema, schemas, target)
                ]
            )
            for df in frames
        ]
    )

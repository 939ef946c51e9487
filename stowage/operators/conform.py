"""Conform: bring a frame to a target schema by field name, without casts.

* Fields come out in target order, found by name; other source fields are dropped.
* A missing nullable field becomes null, a missing required one is an error.
* Types must be equal; every other pair is an error that names the path.
* A null array element or map value where the target forbids it is a run-time
  error. Null arrays, maps and structs stay null; null record fields are not checked,
  unless ``strict`` asks for it.
* The frame's own schema says what was checked: arrays and maps have the target's null
  rules, and so have fields that the source has as required. With ``strict`` its
  schema is the target.

All schema errors are raised on the driver before any row is read. Parts that
need neither a rebuild nor a null check are passed on untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stowage.errors import MissingFieldError, TypeMismatchError, UnsupportedTypeError
from stowage.functions.columns import column, null_of, null_safe_struct, refuse_nulls, some_value
from stowage.functions.types import dotted, require_unique_columns, same_type

Convert = Callable[[Column], Column]


def untouched(c: Column) -> Column:
    return c


def mismatch(source: str, target: T.DataType, path: tuple[str, ...]) -> TypeMismatchError:
    return TypeMismatchError(
        f"at {dotted(path) or 'the top'}: source is {source}, "
        f"target is {target.simpleString()}",
        dotted(path),
    )


def missing_field(field: T.StructField, path: tuple[str, ...]) -> Convert:
    """The rule for a target field that the source lacks."""
    if not field.nullable:
        raise MissingFieldError(
            f"required field {field.name} is missing at {dotted(path) or 'the top'}",
            dotted((*path, field.name)),
        )
    return lambda _: null_of(field.dataType)


@dataclass(frozen=True)
class CastTo:
    """A conversion by cast; around it, arrays and maps are cast as a whole (compiled)."""

    target: T.DataType

    def __call__(self, c: Column) -> Column:
        return c.cast(self.target)


@dataclass(frozen=True)
class Required:
    """The rule of a field that must not be null; Spark learns that it is not."""

    rule: Convert
    target: T.DataType
    path: tuple[str, ...]
    known: bool  # the source has it as required too

    def __call__(self, c: Column) -> Column:
        refused = F.raise_error(F.lit(f"null in required field at path {dotted(self.path)}"))
        # The last is never reached: it is what makes the whole not nullable.
        return F.coalesce(self.rule(c), refused, some_value(self.target))


def idle(rule: Convert) -> bool:
    """Whether the rule passes a field on as it is, within a record that is passed on as well."""
    return rule is untouched or (isinstance(rule, Required) and rule.known and rule.rule is untouched)


def required_rule(
    rule: Convert, source: T.StructField, target: T.StructField, path: tuple[str, ...], strict: bool
) -> Convert:
    """``rule`` with a null check where the target field is required and the check is asked for,
    or where it is needed to keep what the source says."""
    if target.nullable or (source.nullable and not strict):
        return rule
    if some_value(target.dataType) is not None:
        return Required(rule, target.dataType, path, not source.nullable)
    if strict:
        raise UnsupportedTypeError(
            f"at {dotted(path)}: a field of {target.dataType.simpleString()} cannot be required",
            dotted(path),
        )
    return rule


def array_rule(
    source: T.ArrayType, target: T.ArrayType, element: Convert, path: tuple[str, ...]
) -> Convert:
    """``element`` on each element, with a null check where nulls come in and must not go out."""
    if element is untouched:
        convert = untouched
    elif isinstance(element, CastTo):
        convert = CastTo(T.ArrayType(element.target))
    else:
        convert = lambda c: F.transform(c, element)
    if target.containsNull or convert is untouched and not source.containsNull:
        return convert
    if not source.containsNull:
        return lambda c: F.array_compact(convert(c))
    message = f"null array element at path {dotted(path)}"
    # No null is left to compact; it is how Spark learns that.
    return lambda c: refuse_nulls(c, F.array_compact(convert(c)), message)


def map_rule(
    source: T.MapType, target: T.MapType, value: Convert, path: tuple[str, ...]
) -> Convert:
    """``value`` on each value, with a null check where nulls come in and must not go out."""
    if value is untouched:
        convert = untouched
    elif isinstance(value, CastTo):
        convert = CastTo(T.MapType(source.keyType, value.target))
    else:
        convert = lambda c: F.transform_values(c, lambda _, v: value(v))
    if target.valueContainsNull or convert is untouched and not source.valueContainsNull:
        return convert
    known = lambda m: F.map_from_arrays(F.map_keys(m), F.array_compact(F.map_values(m)))
    if not source.valueContainsNull:
        return lambda c: known(convert(c))
    message = f"null map value at path {dotted(path)}"
    return lambda c: refuse_nulls(F.map_values(c), known(convert(c)), message)


def struct_rule(names: list[str], parts: list[tuple[str, Convert]]) -> Convert:
    """Rebuild a struct with fields ``names`` from its parts, or leave it as it is."""
    if names == [n for n, _ in parts] and all(idle(p) for _, p in parts):
        return untouched
    return lambda c: null_safe_struct(c, [p(c.getField(n)).alias(n) for n, p in parts])


def conform_rule(
    source: T.DataType, target: T.DataType, path: tuple[str, ...] = (), strict: bool = False
) -> Convert:
    """How a value of ``source`` becomes one of ``target``; raises where it cannot."""
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        return struct_rule(source.names, field_rules(source, target, path, strict))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        inner = conform_rule(source.elementType, target.elementType, path, strict)
        return array_rule(source, target, inner, path)
    if has_string_keys(source) and has_string_keys(target):
        inner = conform_rule(source.valueType, target.valueType, path, strict)
        return map_rule(source, target, inner, path)
    if same_type(source, target) and not isinstance(target, T.MapType):
        return untouched
    raise mismatch(source.simpleString(), target, path)


def has_string_keys(dt: T.DataType) -> bool:
    return isinstance(dt, T.MapType) and isinstance(dt.keyType, T.StringType)


def field_rules(
    source: T.StructType, target: T.StructType, path: tuple[str, ...] = (), strict: bool = False
) -> list[tuple[str, Convert]]:
    """The rule of each target field, in target order."""
    own = {f.name: f for f in source.fields}

    def rule(f: T.StructField) -> Convert:
        if f.name not in own:
            return missing_field(f, path)
        at = (*path, f.name)
        inner = conform_rule(own[f.name].dataType, f.dataType, at, strict)
        return required_rule(inner, own[f.name], f, at, strict)

    return [(f.name, rule(f)) for f in target.fields]


def declared(have: T.StructField, want: T.StructField) -> Column:
    """The column under the name and with the null rules of ``want``, where those are looser.

    The optimizer takes null and condition away again, so this costs nothing in a run.
    """
    c = column(have.name)
    if have.dataType != want.dataType:
        c = F.coalesce(c, null_of(want.dataType))
    if want.nullable and not have.nullable:
        c = F.when(column(have.name).isNotNull(), c)
    return c.alias(want.name, metadata=want.metadata) if want.metadata else c.alias(want.name)


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """``df`` as a frame of ``schema`` (rules in the module text).

    ``strict``: a null in a required field is a run-time error too, which names its path.
    """
    require_unique_columns(df.columns)
    require_unique_columns(schema.names)
    rules = field_rules(df.schema, schema, strict=strict)
    out = df.select(*[
        (column(name) if idle(rule) else rule(column(name))).alias(name) for name, rule in rules
    ])
    if out.schema == schema:
        return out
    return out.select(*[declared(h, w) for h, w in zip(out.schema.fields, schema.fields)])

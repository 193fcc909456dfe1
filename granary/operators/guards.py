"""Reading JSON by kind: a value of another kind than asked for is no value, and what a closed schema doesn't know is named.

JSON text is parsed to a VARIANT once; a number is never read as a string, nor a string as a number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def kind(value: Column) -> Column:
    """object, array, string, integer, number, boolean or null for a VARIANT; null where there is no value at all."""
    name = F.schema_of_variant(value)
    return (
        F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").when(name == "STRING", "string").when(name == "BIGINT", "integer")
        .when(name == "BOOLEAN", "boolean").when(name == "VOID", "null").when(name.isNotNull(), "number")
    )


def at(value: Column, field: str) -> Column:
    """A field of an object as a VARIANT."""
    return F.try_variant_get(value, f"$.{field}", "variant")


def fields(value: Column) -> Column:
    """An object's fields by name; null for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def items(value: Column) -> Column:
    """An array's items; null for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def _opened(wanted: T.DataType) -> str:
    """The wanted type with a VARIANT in place of every single value."""
    if isinstance(wanted, T.StructType):
        return f"struct<{', '.join(f'`{f.name}`: {_opened(f.dataType)}' for f in wanted.fields)}>"
    if isinstance(wanted, T.ArrayType):
        return f"array<{_opened(wanted.elementType)}>"
    return f"map<string, {_opened(wanted.valueType)}>" if isinstance(wanted, T.MapType) else "variant"


def _of_kind(value: Column, wanted: T.DataType) -> Column:
    """The opened value with every VARIANT as the wanted type, null if it is of another kind."""
    if isinstance(wanted, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[_of_kind(value[f.name], f.dataType).alias(f.name) for f in wanted.fields]))
    if isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: _of_kind(x, wanted.elementType))
    if isinstance(wanted, T.MapType):
        return F.transform_values(value, lambda k, x: _of_kind(x, wanted.valueType))
    if isinstance(wanted, (T.DoubleType, T.FloatType)):
        allowed = kind(value).isin("number", "integer")
    else:
        allowed = F.schema_of_variant(value) == ("BIGINT" if isinstance(wanted, _WHOLE) else {T.StringType: "STRING", T.BooleanType: "BOOLEAN"}[type(wanted)])
    return F.when(allowed, F.try_variant_get(value, "$", wanted.simpleString()))


def read(value: Column, wanted: T.DataType) -> Column:
    """The VARIANT as the wanted type: fields and items of another kind are null, others aren't affected by them.

    Items keep their number and places. Whole numbers are integers in JSON; 5.0 isn't one, and true is no number. The value is
    opened once, down to its single values; maps have text as keys.
    """
    opened = F.try_variant_get(value, "$", _opened(wanted)) if isinstance(wanted, (T.StructType, T.ArrayType, T.MapType)) else value
    # in an array of one, as Spark would open a struct anew for each of its fields
    return F.transform(F.array(opened), lambda x: _of_kind(x, wanted))[0] if isinstance(wanted, T.StructType) else _of_kind(opened, wanted)


def faults(value: Column, closed: T.DataType, path: Column | str = "$") -> Column:
    """The places, in order, of fields that the closed schema doesn't know, and of values of another kind: an array of strings.

    Null stands for any kind. Below a place that is named nothing is looked at.
    """
    path = F.lit(path) if isinstance(path, str) else path
    none = F.array().cast("array<string>")
    is_kind = lambda *names: F.coalesce(kind(value).isin("null", *names), F.lit(True))
    if isinstance(closed, T.StructType):
        own = [f.name for f in closed.fields]
        unknown = F.transform(F.array_except(F.map_keys(fields(value)), F.array(*[F.lit(k) for k in own])), lambda k: F.concat(path, F.lit("."), k, F.lit(" is unknown")))
        below = [faults(at(value, f.name), f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in closed.fields]
        found = F.when(fields(value).isNotNull(), F.concat(unknown, *below))
        other = F.array(F.concat(path, F.lit(" is no object")))
        return F.coalesce(found, F.when(is_kind("object"), none).otherwise(other))
    if isinstance(closed, T.ArrayType):
        each = F.flatten(F.transform(items(value), lambda x, i: faults(x, closed.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
        return F.coalesce(each, F.when(is_kind("array"), none).otherwise(F.array(F.concat(path, F.lit(" is no array")))))
    if isinstance(closed, T.MapType):
        each = F.flatten(F.transform(F.map_entries(fields(value)), lambda e: faults(e["value"], closed.valueType, F.concat(path, F.lit("."), e["key"]))))
        return F.coalesce(each, F.when(is_kind("object"), none).otherwise(F.array(F.concat(path, F.lit(" is no object")))))
    allowed = {T.StringType: ("string",), T.BooleanType: ("boolean",)}.get(type(closed), ("integer",) if isinstance(closed, _WHOLE) else ("integer", "number"))
    return F.when(is_kind(*allowed), none).otherwise(F.array(F.concat(path, F.lit(" is of another kind"))))

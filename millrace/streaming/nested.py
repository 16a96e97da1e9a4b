"""Rescued data at any depth: what a nested schema does not have, or what does not fit it, by path.

Lines are parsed to VARIANT values once and compared with the schema while the query is built, so
everything stays in Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

RESCUED = "_rescued_data"


def is_nested(schema: T.StructType) -> bool:
    return any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in schema)


def extended(kept: T.DataType, found: T.DataType) -> T.DataType:
    """``kept`` with the struct fields that only ``found`` has, at any depth; other types stay as they are."""
    if isinstance(kept, T.StructType) and isinstance(found, T.StructType):
        new = {f.name: f.dataType for f in found}
        fields = [T.StructField(f.name, extended(f.dataType, new.get(f.name, f.dataType)), True) for f in kept]
        return T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in found if f.name not in kept.names]])
    if isinstance(kept, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(extended(kept.elementType, found.elementType))
    return kept


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, the value computed once."""
    return F.transform(F.array(value), body)[0]


def _object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _present(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


def _packed(m: Column) -> Column:
    """A map of variants as one variant, without empty values; null if nothing is in it."""
    return _bound(F.map_filter(m, lambda _, x: _present(x)), lambda f: F.when(F.size(f) > 0, F.try_parse_json(F.to_json(f))))


def _fields(kind: T.StructType, value_of: Callable[[T.StructField], Column]) -> Column:
    """A map of the schema's fields to variants."""
    if not kind.fields:
        return F.create_map().cast("map<string,variant>")
    return F.map_from_arrays(F.array(*[F.lit(f.name) for f in kind]), F.array(*[value_of(f) for f in kind]))


def _unknown(m: Column, kind: T.StructType) -> Column:
    if not kind.fields:
        return m
    return F.map_filter(m, lambda k, _: ~F.array_contains(F.array(*[F.lit(n) for n in kind.names]), k))


def _numbered(a: Column, body: Callable[[Column], Column]) -> Column:
    """A map of the places of a list, from \"0\", to ``body`` of what is there."""
    return F.map_from_entries(F.transform(a, lambda x, i: F.struct(i.cast("string"), body(x))))


def typed(v: Column, kind: T.DataType) -> Column:
    """A variant as a value of the type; null where it does not fit. Whole numbers take no fractions."""
    if isinstance(kind, T.StructType):
        return _bound(_object(v), lambda m: F.when(
            m.isNotNull(), F.struct(*[typed(m[f.name], f.dataType).alias(f.name) for f in kind])))
    if isinstance(kind, T.ArrayType):
        return F.transform(_list(v), lambda x: typed(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(_object(v), lambda _, x: typed(x, kind.valueType))
    value = F.try_variant_get(v, "$", kind.simpleString())
    if isinstance(kind, T.IntegralType):
        return F.when(F.try_variant_get(v, "$", "decimal(38,9)") == value, value)
    return value


def left_over(v: Column, kind: T.DataType) -> Column:
    """What of a variant a value of the type does not hold, as a variant; null if nothing.

    Of a struct, an object of the fields concerned; of a list, an object of the places concerned.
    """
    if isinstance(kind, T.StructType):
        found = _bound(_object(v), lambda m: F.when(m.isNull(), v).otherwise(_packed(
            F.map_concat(_unknown(m, kind), _fields(kind, lambda f: left_over(m[f.name], f.dataType))))))
    elif isinstance(kind, T.ArrayType):
        found = _bound(_list(v), lambda a: F.when(a.isNull(), v).otherwise(
            _packed(_numbered(a, lambda x: left_over(x, kind.elementType)))))
    elif isinstance(kind, T.MapType):
        found = _bound(_object(v), lambda m: F.when(m.isNull(), v).otherwise(
            _packed(F.transform_values(m, lambda _, x: left_over(x, kind.valueType)))))
    else:
        found = F.when(typed(v, kind).isNull(), v)
    return F.when(_present(v), found)


def rescue_nested(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """From JSON text lines (column ``value``): typed fields, and what they do not hold in ``_rescued_data``.

    ``_rescued_data`` is an object with the unknown fields, and the values that do not fit, at their
    places (list elements by number); lines that are no JSON object, or that name a field twice, are kept as text.
    """
    parsed = raw.select("value", F.try_parse_json("value").alias("v"))
    rows = parsed.select("value", "v", _object(F.col("v")).isNotNull().alias("sound"), typed(F.col("v"), schema).alias("r"))
    return rows.select(
        *[F.col("r")[f.name].alias(f.name) for f in schema],
        F.when(~F.col("sound"), F.col("value")).otherwise(F.to_json(left_over(F.col("v"), schema))).alias(RESCUED))


def _merged(value: Column, left: Column, kind: T.DataType) -> Column:
    """A value with what was left over from it filled in, where the type has a place for it by now."""
    if isinstance(kind, T.StructType):
        return _bound(_object(left), lambda m: F.when(value.isNull() & m.isNull(), F.lit(None)).otherwise(
            F.struct(*[_merged(value[f.name], m[f.name], f.dataType).alias(f.name) for f in kind])))
    if isinstance(kind, T.ArrayType):
        filled = _bound(_object(left), lambda m: F.when(m.isNull(), value).otherwise(
            F.transform(value, lambda x, i: _merged(x, m[i.cast("string")], kind.elementType))))
        return F.when(value.isNull(), typed(left, kind)).otherwise(filled)
    return F.coalesce(value, typed(left, kind))


def _remaining(value: Column, left: Column, kind: T.DataType) -> Column:
    """What is still left over after ``_merged``."""
    if isinstance(kind, T.StructType):
        found = _bound(_object(left), lambda m: F.when(m.isNull(), left).otherwise(_packed(F.map_concat(
            _unknown(m, kind), _fields(kind, lambda f: _remaining(value[f.name], m[f.name], f.dataType))))))
    elif isinstance(kind, T.ArrayType):
        places = _bound(_object(left), lambda m: F.when(m.isNull(), left).otherwise(_packed(F.map_from_entries(F.transform(
            F.map_entries(m), lambda e: F.struct(e["key"], _remaining(
                F.get(value, e["key"].try_cast("int")), e["value"], kind.elementType)))))))
        found = F.when(value.isNull(), left_over(left, kind)).otherwise(places)
    else:
        found = F.when(value.isNull(), left_over(left, kind)).otherwise(left)
    return F.when(_present(left), found)


def promote_nested(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give rescued values to the fields that the schema has by now, at any depth.

    What is given to a field leaves ``_rescued_data``; the rest stays. A place that already has a value keeps it.
    """
    whole = F.struct(*[F.col(f"`{f.name}`") for f in schema])
    rows = df.select(whole.alias("r"), RESCUED, F.try_parse_json(RESCUED).alias("v"))
    rows = rows.withColumn("sound", _object(F.col("v")).isNotNull())
    merged = F.when(F.col("sound"), _merged(F.col("r"), F.col("v"), schema)).otherwise(F.col("r"))
    left = F.when(F.col("sound"), F.to_json(_remaining(F.col("r"), F.col("v"), schema))).otherwise(F.col(RESCUED))
    return rows.select(merged.alias("m"), left.alias(RESCUED)).select(*[F.col("m")[f.name].alias(f.name) for f in schema], RESCUED)

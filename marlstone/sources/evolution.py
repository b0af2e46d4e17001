"""Schemas that change from one stored part of a table to the next, brought to one.

Types form a lattice: null below everything, whole numbers below ``bigint``, that
below ``double``, dates below timestamps, and text above all.  Structs, arrays and
maps join by field, element and value.  A column whose type changes is cast in
each part to the least type above all of its types.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = (*WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
NESTED = (T.StructType, T.ArrayType, T.MapType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, WHOLE) and isinstance(b, WHOLE):
        return T.LongType()
    if isinstance(a, NUMBERS) and isinstance(b, NUMBERS):
        return T.DoubleType()
    if {type(a), type(b)} <= {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, common_type(a.valueType, b.valueType))
    return T.StringType()


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns in order of their first appearance, each with its common type."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            found[field.name] = common_type(found.get(field.name, T.NullType()), field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


def converted(value: Column, found: T.DataType, wanted: T.DataType) -> Column:
    """A value of one type as the type above it; structured values that become text become JSON."""
    if found == wanted:
        return value
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        fields = {f.name: f.dataType for f in found.fields}
        parts = [
            (converted(value.getField(f.name), fields[f.name], f.dataType) if f.name in fields else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in wanted.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: converted(x, found.elementType, wanted.elementType))
    if isinstance(found, T.MapType) and isinstance(wanted, T.MapType):
        return F.transform_values(value, lambda _, x: converted(x, found.valueType, wanted.valueType))
    if isinstance(found, NESTED):
        return F.to_json(value)
    return value.cast(wanted)


def as_schema(df: DataFrame, wanted: T.StructType, empty: Sequence[str] = ()) -> DataFrame:
    """``df`` with the columns of ``wanted``; missing columns and those in ``empty`` are NULL."""
    found = {f.name: f.dataType for f in df.schema.fields if f.name not in empty}
    return df.select(
        *[
            (converted(F.col(f"`{f.name}`"), found[f.name], f.dataType) if f.name in found else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in wanted.fields
        ]
    )


def disputed(schemas: Sequence[T.StructType]) -> set[str]:
    """Columns that do not have the same type wherever they occur."""
    kinds: dict[str, set[str]] = {}
    for schema in schemas:
        for field in schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    return {name for name, seen in kinds.items() if len(seen) > 1}


def union_evolved(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of parts whose schemas differ, under the common schema.

    Readers take a column without any value for text.  So where a column's types differ, the parts that have it as
    text are asked whether it holds a value at all, in one job that reads nothing but those columns.
    """
    dispute = disputed([p.schema for p in parts])
    text = [[f.name for f in p.schema.fields if f.name in dispute and f.dataType == T.StringType()] for p in parts]
    asked = [
        part.agg(F.array(*[F.count(F.col(f"`{c}`")) for c in columns]).alias("n")).select(F.lit(i).alias("part"), "n")
        for i, (part, columns) in enumerate(zip(parts, text, strict=True))
        if columns
    ]
    counts = {r.part: r.n for r in reduce(DataFrame.unionAll, asked).collect()} if asked else {}  # one row a part
    empty = [[c for c, n in zip(columns, counts.get(i, ()), strict=True) if not n] for i, columns in enumerate(text)]
    schemas = [
        T.StructType([T.StructField(f.name, T.NullType() if f.name in none else f.dataType) for f in part.schema.fields])
        for part, none in zip(parts, empty, strict=True)
    ]
    wanted = common_schema(schemas)
    wanted = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in wanted.fields])
    return reduce(DataFrame.unionAll, [as_schema(p, wanted, none) for p, none in zip(parts, empty, strict=True)])

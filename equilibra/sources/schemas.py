"""Reconciling bundle schemas: what a table lacks is read as typed nulls.

Bundles come with the fields that their sender had: a table may know no quantities, no sample
times, or no components at all, and a folder may hold files of several such kinds. ``merged`` joins
a file's schema with the expected one, struct by struct, and a read with the result fills
in nulls (column readers do so file by file). ``conformed`` does the same for a frame that
is read already, and leaves it as it is where it lacks nothing.

A field whose type can't be widened to the expected one raises ``SchemaConflict`` with its path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types that readers and casts widen without loss, by expected type.
WIDER = {
    T.LongType: (T.ByteType, T.ShortType, T.IntegerType),
    T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType),
}


class SchemaConflict(ValueError):
    """A field is of another type than expected."""


def merged(have: T.DataType, want: T.DataType, path: str = "") -> T.DataType:
    """``have`` with all that ``want`` has besides; the order of ``have``, its further fields kept."""
    if isinstance(have, T.NullType):
        return want
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        expected = {f.name: f for f in want.fields}
        fields = [
            T.StructField(f.name, merged(f.dataType, expected[f.name].dataType, f"{path}.{f.name}".lstrip(".")), True, f.metadata) if f.name in expected else f
            for f in have.fields
        ]
        names = set(have.fieldNames())
        return T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in want.fields if f.name not in names]])
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return T.ArrayType(merged(have.elementType, want.elementType, path), True)
    if have == want or isinstance(have, WIDER.get(type(want), ())):
        return want
    raise SchemaConflict(f"{path} is {have.simpleString()}, not {want.simpleString()}")


def lacks(have: T.DataType, want: T.DataType) -> bool:
    """Whether a path of ``want`` isn't in ``have``."""
    if isinstance(want, T.StructType):
        return not isinstance(have, T.StructType) or any(f.name not in have.fieldNames() or lacks(have[f.name].dataType, f.dataType) for f in want.fields)
    if isinstance(want, T.ArrayType):
        return not isinstance(have, T.ArrayType) or lacks(have.elementType, want.elementType)
    return False


def _conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want)
    if isinstance(want, T.StructType):
        names = have.fieldNames()
        fields = [
            (_conform(value.getField(f.name), have[f.name].dataType, f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _conform(x, have.elementType, want.elementType)) if lacks(have, want) else value
    return value if have == want else value.cast(want)


def conformed(df: DataFrame, want: T.StructType) -> DataFrame:
    """``df`` with typed nulls for the paths of ``want`` that it lacks; a null struct or
    array stays null. Unchanged, and as prunable as before, if it lacks none."""
    if not lacks(df.schema, want):
        return df
    full = merged(df.schema, want)
    names = df.columns
    out = df
    for f in full.fields:
        if f.name not in names:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
        elif lacks(df.schema[f.name].dataType, f.dataType):
            out = out.withColumn(f.name, _conform(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType))
    return out

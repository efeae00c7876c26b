"""Generic flatten (N1-N4)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equilibra.operators import flatten_nested


def test_arrays_outer_and_nested(spark):
    df = spark.createDataFrame(
        [(1, None), (2, []), (3, [[1, 2], [3]])],
        "id int, a array<array<int>>",
    )
    rows = sorted(tuple(r) for r in flatten_nested(df).collect())
    assert rows == [(1, None), (2, None), (3, 1), (3, 2), (3, 3)]


def test_struct_children_appended_and_map_untouched(spark):
    schema = T.StructType(
        [
            T.StructField("s", T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])),
            T.StructField("m", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("z", T.IntegerType()),
        ]
    )
    df = spark.createDataFrame([((1, "a"), {"k": 1}, 9)], schema)
    out = flatten_nested(df)
    assert out.columns == ["m", "z", "s_x", "s_y"]
    assert isinstance(out.schema["m"].dataType, T.MapType)
    assert tuple(out.first()) == ({"k": 1}, 9, 1, "a")


def test_array_of_structs_and_sibling_arrays_multiply(spark):
    df = spark.createDataFrame(
        [([(1, [10, 20])], ["p", "q"])],
        "a array<struct<x:int, ys:array<int>>>, b array<string>",
    )
    out = flatten_nested(df)
    assert sorted(out.columns) == ["a_x", "a_ys", "b"]
    assert out.count() == 4  # 2 ys x 2 b


def test_collision_raises(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<b:int>, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        flatten_nested(df)


def test_dotted_field_names(spark):
    schema = T.StructType([T.StructField("p.q", T.StructType([T.StructField("r.s", T.IntegerType())]))])
    df = spark.createDataFrame([((7,),)], schema)
    out = flatten_nested(df)
    assert out.columns == ["p.q_r.s"]
    assert out.select(F.col("`p.q_r.s`")).first()[0] == 7

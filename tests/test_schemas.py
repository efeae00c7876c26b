"""Bundles that lack optional paths, in part or as a whole."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from equilibra import codes as C
from equilibra.operators import observations
from equilibra.plans import PRODUCT_FIELDS, PRODUCTS
from equilibra.sources import BUNDLE_SCHEMA, load_bundle
from equilibra.sources.schemas import SchemaConflict, conformed, lacks, merged
from tests.conftest import SF_SMALL

#: Optional paths, and what an observation row loses with each.
LOST = {
    "subject": [C.REFERENCE, C.PATIENT],
    "effectiveDateTime": [C.EFFECTIVE, C.DATE, C.WEEK, C.START],
    "component.code.text": [C.TEXT],
    "component.valueBoolean": [C.FLAG],
    "component.valueQuantity": [C.QUANTITY],
    "component.valueSampledData": [C.SAMPLES, C.SAMPLE_TIMES],
    "component.valueSampledData.extension": [C.SAMPLE_TIMES],
    "component.valueSampledData.extension.valueString": [C.SAMPLE_TIMES],
    "code.coding.display": [C.DISPLAY],
}
#: Without one of these there is no row.
CODED = ["component", "component.code", "component.code.coding", "component.code.coding.code", "code", "code.coding", "code.coding.code"]


def without(dtype, path):
    """The type without a path; a struct that loses its only field keeps another."""
    head, _, rest = path.partition(".")
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(without(dtype.elementType, path))
    fields = [f if f.name != head else T.StructField(f.name, without(f.dataType, rest)) for f in dtype.fields if f.name != head or rest]
    return T.StructType(fields or [T.StructField("other", T.StringType())])


def rows(df):
    return Counter(map(repr, df.collect()))


@pytest.fixture(scope="module")
def bundles(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("schemas") / "b")
    entry.session_bundles(spark, SF_SMALL).limit(60).write.parquet(at)
    return spark.read.parquet(at)


def narrowed(df, path):
    return df.sparkSession.createDataFrame(df.rdd.map(lambda r: r), df.schema).select(F.from_json(F.to_json("entry"), without(df.schema["entry"].dataType, f"resource.{path}")).alias("entry"))


@pytest.mark.parametrize("path", [*LOST, *CODED])
def test_a_table_without_a_path(spark, bundles, tmp_path, path):
    codes = [C.RANGE_OF_MOVEMENT, C.DISORIENTATION, C.DURATION]
    full = observations(bundles, codes, times=True)
    narrowed(bundles, path).write.parquet(str(tmp_path / "b"))
    want = full.limit(0) if path in CODED else full.select([F.lit(None).cast(t).alias(c) if c in LOST[path] else F.col(c) for c, t in full.dtypes])
    for got in (spark.read.parquet(str(tmp_path / "b")), load_bundle(spark, str(tmp_path / "b"), fields=PRODUCT_FIELDS["segment_mean_range"] + PRODUCT_FIELDS["session_report"])):
        seen = observations(got, codes, times=True)
        assert seen.columns == full.columns and rows(seen) == rows(want)


def test_a_folder_of_several_kinds(spark, bundles, tmp_path):
    at = str(tmp_path / "b")
    narrowed(bundles, "component").write.parquet(at)
    narrowed(bundles, "component.valueSampledData").write.mode("append").parquet(at)
    bundles.write.mode("append").parquet(at)
    for name in ("range_mean", "dizziness_weekly_sum", "segment_max_speed"):
        got = PRODUCTS[name](load_bundle(spark, at, fields=PRODUCT_FIELDS[name]))
        assert rows(got) == rows(PRODUCTS[name](bundles))


def test_a_whole_frame_is_left_alone(bundles):
    assert conformed(bundles, BUNDLE_SCHEMA) is bundles
    assert not lacks(merged(without(BUNDLE_SCHEMA, "entry.resource.component.code"), BUNDLE_SCHEMA), BUNDLE_SCHEMA)


def test_types_that_differ():
    has = lambda t: T.StructType([T.StructField("value", t)])
    assert merged(has(T.IntegerType()), has(T.DoubleType())) == has(T.DoubleType())
    assert merged(has(T.NullType()), has(T.DoubleType())) == has(T.DoubleType())
    with pytest.raises(SchemaConflict, match="value is string, not double"):
        merged(has(T.StringType()), has(T.DoubleType()))
    with pytest.raises(SchemaConflict):
        merged(has(T.StringType()), has(T.ArrayType(T.StringType())))

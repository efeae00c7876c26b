"""Bundle loading: narrowed schemas and catalog names."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equilibra.plans import PRODUCT_FIELDS, PRODUCTS
from equilibra.sources import BUNDLE_SCHEMA, FLAG_FIELDS, TIMED_FIELDS, load_bundle, prune_schema


def test_prune_schema_keeps_only_listed_leaves():
    pruned = prune_schema(BUNDLE_SCHEMA, FLAG_FIELDS)
    comp = pruned["entry"].dataType.elementType["resource"].dataType["component"].dataType.elementType
    assert comp.fieldNames() == ["code", "valueBoolean"]
    res = pruned["entry"].dataType.elementType["resource"].dataType
    assert "category" not in res.fieldNames()
    timed = prune_schema(BUNDLE_SCHEMA, TIMED_FIELDS)
    sampled = timed["entry"].dataType.elementType["resource"].dataType["component"].dataType.elementType
    assert sampled["valueSampledData"].dataType.fieldNames() == ["data", "extension"]


def test_prune_schema_skips_missing_and_keeps_maps():
    schema = T.StructType(
        [T.StructField("a", T.MapType(T.StringType(), T.IntegerType())), T.StructField("b", T.IntegerType())]
    )
    assert prune_schema(schema, ["a", "x.y"]).fieldNames() == ["a"]
    assert prune_schema(schema, ["x"]).fieldNames() == []


def test_load_bundle_path_and_catalog_name(spark, small_bundles):
    narrowed = load_bundle(spark, small_bundles, fields=PRODUCT_FIELDS["vision_weekly_sum"])
    full = load_bundle(spark, small_bundles)
    full.createOrReplaceTempView("equilibra_test_bundles")
    by_name = load_bundle(spark, "equilibra_test_bundles")
    a = PRODUCTS["vision_weekly_sum"](narrowed)
    b = PRODUCTS["vision_weekly_sum"](by_name)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_catalog_table_is_narrowed_and_keeps_partitions(spark, small_bundles, tmp_path):
    full = load_bundle(spark, small_bundles).withColumn("site", F.size("entry"))
    full.write.partitionBy("site").option("path", str(tmp_path / "t")).saveAsTable("equilibra_saved_bundles")
    try:
        df = load_bundle(spark, "equilibra_saved_bundles", fields=FLAG_FIELDS)
        assert df.columns == ["entry", "site"]
        assert "valueSampledData" not in df.schema.simpleString()
        ours = PRODUCTS["vision_weekly_sum"](df)
        assert "valueSampledData" not in ours._jdf.queryExecution().executedPlan().toString()
        theirs = PRODUCTS["vision_weekly_sum"](spark.table("equilibra_saved_bundles"))
        assert ours.count() > 0 and ours.exceptAll(theirs).count() == 0 and theirs.exceptAll(ours).count() == 0
    finally:
        spark.sql("DROP TABLE equilibra_saved_bundles")


def test_fields_are_never_ignored(spark, small_bundles):
    load_bundle(spark, small_bundles).createOrReplaceTempView("equilibra_view_bundles")
    with pytest.raises(ValueError, match="fields"):
        load_bundle(spark, "equilibra_view_bundles", fields=FLAG_FIELDS)
    with pytest.raises(ValueError, match="fields"):
        load_bundle(spark, small_bundles, format="delta", fields=FLAG_FIELDS)


def test_tables_of_moved_and_dropped_partitions_raise(spark, tmp_path):
    def made(name: str) -> str:
        spark.sql(f"CREATE TABLE {name} (id STRING, d STRING) USING parquet PARTITIONED BY (d) LOCATION '{tmp_path}/{name}'")
        spark.sql(f"INSERT INTO {name} VALUES ('a', 'x y'), ('b', 'z'), ('c', NULL)")
        return name

    names = [f"t{k}_{uuid.uuid4().hex[:8]}" for k in range(4)]
    try:
        whole = load_bundle(spark, made(names[0]), fields=["id"])
        assert sorted((r["id"], r["d"] or "") for r in whole.collect()) == [("a", "x y"), ("b", "z"), ("c", "")]
        spark.sql(f"ALTER TABLE {made(names[1])} PARTITION (d='z') SET LOCATION '{tmp_path}/elsewhere'")
        spark.sql(f"CREATE TABLE {names[2]} (id STRING, d STRING) USING parquet PARTITIONED BY (d) LOCATION '{tmp_path}/{names[1]}'")
        spark.sql(f"ALTER TABLE {names[2]} ADD PARTITION (d='z')")
        for name in names[1:3]:
            with pytest.raises(ValueError, match="narrow"):
                load_bundle(spark, name, fields=["id"])
        (tmp_path / "json").mkdir()
        (tmp_path / "json/a.json").write_text('{\n"id": "a",\n"d": "x"\n}')
        spark.sql(f"CREATE TABLE {names[3]} (id STRING, d STRING) USING json OPTIONS (multiLine true) LOCATION '{tmp_path}/json'")
        assert [r["id"] for r in load_bundle(spark, names[3], fields=["id"]).collect()] == ["a"]
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

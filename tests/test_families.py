"""A family's products from one shared frame against each product by itself."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from equilibra import codes as C
from equilibra.operators.observations import observations
from equilibra.operators.rejects import quarantine, reject_counts, reject_list
from equilibra.plans import PRODUCTS
from equilibra.plans.families import FAMILIES, publish_products
from equilibra.sources import Store, read_version
from tests.conftest import SF_SMALL


def rows(df):
    digits = [F.round(F.col(f"`{c}`"), 9).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    return Counter(map(repr, df.select(digits).collect()))


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("families"))
    entry.hard_bundles(spark, SF_SMALL).write.parquet(f"{root}/bundles")
    bundles = spark.read.parquet(f"{root}/bundles")
    return root, bundles, publish_products(bundles, root=root)


def test_every_product_belongs_to_one_family():
    names = [p for f in FAMILIES.values() for p in f.products]
    assert sorted(names) == sorted(PRODUCTS)


@pytest.mark.parametrize("name", sorted(PRODUCTS))
def test_read_back_equal(spark, published, name):
    root, bundles, _ = published
    assert rows(read_version(spark, name, root=root)) == rows(PRODUCTS[name](bundles))


def test_one_scan_and_one_commit_per_family(spark, published):
    root, bundles, out = published
    for name, family in FAMILIES.items():
        if name != "session_report":
            assert family.frame(bundles)._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
        assert {r["version"] for p in family.products for r in Store(spark, root).current(p)} == {out[name].version}
        held = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in spark.read.parquet(f"{root}/frames/*").inputFiles() if f"/{name}-" in f})
        assert out[name].rows == held.count()


def test_some_products_only(spark, published, tmp_path):
    _, bundles, _ = published
    out = publish_products(bundles, ["range_min", "score_session_sum"], root=str(tmp_path))
    assert set(out) == {"scores", "movement"} and Store(spark, str(tmp_path)).names() == ["range_min", "rejects", "score_session_sum"]
    with pytest.raises(ValueError, match="no such"):
        publish_products(bundles, ["nope"], root=str(tmp_path))


def test_rejects_of_the_same_scan(spark, published):
    root, bundles, out = published
    want = quarantine(bundles, [C.RANGE_OF_MOVEMENT, C.SPEED_OF_MOVEMENT])
    got = read_version(spark, "rejects", root=root).select(want.columns)
    assert rows(got) == rows(want)
    counts = Counter(r["reason"] for r in want.collect())
    told = dict(out["movement"].rejected)
    told.pop("rows")
    assert {k: v for k, v in told.items() if v} == counts and set(counts) == {"not a date", "empty token", "not a number"}


def test_rejects_by_brute_force(spark):
    plant = [
        ("Patient/1", "2021-01-01T00:00:00Z", "[[[1 x  2]]]"),
        ("urn:x", "2021-13-01", "[[[]]]"),
        (None, None, None),
        ("Patient/2", "", "[[[NaN Infinity 1e400 -]]]"),
    ]
    entry_type = "array<struct<resource: struct<subject: struct<reference: string>, effectiveDateTime: string, code: struct<coding: array<struct<code: string, display: string>>>, component: array<struct<code: struct<coding: array<struct<code: string>>, text: string>, valueSampledData: struct<data: string>>>>>>"
    made = [([(((r,), d, ([(C.SESSION, "e")],), [(([(C.RANGE_OF_MOVEMENT,)], "t"), (s,))]),)],) for r, d, s in plant]
    bundles = spark.createDataFrame(made, f"entry {entry_type}")
    got = {(r["field"], r["place"], r["value"], r["reason"]) for r in quarantine(bundles, [C.RANGE_OF_MOVEMENT]).collect()}
    assert got == {
        ("valueSampledData.data", 1, "x", "not a number"),
        ("valueSampledData.data", 2, "", "empty token"),
        ("subject.reference", None, "urn:x", "no patient"),
        ("subject.reference", None, None, "no patient"),
        ("effectiveDateTime", None, "2021-13-01", "not a date"),
        ("effectiveDateTime", None, "", "not a date"),
        ("valueSampledData.data", 0, "", "empty token"),
        ("valueSampledData.data", 3, "-", "not a number"),
    }
    held = observations(bundles, [C.RANGE_OF_MOVEMENT]).withColumn("_rejects", reject_list()).agg(*reject_counts()).first().asDict()
    assert held == {"not a date": 2, "no patient": 2, "empty token": 2, "not a number": 2, "rows": 4}

"""The skipping index: files that can't match aren't read, and a stale index raises."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from equilibra import codes as C
from equilibra.operators import observations
from equilibra.plans import PRODUCTS
from equilibra.sources import FLAG_FIELDS, StaleIndex, build_index, load_bundle, matching_files, refresh_index, write_clustered
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("skip")
    source = write_clustered(entry.event_bundles(spark, SF_SMALL), str(root / "bun dles"), 10)
    return source, build_index(spark, source, str(root / "index"))


def rows(df):
    return Counter(map(repr, df.collect()))


def test_index_describes_each_file(spark, stored):
    source, index = stored
    want = {}
    read = spark.read.parquet(source).select(F.col("_metadata.file_path").alias("f"), "*")
    for r in read.collect():
        at = want.setdefault(r["f"], (set(), set(), set()))
        for e in r["entry"]:
            at[0].update(k["code"] for k in e["resource"]["code"]["coding"])
            at[1].update(k["code"] for c in e["resource"]["component"] for k in c["code"]["coding"])
            at[2].add(e["resource"]["effectiveDateTime"][:10])
    got = {r["file"]: r for r in spark.read.parquet(index).collect()}
    assert set(want) <= set(got)
    for f, (sessions, components, dates) in want.items():
        r = got[f]
        assert (set(r["sessions"]), set(r["components"])) == (sessions, components)
        assert (str(r["date_min"]), str(r["date_max"])) == (min(dates), max(dates))


@pytest.mark.parametrize("code", list(C.SYMPTOMS))
def test_only_matching_files_are_read(spark, stored, code):
    source, index = stored
    every = load_bundle(spark, source, fields=FLAG_FIELDS)
    some = load_bundle(spark, source, fields=FLAG_FIELDS, index=index, codes=[code])
    assert 0 < len(some.inputFiles()) < len(every.inputFiles()) / 2
    assert some.schema == every.schema
    product = lambda b: PRODUCTS["session_report"](b) if code == "x" else observations(b, [code])
    assert rows(product(some)) == rows(product(every))


def test_dates_and_patients(spark, stored):
    source, index = stored
    every = observations(load_bundle(spark, source), list(C.SYMPTOMS))
    low, high = (str(every.agg(f(C.DATE)).first()[0]) for f in (F.min, F.max))
    assert len(matching_files(spark, source, index, dates=(low, high))) == len(spark.read.parquet(source).inputFiles())
    assert matching_files(spark, source, index, dates=("1900-01-01", "1900-12-31")) == []
    none = load_bundle(spark, source, index=index, codes=["no such code"])
    assert none.count() == 0 and none.schema == load_bundle(spark, source).schema
    some = load_bundle(spark, source, index=index, dates=(low, low), patients=("1", "2"))
    mine = lambda o: o.filter((F.col(C.DATE) == low) & F.col(C.PATIENT).between("1", "2"))
    assert rows(mine(observations(some, list(C.SYMPTOMS)))) == rows(mine(every))
    with pytest.raises(ValueError, match="need an index"):
        load_bundle(spark, source, codes=["x"])


def test_a_stale_index_raises_until_it_is_refreshed(spark, tmp_path):
    source, index = str(tmp_path / "b"), str(tmp_path / "i")
    bundles = entry.event_bundles(spark, SF_SMALL)
    write_clustered(bundles.limit(100), source, 3)
    build_index(spark, source, index)
    assert matching_files(spark, source, index)
    bundles.limit(5).write.mode("append").parquet(source)
    with pytest.raises(StaleIndex):
        load_bundle(spark, source, index=index, codes=[C.DISORIENTATION])
    fresh = refresh_index(spark, source, index, str(tmp_path / "i2"))
    whole = build_index(spark, source, str(tmp_path / "i3"))
    assert rows(spark.read.parquet(fresh)) == rows(spark.read.parquet(whole).select(spark.read.parquet(fresh).columns))
    assert load_bundle(spark, source, index=fresh).count() == 105


def test_files_without_observations(spark, tmp_path):
    source, index = str(tmp_path / "b"), str(tmp_path / "i")
    bundles = entry.event_bundles(spark, SF_SMALL)
    bundles.limit(0).coalesce(1).write.parquet(source)
    bundles.limit(3).withColumn("entry", F.lit(None).cast(bundles.schema["entry"].dataType)).coalesce(1).write.mode("append").parquet(source)
    build_index(spark, source, index)
    held = spark.read.parquet(index).collect()
    assert len(held) == 2 and all(r["components"] == [] and r["observations"] == 0 for r in held)
    assert load_bundle(spark, source, index=index, codes=[C.HEADACHE]).count() == 0

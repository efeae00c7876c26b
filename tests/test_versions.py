"""Versioned tables: the old result until the new one is whole, parts replaced alone."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from equilibra.sources import Store, Write, publish_version, read_version


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def days(spark, pairs):
    return spark.createDataFrame(pairs, "Date date, n int") if not pairs else spark.createDataFrame(pairs, "Date string, n int").withColumn("Date", F.col("Date").cast("date"))


def test_a_failing_write_leaves_the_old_result(spark, tmp_path):
    root = str(tmp_path)
    assert publish_version(days(spark, [("2021-01-01", 1)]), "t", root=root) == 1
    broken = days(spark, [("2021-01-01", 2)]).withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    for by in (None, "Date"):
        with pytest.raises(Exception, match="no"):
            publish_version(broken, "t", root=root, by=by)
    assert [r["n"] for r in read_version(spark, "t", root=root).collect()] == [1]
    assert Store(spark, root).version() == 1


def test_one_date_is_replaced_alone(spark, tmp_path):
    root = str(tmp_path)
    publish_version(days(spark, [("2021-01-01", 1), ("2021-01-02", 2), (None, 3)]), "t", root=root, by="Date")
    before = set(read_version(spark, "t", root=root).inputFiles())
    publish_version(days(spark, [("2021-01-02", 20), ("2021-01-03", 30)]), "t", root=root, by="Date")
    now = read_version(spark, "t", root=root)
    assert sorted((str(r["Date"]), r["n"]) for r in now.collect()) == [("2021-01-01", 1), ("2021-01-02", 20), ("2021-01-03", 30), ("None", 3)]
    kept = before & set(now.inputFiles())
    assert len(kept) == 2 and not any("2021-01-02" in f for f in kept)
    # The first version is still there, and a part can be emptied by name.
    assert {r["n"] for r in read_version(spark, "t", root=root, version=1).collect()} == {1, 2, 3}
    publish_version(days(spark, []), "t", root=root, by="Date", parts=("2021-01-01", None))
    assert {r["n"] for r in read_version(spark, "t", root=root).collect()} == {20, 30}


def test_parts_read_only_their_files(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.commit([Write("t", days(spark, [("2021-01-01", 1), ("2021-01-02", 2)]), by="Date")])
    store.commit([Write("t", days(spark, [("2021-01-02", 5)]), "add", "Date")])
    some = store.read("t", parts=["2021-01-02"])
    assert {r["n"] for r in some.collect()} == {2, 5} and not any("2021-01-01" in f for f in some.inputFiles())
    assert store.read("t", parts=["1999-01-01"]).count() == 0


def test_tables_of_a_commit_switch_together(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    one = days(spark, [("2021-01-01", 1)])
    store.commit([Write("a", one), Write("b", one)])
    broken = one.withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        store.commit([Write("a", one.withColumn("n", F.lit(2))), Write("b", broken)])
    assert store.read("a").first()["n"] == store.read("b").first()["n"] == 1 and store.names() == ["a", "b"]


def test_two_commits_of_one_version(spark, tmp_path, monkeypatch):
    """Of commits that take the same number one counts, and the other raises."""
    first, second = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    one = days(spark, [("2021-01-01", 1)])
    monkeypatch.setattr(second, "version", lambda: 0)
    monkeypatch.setattr("equilibra.sources.versions.uuid.uuid4", lambda: type("U", (), {"hex": "a"})())
    first.commit([Write("t", one)])
    monkeypatch.setattr("equilibra.sources.versions.uuid.uuid4", lambda: type("U", (), {"hex": "b"})())
    with pytest.raises(RuntimeError, match="taken by another"):
        second.commit([Write("t", one.withColumn("n", F.lit(9)))])
    assert first.read("t").first()["n"] == 1


def test_odd_values_empty_tables_and_mistakes(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    odd = spark.createDataFrame([("a/b", 1), ("é =", 2), ("", 3), (None, 4), ("n", 5)], "k string, n int")
    store.commit([Write("t", odd, by="k")])
    assert rows(store.read("t")) == rows(odd)
    for k, n in (("a/b", 1), ("é =", 2), ("", 3), (None, 4), ("n", 5)):
        assert [r["n"] for r in store.read("t", parts=[k]).collect()] == [n]
    store.commit([Write("t", odd.limit(0))])
    assert store.read("t").count() == 0 and store.read("t").columns == ["k", "n"]
    with pytest.raises(ValueError, match="never published"):
        store.read("u")
    with pytest.raises(ValueError, match="mode"):
        store.commit([Write("t", odd, "part")])

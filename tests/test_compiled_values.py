"""Sample texts read by compiled expressions: the same values as token by token."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import odd_tokens, parse_float, sample_floats, sample_tokens, sample_values
from equilibra.operators.moments import add_moments
from equilibra.sources import hard_bundle, session_bundle

TOKENS = ["1", "-2.5", ".5", "5.", ".", "-", "--1", "1-2", "1.2.3", "-.", "-.5", "", "n/a", "NaN", "Infinity", "-Inf", "1e3", "1f", "2D", "9" * 60, "x1", "\t3", "nan", "4\n", "é", "٣", "infinity ", "+7"]


def _texts() -> list[str | None]:
    rng = random.Random(7)
    some = ["[[[" + " ".join(rng.choices(TOKENS, k=rng.randint(1, 4))) + "]]]" for _ in range(400)]
    odd = [None, "", "[[[]]]", "[[[", "]]]", "[[[1 2]]", "[[[[1]]]]", "[[[1]]]\n", "1 2", "[[[ ]]]", "[[[1 2 ]]]", "[[[ 1]]]", "[[[1  2]]]", "[[[1\n2]]]"]
    return some + [f"[[[{t}]]]" for t in TOKENS] + odd


def test_values_are_those_of_the_tokens(spark):
    df = spark.createDataFrame([(t,) for t in _texts()], "text string")
    stripped = F.split(F.regexp_replace("text", r"(^\[\[\[)|(\]\]\]$)", ""), " ")
    rows = df.select(
        "text",
        stripped.alias("split"),
        sample_tokens("text").alias("tokens"),
        F.transform(stripped, lambda t: t.try_cast("float")).cast("array<string>").alias("plain"),
        F.transform(sample_tokens("text"), parse_float).cast("array<string>").alias("each"),
        sample_values("text").cast("array<string>").alias("values"),
        sample_floats("text").cast("array<string>").alias("floats"),
        odd_tokens("text").alias("odd"),
    ).collect()
    for r in rows:
        assert r["split"] == r["tokens"]
        assert r["plain"] == r["each"] == r["values"], r["text"]
        assert (r["floats"] is None) == (r["plain"] is None)
        if r["plain"] is not None:
            assert [x for x in r["floats"] if x is not None] == [x for x in r["plain"] if x is not None], r["text"]
            assert r["odd"] or None not in r["plain"], r["text"]


def test_moments_leave_out_nulls_beside_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, [1.0, None, 3.0]), (2, [nan, None, 1.0]), (3, [None]), (4, []), (5, None)], "k int, v array<float>")
    got = {r["k"]: (r["m"]["n"], str(r["m"]["s"]), str(r["m"]["mx"])) for r in add_moments(df, "m", F.col("v")).collect()}
    assert got[1] == (2, "4.0", "3.0") and got[2] == (2, "nan", "nan") and got[3] == (0, "0.0", "None") and got[4] == (0, "0.0", "None")
    assert str(add_moments(df, "m", F.col("v"), std=False).filter("k = 1").first()["m"]["m2"]) == "None"


def _tables(spark):
    orders = spark.range(1, 41).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"), F.lit("1996-01-02").cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")
    )
    lines = spark.createDataFrame(
        [(k, n, q, f) for k in range(1, 36) for n, q, f in ((2, 7.0, "N"), (1, 3.0, "N"), (1, 3.0, "N"), (None, 4.0, "A"), (3, None, "A"), (2, 9.0, "R"))] + [(None, 1, 1.0, "N"), (36, 1, 2.0, None)],
        "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string",
    )
    return orders, lines


def test_bundles_keep_their_lines_in_order(spark):
    orders, lines = _tables(spark)
    for build, first in ((session_bundle, "[[[3.0 3.0 7.0]]]"), (hard_bundle, "[[[1.110 1.110 2.590]]]")):
        rows = build(orders, lines).select(F.explode("entry").alias("e")).select("e.resource.subject.reference", F.explode("e.resource.component").alias("c"))
        texts = rows.select("c.code.text", "c.valueSampledData.data", F.col("c.valueSampledData.extension")[0]["valueString"].alias("t")).filter("data is not null")
        found = {(r["text"], r["data"], r["t"]) for r in texts.collect()}
        assert ("N", first, "[[[0 0 15000]]]") in found
        # A line without number or quantity adds to one of the texts only.
        assert ("A", "[[[4.0]]]" if build is session_bundle else "[[[1.480]]]", "[[[15000]]]") in found
        assert {t for t, _, _ in found} == {"N", "A", "R"}


def test_builder_keeps_the_number_of_its_tasks(spark):
    """Merging tasks goes by bytes, which are few: bundles were built in too few tasks of uneven number."""
    orders, lines = _tables(spark)
    for build in (session_bundle, hard_bundle):
        assert build(orders, lines).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_published_version_builds_bundles_once(spark, monkeypatch):
    import __spark_entry__ as entry

    calls = []
    monkeypatch.setattr(entry, "read_version", lambda *a, **k: None)
    monkeypatch.setattr(entry, "publish_version", lambda df, *a, **k: calls.append(df._jdf.queryExecution().optimizedPlan().toString()))
    entry._published_version(spark, "/root/testdata/sf0.001")
    assert len(calls) == 2 and not any("Generate" in p or "Join" in p for p in calls)


def test_rejects_are_made_once(spark):
    from equilibra.operators.rejects import quarantine

    orders, lines = _tables(spark)
    plan = quarantine(hard_bundle(orders, lines), [C.RANGE_OF_MOVEMENT])._jdf.queryExecution().optimizedPlan().toString()
    # The reason is written out once per rejected token's list.
    assert plan.count("not a number") == 1

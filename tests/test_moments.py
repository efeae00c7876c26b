"""Mergeable moments against Spark's own aggregates on exploded samples."""

import math
import random
import struct
from fractions import Fraction
from functools import reduce

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra.operators.moments import add_moments, cells, grouped, max_of, mean_of, merge_cells, min_of, stddev_of

values = st.one_of(st.none(), st.integers(-1000, 1000).map(lambda i: i / 8))
observation = st.tuples(st.integers(0, 2), st.lists(values, max_size=6))


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def _merged(spark, rows):
    df = spark.createDataFrame(rows, "g int, v array<float>")
    m = grouped(add_moments(df, "m", F.col("v")), ["g"], {"a": "m"}, std=True)
    return m.select(
        "g",
        mean_of("a").alias("mean"),
        stddev_of("a").alias("std"),
        min_of("a").alias("mn"),
        max_of("a").alias("mx"),
    )


def _builtin(spark, rows):
    df = spark.createDataFrame(rows, "g int, v array<float>")
    e = df.select("g", F.explode("v").alias("x"))
    return e.groupBy("g").agg(
        F.mean("x").alias("mean"), F.stddev("x").alias("std"), F.min("x").alias("mn"), F.max("x").alias("mx")
    )


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(observation, min_size=1, max_size=8))
def test_merge_equals_builtin(spark, obs):
    rows = [(g, v) for g, v in obs]
    ours = {r["g"]: r for r in _merged(spark, rows).collect()}
    ref = {r["g"]: r for r in _builtin(spark, rows).collect()}
    # explode drops an observation with an empty array; its group may then be absent
    for g, r in ref.items():
        for c in ("mean", "std", "mn", "mx"):
            assert _close(ours[g][c], r[c]), (g, c, ours[g][c], r[c])
    for g, r in ours.items():
        if g not in ref:
            assert all(r[c] is None for c in ("mean", "std", "mn", "mx"))


def test_single_sample_std_null_and_nan(spark):
    out = {r["g"]: r for r in _merged(spark, [(0, [1.0]), (1, [float("nan"), 1.0])]).collect()}
    assert out[0]["std"] is None
    assert out[1]["mn"] == 1.0 and math.isnan(out[1]["mx"]) and math.isnan(out[1]["mean"])


def test_constant_values_give_zero_std(spark):
    for value in (0.1, 12345.6, -1e30, 1e-30):
        out = _merged(spark, [(0, [value] * 5), (0, [value] * 3), (0, [value])]).first()
        assert out["std"] == 0.0


def test_deviations_far_below_the_means(spark):
    """Against exact rational arithmetic over the float32 values, at every size of numbers."""
    rng = random.Random(4)
    for base, spread in ((12345.6, 0.1), (1e-6, 1e-9), (3e30, 1e25), (1023.99, 0.02), (-5.0, 1e-5), (0.0, 1.0)):
        obs = [[struct.unpack("f", struct.pack("f", base + rng.uniform(-spread, spread)))[0] for _ in range(rng.randint(1, 9))] for _ in range(300)]
        flat = [Fraction(x) for v in obs for x in v]
        mean = sum(flat) / len(flat)
        want = math.sqrt(sum((x - mean) ** 2 for x in flat) / (len(flat) - 1))
        got = _merged(spark, [(0, v) for v in obs]).first()["std"]
        assert math.isclose(got, want, rel_tol=1e-9), (base, spread, got, want)


def test_states_merge_in_any_order(spark):
    """Cells of parts, merged in either order, are the cells of the whole, to the last bit."""
    rng = random.Random(5)
    rows = [(rng.randint(0, 2), [rng.gauss(50, 9) for _ in range(rng.randint(0, 5))]) for _ in range(200)]
    parts = [cells(add_moments(spark.createDataFrame(x, "g int, v array<float>"), "m", F.col("v")), ["g"], F.col("m")) for x in (rows[:70], rows[70:90], rows[90:])]
    exact = ["g", "P", "N", "MN", "MX", "A", "B"]
    whole = cells(add_moments(spark.createDataFrame(rows, "g int, v array<float>"), "m", F.col("v")), ["g"], F.col("m"))
    for order in (parts, parts[::-1]):
        merged = merge_cells(reduce(DataFrame.unionByName, order), ["g"])
        assert sorted(map(repr, merged.select(exact).collect())) == sorted(map(repr, whole.select(exact).collect()))


def test_no_row_per_sample(spark):
    """The plans of standard deviations generate nothing that grows with the samples."""
    df = add_moments(spark.createDataFrame([(1, [1.0])], "g int, v array<float>"), "m", F.col("v"))
    plan = grouped(df, ["g"], {"a": "m"}, std=True)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "sequence(" not in plan and "Join" not in plan


def test_stddev_of_large_means(spark):
    """Small spread around a large mean, many observations: as exact as Spark's own."""
    for base, eps in ((12345.6, 0.1), (100.1, 0.0)):
        values = F.array(*[(F.lit(base) + F.lit(eps) * (F.rand(k) * 2 - 1)).cast("float") for k in range(2)])
        rows = spark.range(200_000).select((F.col("id") % 2).alias("g"), values.alias("v"))
        rows = add_moments(rows, "m", F.col("v"))
        ours = {r["g"]: r["x"] for r in grouped(rows, ["g"], {"a": "m"}, std=True).select("g", stddev_of("a").alias("x")).collect()}
        theirs = rows.sparkSession.range(200_000).select((F.col("id") % 2).alias("g"), F.explode(values).alias("v")).groupBy("g").agg(F.stddev("v").alias("x"))
        for r in theirs.collect():
            assert abs(ours[r["g"]] - r["x"]) <= 1e-9 * max(r["x"], 1e-4)

"""Physical plan properties that matter at scale."""

import re

import pytest

from equilibra import codes as C
from equilibra.plans import PRODUCT_FIELDS, PRODUCTS
from equilibra.sources import FACT_FIELDS, SAMPLE_FIELDS, load_bundle


def _plan(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _read_schemas(text):
    return set(re.findall(r"ReadSchema: (struct<.*)", text))


@pytest.mark.parametrize("name", sorted(PRODUCTS))
def test_no_python_and_pruned_scan(spark, small_bundles, name):
    df = PRODUCTS[name](load_bundle(spark, small_bundles, fields=PRODUCT_FIELDS[name]))
    text = _plan(spark, df)
    assert "Python" not in text  # no UDF: everything stays in the JVM
    schemas = _read_schemas(text)
    assert schemas and all("category" not in s for s in schemas)
    if name.endswith(("weekly_sum", "reported")) or name.startswith("score"):
        assert all("valueSampledData" not in s for s in schemas)
    if not name.startswith("segment") and name != "session_report":
        assert all("extension" not in s for s in schemas)


@pytest.mark.parametrize("name", [n for n in PRODUCTS if n.startswith("segment")])
def test_segments_have_no_join(spark, small_bundles, name):
    text = _plan(spark, PRODUCTS[name](load_bundle(spark, small_bundles)))
    assert "Join" not in text
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1


@pytest.mark.parametrize("name", ["range_std", "speed_weekly_mean", "segment_std_range", "session_report"])
def test_sample_text_never_shuffled(spark, small_bundles, name):
    """Sample text is reduced in the scan task; no exchange carries it."""
    df = PRODUCTS[name](load_bundle(spark, small_bundles))
    qe = df._jdf.queryExecution().executedPlan()
    text = qe.toString()
    for line in text.splitlines():
        if "Exchange" in line:
            assert C.SAMPLES not in line and C.SAMPLE_TIMES not in line


def test_report_shares_scans(spark, small_bundles):
    df = PRODUCTS["session_report"](load_bundle(spark, small_bundles, fields=PRODUCT_FIELDS["session_report"]))
    df.collect()
    final = _plan(spark, df).split("== Initial Plan ==")[0].split("\n\n")[0]
    assert final.count("Scan parquet") <= 3
    assert "ReusedExchange" in final


def test_report_joins(spark, small_bundles):
    """Three left joins, three inner joins of completed sides; sample text read by one scan."""
    df = PRODUCTS["session_report"](
        load_bundle(spark, small_bundles, fields=SAMPLE_FIELDS), load_bundle(spark, small_bundles, fields=FACT_FIELDS)
    )
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = _plan(spark, df).split("== Initial Plan ==")[0]
    tree = text.split("\n\n")[0]
    assert len(re.findall(r"Join \w+", tree)) <= 7
    scans = re.findall(r"ReadSchema: (struct<.*)", text)
    assert len([x for x in scans if "valueSampledData" in x]) <= 1 or len(set(x for x in scans if "valueSampledData" in x)) == 1


def test_built_bundles_are_built_once(spark):
    """No filter below the unnesting builds the bundle again to look at its size."""
    import __spark_entry__ as entry
    from equilibra.operators import observations

    for bundles in (entry.session_bundles(spark, "/root/testdata/sf0.001"), entry.hard_bundles(spark, "/root/testdata/sf0.001")):
        plan = observations(bundles, [C.DIZZINESS])._jdf.queryExecution().optimizedPlan().toString()
        assert not any("Filter" in line and "size(" in line for line in plan.split("\n"))


def test_empty_arrays_give_no_observation(spark):
    """Empty and null arrays at each level give no row, and rows beside them stay."""
    from equilibra.operators import observations
    from tests.bundles import bundles, component, observation

    uncoded = {**component(C.DIZZINESS, flag=True), "code": {"coding": [], "text": None}}
    null_code = {**component(C.DIZZINESS, flag=True), "code": {"coding": None, "text": None}}
    when = "2021-03-01T10:00:00+00:00"
    good = observation("p", when, "ex", [uncoded, null_code, component(C.DIZZINESS, flag=True)])
    none = [observation("q", when, "ex", []), observation("q", when, "ex", None)]
    bare = observation("q", when, "ex", [component(C.DIZZINESS, flag=True)])
    bare["resource"]["code"] = {"coding": []}
    got = observations(bundles(spark, [], none, [bare, good]), [C.DIZZINESS]).collect()
    assert [r[C.PATIENT] for r in got] == ["p"]


def test_keys_of_sides_are_gathered_once(spark):
    """Users of different columns of the sides' keys, and of none, share one exchange."""
    from pyspark.sql import functions as F

    from equilibra.plans.session_report import _presence

    a, b = spark.range(0, 60).select(F.col("id").alias("k")), spark.range(40, 100).select(F.col("id").alias("k"))
    met = _presence(["k"], _a=a, _b=b)
    assert sorted(map(tuple, met.collect())) == [(k, k < 60, k >= 40) for k in range(100)]
    users = met.select("k").unionAll(met.filter(~F.col("_a")).select("k")).unionAll(met.filter(~F.col("_b")).select("k"))
    assert users.count() == 180
    frame = users.select(F.col("k") + 0)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 2


def test_segments_moments_share_projections(spark, small_bundles):
    """The four segments' moments are made side by side, not in a chain of projections each."""
    from equilibra.plans.segments import segment_moments

    plan = segment_moments(load_bundle(spark, small_bundles), C.RANGE_OF_MOVEMENT)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("_m0_v" in line and "Project" in line for line in plan.split("\n")) <= 3
    assert sum("Project" in line for line in plan.split("\n") if "_m" in line) <= 4


def test_report_shuffles_few_rows(spark, small_bundles):
    """Sides meet in one exchange per key and two joins: the rows shuffled stay below 30 per session (35 with a join per side)."""
    from tests.test_shred import shuffled

    bundles = load_bundle(spark, small_bundles)
    df = PRODUCTS["session_report"](bundles)
    df.collect()
    moved = shuffled(df._jdf.queryExecution().executedPlan())
    assert 0 < sum(moved) < 30 * bundles.count()


def test_report_sides_that_others_lack(spark):
    """Keys that only some sides have, lone durations, no start times and null key parts, against the literal joins."""
    from collections import Counter

    from tests import literal
    from tests.bundles import bundles, component, observation

    flag, score, duration = component(C.DIZZINESS, flag=True), component(C.SESSION_SCORE, qty=3.0), component(C.DURATION, qty=40.0)
    reps, move = component(C.REPETITIONS, qty=7.0), component(C.SPEED_OF_MOVEMENT, text="N", data="[[[1 2.5 x]]]")
    long = component(C.RANGE_OF_MOVEMENT, text="A", data="[[[" + " ".join(map(str, range(40))) + "]]]")
    sides = [[move], [reps], [duration], [score], [flag], [flag, duration, reps], [move, long, duration], [score, duration, duration, reps, flag, long], [score, reps], [duration, reps]]
    entries = []
    for k, held in enumerate(sides):
        for at in ("2021-03-01T10:00:00+00:00", "2021-03-01T10:00:00Z", "not a date", None):
            entries.append(observation(f"p{k}", at, "ex", held))
        entries.append(observation(f"p{k}", "2021-03-01T11:00:00+00:00", "ex", [component(C.DURATION, qty=None), component(C.DIZZINESS, flag=None)]))
    entries += [observation("p7", "2021-03-01T12:00:00+00:00", None, sides[7]), observation("p7", "2021-03-01T10:00:00+00:00", "ex", [component(C.SESSION_SCORE, qty=4.0)])]
    made = bundles(spark, entries[:20], entries[20:], entries[:7])
    got, want = PRODUCTS["session_report"](made), literal.report(literal.flat(made))
    count = lambda df: Counter(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in want.columns]).collect())
    assert count(got) == count(want)

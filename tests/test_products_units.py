"""Products on hand-made bundles: the edge cases of the definitions."""

import datetime as dt

from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.operators import observations, sample_rows, timed_samples
from equilibra.plans import PRODUCTS
from equilibra.plans.segments import segment_statistics
from tests import literal
from tests.bundles import bundles, component, observation

D1 = "2021-06-01T10:00:00+00:00"
D1_LATER = "2021-06-01T18:00:00+00:00"
D2 = "2021-06-02T10:00:00+00:00"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is None, str(x)) for x in t])


def test_same_day_reports_count_once(spark):
    b = bundles(
        spark,
        [observation("p", D1, "ex", [component(C.DISORIENTATION, flag=True)])],
        [observation("p", D1_LATER, "ex", [component(C.DISORIENTATION, flag=True)])],
        [observation("p", D2, "ex", [component(C.DISORIENTATION, flag=True)])],
    )
    out = PRODUCTS["disorientation_weekly_sum"](b).collect()
    assert [(r["Patient_id"], r["Week"], r["Sum"]) for r in out] == [("p", 22, 2.0)]


def test_null_and_false_flags_both_no(spark):
    b = bundles(
        spark,
        [observation("p", D1, "ex", [component(C.DIZZINESS, flag=None)])],
        [observation("p", D1, "ex", [component(C.DIZZINESS, flag=False)])],
    )
    assert [r["Dizziness"] for r in PRODUCTS["dizziness_reported"](b).collect()] == ["No", "No"]
    assert PRODUCTS["dizziness_weekly_sum"](b).first()["Sum"] == 0.0


def test_all_null_flags_sum_null(spark):
    b = bundles(spark, [observation("p", D1, "ex", [component(C.HEADACHE, flag=None)])])
    assert PRODUCTS["headache_weekly_sum"](b).first()["Sum"] is None


def test_other_session_code_ignored(spark):
    b = bundles(spark, [observation("p", D1, "ex", [component(C.DISORIENTATION, flag=True)], session="9999")])
    assert PRODUCTS["disorientation_weekly_sum"](b).count() == 0


def test_segment_edges_count_twice(spark):
    b = bundles(
        spark,
        [observation("p", D1, "ex", [component(C.RANGE_OF_MOVEMENT, text="x", data="[[[1 2 3]]]", times="[[[0 15000 61000]]]")])],
    )
    row = segment_statistics(b, C.RANGE_OF_MOVEMENT).first()
    assert row["0_15 Mean"] == 1.5  # 0 s and 15 s
    assert row["15_30 Mean"] == 2.0  # 15 s
    assert row["30_45 Mean"] is None and row["45_60 Mean"] is None  # 61 s is outside
    assert row["0_15 STD"] is not None and row["15_30 STD"] is None


def test_segment_key_needs_a_sample_in_first_minute(spark):
    b = bundles(
        spark,
        [observation("p", D1, "ex", [component(C.RANGE_OF_MOVEMENT, text="x", data="[[[1]]]", times="[[[75000]]]")])],
    )
    assert segment_statistics(b, C.RANGE_OF_MOVEMENT).count() == 0


def test_timed_padding(spark):
    b = bundles(
        spark,
        [observation("p", D1, "ex", [component(C.RANGE_OF_MOVEMENT, text="x", data="[[[a 2 3]]]", times="[[[1 2]]]")])],
        [observation("q", D1, "ex", [component(C.RANGE_OF_MOVEMENT, text="x", data=None, times="[[[9]]]")])],
    )
    rows = {(r["Patient_id"], r["data_values"], r["seconds"]) for r in timed_samples(b, C.RANGE_OF_MOVEMENT).collect()}
    assert rows == {("p", None, 1.0), ("p", 2.0, 2.0), ("p", 3.0, None), ("q", None, 9.0)}


def test_sample_rows_drop_missing_text_keep_empty(spark):
    b = bundles(
        spark,
        [observation("p", D1, "ex", [component(C.SPEED_OF_MOVEMENT, text="x", data=None, times="[[[0]]]")])],
        [observation("q", D1, "ex", [component(C.SPEED_OF_MOVEMENT, text="x", data="", times="[[[0]]]")])],
    )
    assert [(r["Patient_id"], r["col"]) for r in sample_rows(b, C.SPEED_OF_MOVEMENT).collect()] == [("q", None)]
    means = PRODUCTS["speed_min"](b).collect()
    assert [(r["Patient_id"], r["Min_value"]) for r in means] == [("q", None)]


def test_duplicate_observations_count_once(spark):
    obs = observation("p", D1, "ex", [component(C.RANGE_OF_MOVEMENT, text="x", data="[[[1 3]]]", times="[[[0 1000]]]")])
    b = bundles(spark, [obs], [obs])
    assert PRODUCTS["range_std"](b).first()["STD_value"] == 2 ** 0.5
    assert segment_statistics(b, C.RANGE_OF_MOVEMENT).first()["0_15 Mean"] == 2.0


def test_observations_match_generic_flatten(spark):
    b = bundles(
        spark,
        [
            observation("p", D1, "ex", [component(C.HEADACHE, flag=True), component(C.DURATION, qty=40)]),
            observation("p", D2, "ex2", [component(C.HEADACHE, flag=False)], session="9999"),
        ],
    )
    cols = [C.PATIENT, C.DATE, C.WEEK, C.START, C.DISPLAY, C.COMPONENT_CODE, C.FLAG, C.QUANTITY]
    codes = [C.HEADACHE, C.DURATION]
    flat = literal.flat(b).filter(F.col(C.COMPONENT_CODE).isin(codes) & (F.col(C.SESSION_CODE) == C.SESSION))
    assert _rows(observations(b, codes).select(*cols).distinct()) == _rows(flat.select(*cols).distinct())


def _report_cases(spark):
    def obs(patient, when, display, *comps, reference=...):
        return observation(patient, when, display, list(comps), reference=reference)

    sampled = dict(text="t1", data="[[[1 2]]]", times="[[[0 1000]]]")
    return bundles(
        spark,
        # two range texts x one speed text, two flags, score + matching duration
        [
            obs(
                "a",
                D1,
                "ex",
                component(C.SPEED_OF_MOVEMENT, **sampled),
                component(C.RANGE_OF_MOVEMENT, **sampled),
                component(C.RANGE_OF_MOVEMENT, text="t2", data="[[[5]]]", times="[[[0]]]"),
                component(C.DISORIENTATION, flag=True),
                component(C.SESSION_SCORE, qty=7),
                component(C.DURATION, qty=30),
                component(C.REPETITIONS, qty=3),
            )
        ],
        # same key, a later session: flag false, a second score, a duration with no score
        [obs("a", D1_LATER, "ex", component(C.DISORIENTATION, flag=False), component(C.SESSION_SCORE, qty=8))],
        [obs("a", "2021-06-01T20:00:00+00:00", "ex", component(C.DURATION, qty=99))],
        # only a duration and reps on another key
        [obs("b", D2, "ex", component(C.DURATION, qty=50), component(C.REPETITIONS, qty=4))],
        # only reps
        [obs("c", D2, "ex", component(C.REPETITIONS, qty=5))],
        # null key parts: no subject reference, null display
        [obs("x", D1, "ex", component(C.HEADACHE, flag=None), component(C.HEADACHE, flag=False), reference=None)],
        [obs("y", D1, None, component(C.SESSION_SCORE, qty=1), component(C.DURATION, qty=2), reference=None)],
        [obs("n", D1, None, component(C.REPETITIONS, qty=6), component(C.SPEED_OF_MOVEMENT, **sampled))],
    )


def test_session_report_equals_literal_join_chain(spark):
    b = _report_cases(spark)
    ours = PRODUCTS["session_report"](b)
    lit = literal.report(literal.flat(b)).select(*ours.columns)
    assert _rows(ours) == _rows(lit)
    assert ours.count() > 8


def test_session_report_columns(spark):
    cols = PRODUCTS["session_report"](_report_cases(spark)).columns
    assert cols == [
        "Patient_id", "Date", C.DISPLAY, "Start_time", "Min_speed", "Max_speed", "Mean_speed",
        "Min_range", "Max_range", "Mean_range", "Disorientation", "Abnormal Vision", "Dizziness",
        "Headache", "Session_score", "Duration", "Total_reps",
    ]


def test_date_and_week_types(spark):
    b = bundles(spark, [observation("p", "2021-01-01T10:00:00+00:00", "ex", [component(C.ABNORMAL_VISION, flag=True)])])
    r = PRODUCTS["vision_reported"](b).first()
    assert r["Date"] == dt.date(2021, 1, 1) and r["Week"] == 53 and r["Abnormal Vision"] == "Yes"

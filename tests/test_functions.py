"""Scalar functions on hand-made values (edge cases of the definitions)."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from equilibra.functions import flag_text, iso_week, parse_float, patient_id, sample_tokens, session_date, start_time


def _one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr(F.col(ddl.split()[0])).alias("r")).first()["r"]


def test_sample_tokens(spark):
    assert _one(spark, sample_tokens, "[[[1 2  3]]]") == ["1", "2", "", "3"]
    assert _one(spark, sample_tokens, "[[[]]]") == [""]
    assert _one(spark, sample_tokens, "") == [""]
    assert _one(spark, sample_tokens, "1 2") == ["1", "2"]
    assert _one(spark, sample_tokens, "[[[1 2]] [[3 4]]]") == ["1", "2]]", "[[3", "4"]
    assert _one(spark, sample_tokens, None) is None


def test_parse_float(spark):
    assert _one(spark, parse_float, "") is None
    assert _one(spark, parse_float, "2.5") == 2.5
    assert _one(spark, parse_float, "x") is None


def test_patient_id(spark):
    assert _one(spark, patient_id, "urn:x") == ""
    assert _one(spark, patient_id, None) is None
    assert _one(spark, patient_id, "http://h/Patient/a/Patient/b") == "a/Patient/b"
    assert _one(spark, patient_id, "Patient/42") == "42"


def test_start_time(spark):
    assert _one(spark, start_time, "2021-06-01T10:00:00+02:00") == "10:00:00+02:00"
    assert _one(spark, start_time, "2021-06-01T10:00:00Z") == ""
    assert _one(spark, start_time, "2021-06-01T10:00:00.123+02:00") == ""
    assert _one(spark, start_time, "2021-06-01T10:00:00-05:00") == ""


def test_session_date(spark):
    assert _one(spark, session_date, "2021-06-01T23:30:00-05:00") == dt.date(2021, 6, 1)
    assert _one(spark, session_date, "garbage") is None


def test_iso_week(spark):
    for day, week in [((2021, 1, 1), 53), ((2020, 12, 31), 53), ((2021, 12, 31), 52), ((2021, 1, 4), 1)]:
        assert _one(spark, iso_week, dt.date(*day), "d date") == week


def test_flag_text(spark):
    assert _one(spark, flag_text, True, "b boolean") == "Yes"
    assert _one(spark, flag_text, False, "b boolean") == "No"
    assert _one(spark, flag_text, None, "b boolean") == "No"


def test_hopeless_tokens_are_not_cast(spark):
    """Whatever the cast reads passes the pattern; words and empty tokens don't reach the cast."""
    from equilibra.functions.columns import MAYBE_FLOAT

    pieces = ["", "1", ".", "e", "-", "+", "n", "nan", "NaN", "inf", "Infinity", "f", "0x", "p", " ", "\t", "\n", "n/a", "İ", "٣"]
    tokens = ["".join(x) for x in itertools.product(pieces, repeat=3)]
    df = spark.createDataFrame([(t,) for t in [*tokens, None]], "t string")
    cast, parsed = F.col("t").try_cast("float"), parse_float("t")
    assert df.filter(cast.isNotNull()).count() > 100 and df.filter(~cast.eqNullSafe(parsed)).count() == 0
    assert df.filter(F.col("t").isin("", "n/a", "-") & F.col("t").rlike(MAYBE_FLOAT)).count() == 0

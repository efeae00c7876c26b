"""The hard fixture notices every missing DISTINCT: without it, registered keys differ from their SQL."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql.classic.dataframe import DataFrame as ClassicDataFrame

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.test_oracle import con  # noqa: F401
from tools.check_oracle import compare

#: A key for each place that de-duplicates.
KEYS = ["hard_vision_weekly_sum", "hard_dizziness_reported", "hard_score_session_sum", "hard_range_std", "hard_range_mean", "hard_segment_mean_speed", "hard_segment_std_range", "hard_session_report"]


@pytest.mark.parametrize("key", KEYS)
def test_without_distinct_the_key_is_red(spark, con, key, monkeypatch):  # noqa: F811
    monkeypatch.setattr(ClassicDataFrame, "distinct", lambda self: self)
    assert issubclass(ClassicDataFrame, DataFrame) and set(KEYS) <= set(entry.HARD)
    res = compare(spark, con, key, SF_SMALL)
    assert not (res["exact"] and res["spark_rows"] == res["oracle_rows"]), key

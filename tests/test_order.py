"""Products are returned ordered by their defined sort column (O1)."""

import pytest

from equilibra.plans import PRODUCTS
from equilibra.sources import load_bundle

SORTED = {
    "disorientation_weekly_sum": "Week",
    "score_session_mean": "Date",
    "score_weekly_mean": "Week",
    "score_session_sum": "Date",
    "score_weekly_sum": "Week",
    "range_mean": "Week",
    "range_std": "Week",
    "speed_weekly_mean": "Week",
    "speed_max": "Week",
}


@pytest.mark.parametrize("name", sorted(SORTED))
def test_sorted(spark, small_bundles, name):
    col = SORTED[name]
    values = [r[col] for r in PRODUCTS[name](load_bundle(spark, small_bundles)).collect()]
    assert len(values) > 10
    assert all(a <= b for a, b in zip(values, values[1:]) if a is not None and b is not None)

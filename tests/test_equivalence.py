"""Rewritten plans against the literal shape, on the sf0.001 fixture."""

import pytest
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.oracle import STD_DIGITS
from equilibra.plans import PRODUCTS
from equilibra.sources import load_bundle
from tests import literal


def _same(a, b):
    cols = a.columns
    b = b.select(*[F.col(f"`{c}`") for c in cols])

    def rounded(df):
        return df.select(
            *[F.round(f"`{c}`", STD_DIGITS).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes]
        )

    a, b = rounded(a), rounded(b)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == b.count()


@pytest.fixture(scope="module")
def bundles(spark, small_bundles):
    return load_bundle(spark, small_bundles)


@pytest.fixture(scope="module")
def flat(bundles):
    return literal.flat(bundles)


@pytest.mark.parametrize("measure", ["range", "speed"])
@pytest.mark.parametrize("stat", ["Mean", "STD", "Min", "Max"])
def test_segments_one_pass_equals_join_chain(bundles, flat, measure, stat):
    code = C.MEASURES[measure]
    ours = PRODUCTS[f"segment_{stat.lower()}_{measure}"](bundles)
    assert _same(ours, literal.segments(flat, code, stat))


MOVEMENT = {
    "range_mean": (C.RANGE_OF_MOVEMENT, literal.KEYS5, "Mean", "Range_of_movement"),
    "range_std": (C.RANGE_OF_MOVEMENT, [C.WEEK, C.DISPLAY, C.TEXT], "STD", "STD_value"),
    "speed_weekly_mean": (C.SPEED_OF_MOVEMENT, [C.PATIENT, C.WEEK, C.DISPLAY], "Mean", "Speed_of_movement"),
    "speed_std": (C.SPEED_OF_MOVEMENT, [C.PATIENT, C.WEEK, C.DISPLAY, C.TEXT], "STD", "STD_value"),
    "speed_max": (C.SPEED_OF_MOVEMENT, literal.KEYS5, "Max", "Max_value"),
}


@pytest.mark.parametrize("name", sorted(MOVEMENT))
def test_moments_equal_exploded_samples(bundles, flat, name):
    code, keys, stat, col = MOVEMENT[name]
    assert _same(PRODUCTS[name](bundles), literal.movement(flat, code, keys, stat, col))


def test_session_report_equals_join_chain(bundles, flat):
    ours = PRODUCTS["session_report"](bundles)
    assert _same(ours, literal.report(flat))

"""Random small bundle sets: rewritten plans equal the literal shape."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.oracle import STD_DIGITS
from equilibra.plans import PRODUCTS
from tests import literal
from tests.bundles import component, observation

TIMES = ["2021-06-01T10:00:00+00:00", "2021-06-01T18:30:00+00:00", "2021-06-08T09:00:00+00:00"]
SAMPLE_MS = [0, 7500, 15000, 30000, 45000, 61000]

flags = st.sampled_from([True, False, None])


@st.composite
def sampled(draw, code):
    n = draw(st.integers(0, 4))
    values = [str(draw(st.integers(0, 9))) for _ in range(n)]
    times = [str(draw(st.sampled_from(SAMPLE_MS))) for _ in range(draw(st.integers(0, 4)))]
    data = draw(st.sampled_from([None, "[[[" + " ".join(values) + "]]]"]))
    return component(code, text=draw(st.sampled_from(["x", "y", None])), data=data, times="[[[" + " ".join(times) + "]]]")


@st.composite
def comp(draw):
    code = draw(st.sampled_from([*C.SYMPTOMS, C.SESSION_SCORE, C.DURATION, C.REPETITIONS, *C.MEASURES.values()]))
    if code in C.SYMPTOMS:
        return component(code, flag=draw(flags))
    if code in C.MEASURES.values():
        return draw(sampled(code))
    return component(code, qty=draw(st.sampled_from([1, 2, None])))


@st.composite
def obs(draw):
    return observation(
        draw(st.sampled_from(["a", "b"])),
        draw(st.sampled_from(TIMES)),
        draw(st.sampled_from(["ex1", "ex2", None])),
        draw(st.lists(comp(), max_size=5)),
        reference=draw(st.sampled_from([..., ..., None])),
    )


def _rows(df):
    df = df.select(*[F.round(f"`{c}`", STD_DIGITS).alias(c) if t in ("double", "float") else F.col(f"`{c}`")
                     for c, t in df.dtypes])
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is None, str(x)) for x in t])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(obs(), min_size=1, max_size=3), min_size=1, max_size=6))
def test_random_bundles(spark, bundle_obs):
    from equilibra.sources.bundles import BUNDLE_SCHEMA

    rows = [{"entry": entries} for entries in bundle_obs]
    rows += rows[:1]  # an exact duplicate bundle
    b = spark.createDataFrame(rows, schema=BUNDLE_SCHEMA)
    flat = literal.flat(b)

    report = PRODUCTS["session_report"](b)
    assert _rows(report) == _rows(literal.report(flat).select(*report.columns))

    for stat in ("Mean", "STD"):
        ours = PRODUCTS[f"segment_{stat.lower()}_range"](b)
        lit = literal.segments(flat, C.RANGE_OF_MOVEMENT, stat).select(*ours.columns)
        # the join form splits a key with a null part across segments; compare full keys
        full = F.col(C.TEXT).isNotNull() & F.col(C.DISPLAY).isNotNull() & F.col(C.PATIENT).isNotNull()
        assert _rows(ours.filter(full)) == _rows(lit.filter(full))

    ours = PRODUCTS["range_std"](b)
    lit = literal.movement(flat, C.RANGE_OF_MOVEMENT, [C.WEEK, C.DISPLAY, C.TEXT], "STD", "STD_value")
    assert _rows(ours) == _rows(lit.select(*ours.columns))

    ours = PRODUCTS["headache_weekly_sum"](b)
    days = literal.coded(flat, C.HEADACHE).select(C.DATE, C.WEEK, C.PATIENT, C.DISPLAY, C.FLAG).distinct()
    lit = days.groupBy(C.PATIENT, C.WEEK, C.DISPLAY).agg(F.sum(F.col(C.FLAG).cast("double")).alias("Sum"))
    assert _rows(ours) == _rows(lit)

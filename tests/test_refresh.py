"""Products from stored state against products of all bundles at once."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from equilibra import codes as C
from equilibra.plans import PRODUCTS
from equilibra.plans.movement import MOVEMENT_PRODUCTS
from equilibra.plans.refresh import _store, compact, refresh, stored_product
from equilibra.plans.scores import SCORE_PRODUCTS
from tests.conftest import SF_SMALL

STORED = [*MOVEMENT_PRODUCTS, *SCORE_PRODUCTS, "dizziness_weekly_sum", "vision_reported"]


def rows(df):
    digits = [F.round(F.col(f"`{c}`"), 9).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes]
    return Counter(map(repr, df.select(digits).collect()))


@pytest.fixture(scope="module")
def state(spark, tmp_path_factory):
    """Three refreshes: most bundles; some of them again with others; the rest, all with late dates."""
    root = str(tmp_path_factory.mktemp("state"))
    at = f"{root}/all"
    entry.hard_bundles(spark, SF_SMALL).withColumn("of", F.pmod(F.xxhash64("entry"), F.lit(5))).write.parquet(at)
    bundles = spark.read.parquet(at)
    for some in ("of < 3", "of in (2, 3)", "of >= 3"):
        refresh(bundles.filter(some).drop("of"), root, grain="yyyy")
    return root, bundles.drop("of")


@pytest.mark.parametrize("name", STORED)
def test_equals_the_whole(spark, state, name):
    root, bundles = state
    assert rows(stored_product(spark, name, root)) == rows(PRODUCTS[name](bundles))


def test_older_versions_stay(spark, state):
    root, bundles = state
    first = stored_product(spark, "range_min", root, version=1)
    assert 0 < first.count() < stored_product(spark, "range_min", root).count()


def test_repeats_add_nothing(spark, state):
    root, bundles = state
    held = {n: sum(r["rows"] for r in _store(spark, root).current(n)) for n in ("seen_samples", "symptom_days", "scores")}
    at = refresh(bundles, root, grain="yyyy")
    assert {n: sum(r["rows"] for r in _store(spark, root).current(n)) for n in held} == held
    new = [r for r in _store(spark, root).current("sample_cells") if r["version"] == at]
    assert sum(r["rows"] for r in new) == 0
    with pytest.raises(ValueError, match="parts"):
        refresh(bundles, root, grain="yyyy-MM")


def test_a_late_date_opens_only_its_part(spark, state):
    root, bundles = state
    store = _store(spark, root)
    new = entry.session_bundles(spark, SF_SMALL).limit(1)
    year = new.select(F.substring(F.col("entry")[0]["resource"]["effectiveDateTime"], 1, 4)).first()[0]
    # The same session a second later: an observation not seen before, with an old date.
    moved = new.withColumn("entry", F.transform("entry", lambda e: e.withField("resource.effectiveDateTime", F.lit(f"{year}-03-03T03:03:03+00:00"))))
    at = refresh(moved, root, grain="yyyy")
    touched = {r["part"] for n in ("seen_samples", "sample_cells", "symptom_days", "scores") for r in store.current(n) if r["version"] == at and r["rows"]}
    assert touched == {f"v{year}"}
    assert rows(stored_product(spark, "range_std", root)) == rows(PRODUCTS["range_std"](bundles.unionByName(moved)))


def test_compacting_changes_no_product(spark, state):
    root, _ = state
    before = {n: rows(stored_product(spark, n, root)) for n in ("speed_std", "score_weekly_sum", "dizziness_weekly_sum")}
    compact(spark, root, 2, grain="yyyy")
    assert {n: rows(stored_product(spark, n, root)) for n in before} == before
    parts = Counter(r["part"] for r in _store(spark, root).current("sample_cells") if r["rows"])
    assert set(parts.values()) == {1}


def test_days_and_scores_share_a_scan(spark, small_bundles):
    from equilibra.plans.refresh import DAYS, SCORES, _days_and_scores
    from equilibra.plans.scores import session_scores
    from equilibra.plans.symptoms import all_symptom_days

    bundles = spark.read.parquet(small_bundles)
    facts = _days_and_scores(bundles)
    assert facts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    days, scores = all_symptom_days(bundles), session_scores(bundles)
    got = facts.filter(F.col(DAYS).isNotNull()).select(*[f"{DAYS}.{c}" if c == C.FLAG else c for c in days.columns])
    assert rows(got) == rows(days)
    got = facts.filter(F.col(SCORES).isNotNull()).select(*[f"{SCORES}.{c}" if c in ("Session_score", C.START) else c for c in scores.columns])
    assert rows(got) == rows(scores)


def test_unseen_rows_meet_by_a_hash(spark, tmp_path):
    """Nulls and NaN are equal to themselves; the join sorts by a hash and one struct."""
    from equilibra.plans.refresh import _unseen
    from equilibra.sources.versions import Store, Write

    store, schema = Store(spark, str(tmp_path)), f"{C.DATE} date, a string, b double"
    values = [(None, None, None), (None, "x", None), (None, None, float("nan")), (None, "x", 0.0)]
    part = F.date_format(C.DATE, "yyyy")
    store.commit([Write("t", spark.createDataFrame(values[:3], schema), "add", part)])
    new = spark.createDataFrame([*values, (None, "y", None)], schema)
    met = _unseen(store, "t", new.hint("merge"), new.columns, True, "yyyy")
    assert rows(met) == rows(spark.createDataFrame([values[3], (None, "y", None)], schema))
    join = next(x for x in met._jdf.queryExecution().sparkPlan().toString().split("\n") if "Join" in x)
    assert join.split("], [")[0].count("xxhash64") == 1 and "coalesce" not in join


def test_what_isn_t_kept(spark, state):
    with pytest.raises(ValueError, match="isn't kept"):
        stored_product(spark, "session_report", state[0])
    with pytest.raises(ValueError, match="never published"):
        stored_product(spark, "range_mean", state[0] + "/nothing")


def test_codes_are_those_of_the_products():
    from equilibra.plans import SYMPTOM_KEYS
    from equilibra.plans.refresh import SYMPTOM_CODES

    assert SYMPTOM_CODES == SYMPTOM_KEYS and set(SYMPTOM_CODES.values()) == set(C.SYMPTOMS)

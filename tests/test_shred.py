"""Shredded tables against the generic flatten, on made-up and on derived bundles."""

from collections import Counter

import pytest

import __spark_entry__ as entry
from equilibra.operators import flatten_nested
from equilibra.operators.shred import flat, shred, sizes, write_shredded
from tests.conftest import SF_SMALL

ODD = "a int, b struct<c: string, d: array<struct<e: int, f: array<string>>>>, g: array<array<int>>, h array<int>, m map<string, int>"
ROWS = [
    (1, ("x", [(1, ["p", "q"]), (2, []), (3, None)]), [[1, 2], [], None, [3]], [7, 8, 9], {"k": 1}),
    (2, ("y", []), None, None, None),
    (3, None, [], [], {}),
    (None, (None, [None, (4, [None])]), [[None]], [None], None),
]


def rows(df):
    return Counter(repr(tuple(r)) for r in df.collect())


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(ROWS, ODD)


def test_join_is_the_flat_form(odd, tmp_path):
    want = flatten_nested(odd)
    for tables in (shred(odd, str(tmp_path / "a")), write_shredded(shred(odd, str(tmp_path / "b")), str(tmp_path / "c"))):
        assert rows(flat(tables).select(want.columns)) == rows(want)


def test_some_columns_multiply_nothing_else(odd, tmp_path):
    tables = shred(odd, str(tmp_path / "a"))
    assert flat(tables, ["a"]).count() == 4
    assert rows(flat(tables, ["a", "h"])) == rows(flatten_nested(odd.select("a", "h")))
    assert rows(flat(tables, ["b_d_f", "a"])) == rows(flatten_nested(odd.select("a", "b.d")).selectExpr("d_f as b_d_f", "a"))
    with pytest.raises(ValueError, match="no table has"):
        flat(tables, ["nope"])


def test_rows_are_linear_in_elements(odd, spark, tmp_path):
    got = {r["path"]: r["rows"] for r in sizes(spark, shred(odd, str(tmp_path / "a"))).collect()}
    assert got[""] == 4 and got["h"] == 4 and got["b_d"] == 5 and got["b_d_f"] == 3 and sorted(got.values()) == [3, 4, 4, 4, 5, 5]


def test_derived_bundles(spark, tmp_path):
    bundles = entry.session_bundles(spark, SF_SMALL).limit(200)
    want = flatten_nested(bundles)
    tables = write_shredded(shred(bundles, str(tmp_path / "a")), str(tmp_path / "b"))
    got = flat(tables).select(want.columns)
    assert got.count() == want.count() and rows(got) == rows(want)
    # Siblings are met by no plan that doesn't ask for them.
    some = flat(tables, ["entry_resource_subject_reference", "entry_resource_component_valueBoolean"])
    assert not any("category" in f or "code_coding" in f for f in some.inputFiles())


def test_names_that_clash(spark, tmp_path):
    df = spark.createDataFrame([((1,), 2)], "a struct<b: int>, a_b int")
    with pytest.raises(ValueError, match="twice"):
        shred(df, str(tmp_path / "a"))


def test_tables_are_not_broadcast(spark, tmp_path):
    """Tables grow with the elements, so the driver holds none of them, however small it looks."""
    tables = write_shredded(shred(entry.session_bundles(spark, SF_SMALL), f"{tmp_path}/numbered"), f"{tmp_path}/tables")
    plans = []
    for frame in (flat(tables), entry.session_bundles(spark, SF_SMALL), entry.hard_bundles(spark, SF_SMALL)):
        frame.collect()
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
    assert not any("Broadcast" in p for p in plans)


def shuffled(plan):
    """Rows that each exchange of an executed plan wrote."""
    kind, below = plan.getClass().getSimpleName(), plan.children()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    own = [plan.metrics().get("shuffleRecordsWritten").get().value()] if kind == "ShuffleExchangeExec" else []
    return own + [n for i in range(below.size()) for n in shuffled(below.apply(i))]


def test_products_of_siblings_are_not_shuffled(spark, tmp_path):
    """40 bundles of 30 x 20 x 2 rows: what is shuffled is linear in the elements."""
    row = [(i, [(list(range(30)), [(k, [k, -k]) for k in range(20)])]) for i in range(40)]
    nested = spark.createDataFrame(row, "a int, b array<struct<s: array<int>, t: array<struct<v: int, u: array<int>>>>>")
    got = flat(write_shredded(shred(nested, str(tmp_path / "a")), str(tmp_path / "b")))
    want = flatten_nested(nested)
    assert rows(got.select(want.columns)) == rows(want)
    assert got.count() == 48_000
    got.collect()
    moved = shuffled(got._jdf.queryExecution().executedPlan())
    assert moved and max(moved) <= 40 * 20 * 2  # the elements of the largest array; 24,000 with the siblings multiplied first

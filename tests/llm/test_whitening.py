"""Whitening against numpy on whole tables, and its edge cases."""

import numpy as np
import pytest
from pyspark.errors import PySparkException

from equilibra.llm import whitening
from equilibra.llm.queries import queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, at int, x string, v int"


def brute(rows, components=16):
    """(x of usable rows, fit size, deviations, whitened up to sign, shares)."""
    kept = [(r["vec_id"], [int(np.floor(64 * float(c))) + 1_000_000 for c in r["embedding"]]) for r in rows if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    x = np.array([v for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = (n * fit - s) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-12 * values.max()]
    return kept, n, ((n * x - s) ** 2).sum(1), (n * x - s) / n @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def same(got, rows, components=16):
    kept, n, deviation, z, shares = brute(rows, components)
    k = z.shape[1]
    assert len(got) == len(kept) * k and set(got.n) == {n} and got.identity_error.max() < 1e-9
    wide = got.pivot_table(index="vec_id", columns="component", values="whitened").sort_index()
    order = np.argsort([i for i, _ in kept])
    sign = np.sign((wide.to_numpy() * z[order]).sum(0))
    assert np.abs(wide.to_numpy() * sign - z[order]).max() < 1e-8
    first = got[got.component == 1].set_index("vec_id").deviation
    assert first.loc[wide.index].tolist() == deviation[order].tolist()
    assert np.allclose(got.groupby("component").explained.first().to_numpy(), shares, rtol=1e-9)


def test_whole_table_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    same(queries()["op11_whitening"](spark, SF).toPandas(), rows)


def test_nulls_copies_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(40, 3)).astype(np.float32).tolist()
    rows = [(k, v, k, "a", 1) for k, v in enumerate(vectors)] + [(100 + k, vectors[0], 0, None, None) for k in range(60)]
    odd = [(900, None, 1, "b", 2), (901, [1.0, None, 2.0], 1, "b", 2), (902, [float("nan"), 1.0, 2.0], 1, "b", 2), (903, [float("-inf"), 1.0, 2.0], 1, "b", 2), (904, [], 1, "b", 2)]
    frame = spark.createDataFrame(rows + odd, SCHEMA)
    got = whitening.whiten(frame).toPandas()
    same(got, frame.collect())
    assert got.vec_id.nunique() == 100 and set(got.component) == {1, 2, 3}
    assert whitening.whiten(frame, components=2).filter("component > 2").isEmpty()


def test_what_has_no_components(spark):
    same_vector = spark.createDataFrame([(1, [1.0, 2.0], 0, "", 0)] * 3, SCHEMA)
    assert whitening.whiten(same_vector).count() == whitening.whiten(same_vector.limit(0)).count() == 0
    with pytest.raises(ValueError, match="widths"):
        whitening.whiten(spark.createDataFrame([(1, [1.0], 0, "", 0), (2, [1.0, 2.0], 0, "", 0)], SCHEMA))
    with pytest.raises(PySparkException, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30], 0, "", 0), (2, [1.0], 0, "", 0)], SCHEMA))


def test_ids_may_repeat(spark):
    rows = [(None, [0.0, 1.0], 0, "", 0), (None, [3.0, 1.0], 0, "", 0), (7, [0.0, -2.0], 0, "", 0), (7, [0.0, -2.0], 0, "", 0)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert len(got) == 8 and set(got.n) == {3} and got.vec_id.isna().sum() == 4


def test_split_products_add_up(spark, monkeypatch):
    """The scatter from many parts, as on a large table."""
    monkeypatch.setattr(whitening, "TASK_BYTES", 4096)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    same(whitening.whiten(rows).toPandas(), rows.collect())

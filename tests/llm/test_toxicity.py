"""Toxic passages: segments against brute force, planted passages, held-out accuracy, edge cases."""

import math
import zlib

import numpy as np

from equilibra.llm import toxicity
from equilibra.llm.queries import queries

SF = "/root/testdata/sf0.01"


def brute_segments(x):
    """Maximal segments by their definition: the best stretch, then the same on both sides of it."""

    def find(a, b):
        best, at = 1e-12, None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += x[j]
                if total > best + 1e-12:
                    best, at = total, (i, j + 1)
        return [*find(a, at[0]), at, *find(at[1], b)] if at else []

    return find(0, len(x))


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(1)
    for _ in range(400):
        x = rng.normal(size=rng.integers(0, 30)) - rng.uniform(0, 0.6)
        got = toxicity.maximal_segments(x)
        assert [(a, b) for a, b, _ in got] == brute_segments(x)
        assert all(math.isclose(s, x[a:b].sum(), abs_tol=1e-9) for a, b, s in got)


def test_constants_of_extreme_values_come_back():
    rng = np.random.default_rng(2)
    n = rng.integers(50, 5000, 20_000).astype(float)
    best = -np.log(rng.exponential(size=len(n)) / (0.03 * n)) / 1.4
    decay, scale = toxicity.extreme_values(np.maximum(best, 0), n, np.ones(len(n)))
    assert abs(decay - 1.4) < 0.05 and abs(scale - 0.03) < 0.005


def test_evidence_grows_with_passages():
    one, three = toxicity.evidence(np.array([6.0]), 200, 1.3, 0.02), toxicity.evidence(np.array([6.0] * 3), 200, 1.3, 0.02)
    assert three > one > toxicity.evidence(np.array([2.0]), 200, 1.3, 0.02) > toxicity.evidence(np.array([]), 200, 1.3, 0.02)


def planted(rng, toxic):
    text = [f"w{k}" for k in rng.zipf(1.3, 120) % 900]
    if toxic:
        at = int(rng.integers(0, 100))
        text[at : at + 8] = [f"vile{k % 9}x" for k in rng.integers(0, 9, 8)]
    return " ".join(text)


def test_planted_passages_are_found_where_they_are(spark):
    rng = np.random.default_rng(3)
    rows = [(k, planted(rng, k % 5 == 0), int(k % 5 == 0), "t", 1.0) for k in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int, label string, evidence double")
    labels = frame.select("doc_id", "toxic")
    docs = frame.drop("toxic")
    got = toxicity.classify(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert held.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id]
    assert (held.predicted == held.toxic).all() and held.score.between(0, 1).all()
    model = toxicity.learn(docs, labels)
    found = toxicity.significant(toxicity.passages(docs, model), model).toPandas()
    texts = dict((r[0], r[1].split()) for r in rows)
    hits = [r for r in found.itertuples() if r.doc_id % 5 == 0 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(hits) >= len(held[held.toxic == 1])
    inside = [w.startswith("vile") for r in hits for w in texts[r.doc_id][r.start : r.end]]
    assert np.mean(inside) > 0.9


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries()["op13_toxicity"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    mine = got.join(labels, "doc_id").filter("held_out").toPandas()
    assert (mine.predicted == mine.toxic).mean() > 0.93
    assert mine[mine.toxic == 0].predicted.mean() < 0.03


def test_held_out_labels_are_not_read(spark):
    """Turning the held-out labels round changes no score."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "quality", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.classify(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "..."), (None, "a b"), (4, "vile " * 50_000), (4, "vile"), (5, "É\x00ÀB")]
    docs = spark.createDataFrame([(*r, 1, "l") for r in rows], "doc_id long, text string, n_tokens int, label string")
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (2, None), (None, 1), (1, 0)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in toxicity.classify(docs, labels.filter("doc_id = 5")).collect()} == {0.0}
    assert toxicity.classify(docs.limit(0), labels).count() == 0

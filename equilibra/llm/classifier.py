"""Quality classifier: regularised quadratic discriminant analysis.

One pass turns each whole text into transformed statistics (logarithms of sizes, roots of
shares), kept as a small table. Labelled rows outside the held-out fold give
count, sums and cross-products per class, as partial aggregates in Spark: the driver sees two rows.
Class covariances are shrunk towards the pooled one and its diagonal; a text's score is the
logistic of the difference of the classes' log densities (Mahalanobis distances
by Cholesky factors that are computed once) and log shares. Neither labels nor
lang, source or doc_id are inputs of a score.

Defined cases: null text counts as empty and gets a score like others. Labels
that are null or not 0 or 1 are ignored, of several labels of a doc_id the
largest counts. If a class has no labelled row, the score is the share of the
other's label (0.5 without any). Null doc_ids belong to the fold of the empty string.
Repeated rows are scored each. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra.llm import _text
from equilibra.llm._work import cells, run_dir, saved

FOLDS, CUT = 5, 0.3
FEATURES = ", ".join(f"{c} double" for c in _text.STATISTICS)


@dataclass
class Discriminant:
    """Two Gaussian classes; ``factors`` are the Cholesky factors of their covariances."""

    means: np.ndarray
    factors: np.ndarray
    log_shares: np.ndarray
    constant: float | None = None

    @classmethod
    def fit(cls, counts: np.ndarray, sums: np.ndarray, products: np.ndarray, shrink: float = 0.2, diagonal: float = 0.2, ridge: float = 1e-3) -> Discriminant:
        """counts (2), sums (2 x d) and cross-products (2 x d x d) by class.

        shrink: share of the pooled covariance in each class's; diagonal: share
        of its diagonal in the pooled one; ridge: share of each feature's variance added.
        """
        width, total = sums.shape[1], counts.sum()
        if (counts == 0).any():
            return cls(np.zeros((2, width)), np.zeros((2, width, width)), np.zeros(2), 0.5 if not total else float(counts[1] > 0))
        means = sums / counts[:, None]
        scatter = products - counts[:, None, None] * means[:, :, None] * means[:, None, :]
        pooled = scatter.sum(0) / total
        spread = np.diag(np.maximum(np.diag(pooled), 1e-9))
        pooled = (1 - diagonal) * pooled + diagonal * spread
        shrunk = [(1 - shrink) * s / n + shrink * pooled + ridge * spread for s, n in zip(scatter, counts, strict=True)]
        return cls(means, np.array([np.linalg.cholesky(c) for c in shrunk]), np.log(counts / total))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logs = []
        for mean, factor, share in zip(self.means, self.factors, self.log_shares, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(share - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(0))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics...) of each row."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = [(doc, *_text.statistics(text or "")) for doc, text in cells([batch], "doc_id", "text")]
            if rows:
                ids, *columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.float64()) for c in columns)], names=["doc_id", *_text.STATISTICS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {FEATURES}")


def fold():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS


def fit(table: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on the labelled rows outside fold 0; all of them."""
    names = _text.STATISTICS
    marked = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("label"))
    rows = table.join(marked.filter(fold() != 0), "doc_id")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.array(*(F.sum(c) for c in names)).alias("s"), F.array(*(F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs)).alias("p"))
    counts, first, second = np.zeros(2), np.zeros((2, len(names))), np.zeros((2, len(names), len(names)))
    for r in sums.collect():
        k = int(r["label"])
        counts[k], first[k] = r["n"], r["s"]
        for (i, j), value in zip(pairs, r["p"], strict=True):
            second[k, i, j] = second[k, j, i] = value
    return Discriminant.fit(counts, first, second)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    table = saved(statistics(docs), f"{run_dir(docs.sparkSession, 'classifier')}/statistics")
    model = fit(table, labels)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if len(batch):
                x = np.column_stack([batch.column(c).to_numpy() for c in _text.STATISTICS])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x))], names=["doc_id", "score"])

    scored = table.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))

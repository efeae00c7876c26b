"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values.

1. Log-odds. Labelled training documents give, per token and per prefix of a token, how
   many stand in toxic and in other documents. Priors are Dirichlet distributions over the two
   classes, each centred on what the next shorter prefix gives (at the end: on all
   tokens), so a token never seen leans on its family and a rare one doesn't decide.
   Counts live in a table of fixed size, whose cells are hashes of prefixes.
2. Segments. Log-odds less a constant are a token's score. One pass over a document
   (Ruzzo and Tompa's algorithm, on runs of equal sign) yields all its maximal segments:
   disjoint passages that no shift of an end improves.
3. Calibration. In clean text the best segment of n tokens exceeds x with probability
   1 - exp(-K n exp(-lambda x)). Both constants are fitted by maximum likelihood on the
   training documents without the label; a passage is significant if K n exp(-lambda x)
   is at most ``significance``. A document's evidence is how improbable its r best
   passages are together, for the r that tells most; a logistic curve, fitted
   on training documents (each scored as if it had not been counted), makes it the score.

Training rows: all labelled rows outside the held-out fold, no sample. Neither labels nor lang,
source or doc_id are inputs of a score. The driver holds the count table (fixed
size) and histograms of segment scores and evidence (rounded, within fixed bounds).

Defined cases: null text counts as empty and gets a score like others. Labels that
are null or not 0 or 1 are ignored, of several labels of a doc_id the largest counts; without
both labels every score is the share of toxic labels (0.5 without any). Null doc_ids belong to the fold of
the empty string. Repeated rows are scored each. An empty table gives no rows. Very
long texts are read whole. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equilibra.llm._work import run_dir, saved

FOLDS, CUT = 5, 0.5
PREFIXES = (4, 6, 8)  #: bytes of the prefixes that a token leans on, shortest first
CELL_BITS = 20
PRIOR = 2.0  #: tokens that a prior is worth
DRIFT = 1.0  #: what a token costs, so that passages end where evidence does
SEGMENTS = "doc_id long, n_tokens long, starts array<int>, ends array<int>, scores array<double>"
#: Byte table: ASCII but letters and digits to the space.
PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(PLAIN).split()


def cells(words: list[bytes]) -> np.ndarray:
    """(words x levels): the cells of each token's prefixes and of itself, shortest first."""
    crc, mask = zlib.crc32, (1 << CELL_BITS) - 1
    levels = [[crc(w[:k], k) for w in words] for k in PREFIXES] + [list(map(crc, words))]
    return np.array(levels, np.int64).T.reshape(-1, len(PREFIXES) + 1) & mask


def batched(texts: list[str | None], room: int = 2_000_000) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(place of the first, tokens of each) of texts, some at a time: ``room`` characters, or one text."""
    held, first, size = [], 0, 0
    for k, text in enumerate(texts):
        if held and size + len(text or "") > room:
            yield first, held
            held, first, size = [], k, 0
        held.append(tokens(text))
        size += len(text or "")
    if held:
        yield first, held


class LogOdds:
    """Scores of tokens: log-odds less the drift."""

    def __init__(self, toxic: np.ndarray, other: np.ndarray, totals: tuple[float, float]):
        self.toxic, self.other = toxic, other
        self.base = (totals[0] + 0.5) / (sum(totals) + 1.0)

    def _scores(self, places: np.ndarray, label: int | None = None) -> np.ndarray:
        """By rows of cells; with a label, as if one text of it had not been counted."""
        rate = np.full(len(places), self.base)
        for level in places.T:
            t, o = self.toxic[level].astype(float), self.other[level].astype(float)
            if label is not None:
                t, o = (np.maximum(t - 1, 0), o) if label else (t, np.maximum(o - 1, 0))
            rate = (t + PRIOR * rate) / (t + o + PRIOR)
        return np.log(rate / (1 - rate)) - math.log(self.base / (1 - self.base)) - DRIFT

    def of(self, texts: list[list[bytes]], labels: list[int] | None = None) -> Iterator[np.ndarray]:
        """The scores of each text's tokens, in order; of training texts (with their labels) as if
        the text had not been counted. The k-th time a token speaks for toxicity, it counts a k-th."""
        number: dict[bytes, int] = {}
        for words in texts:
            for w in words:
                if w not in number:
                    number[w] = len(number)
        places = cells(list(number))
        known = None if labels else self._scores(places)
        for k, words in enumerate(texts):
            ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            if known is None:
                own, back = np.unique(ids, return_inverse=True)
                out = self._scores(places[own], labels[k])[back]
            else:
                out = known[ids]
            up = np.flatnonzero(out > 0)
            mine = ids[up]
            if len(mine) > 1:
                order = np.argsort(mine, kind="stable")
                same = mine[order]
                first = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
                times = np.arange(len(same)) - np.repeat(first, np.diff(np.r_[first, len(same)])) + 1
                out[up[order]] /= times
            yield out


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal scoring segments, in order; linear time.

    Runs of scores that are above zero, or are not, are single steps of the search.
    """
    if not len(scores):
        return []
    up = scores > 0
    at = np.flatnonzero(np.r_[True, up[1:] != up[:-1]])
    sums = np.add.reduceat(scores, at).tolist()
    ends = [*at[1:].tolist(), len(scores)]
    found: list[tuple[int, int, float, float]] = []  # start, end, total before, total after
    total = 0.0
    for start, end, gain in zip(at.tolist(), ends, sums, strict=True):
        before, total = total, total + gain
        if gain <= 0:
            continue
        # Walk back to the nearest candidate that begins lower; join with it if it ends lower too.
        # Candidates between them begin no lower than the new one, so each is passed for good.
        piece = (start, end, before, total)
        chain = found
        while True:
            j = len(chain) - 1
            while j >= 0 and chain[j][2] >= piece[2]:
                j = _link(chain, j)
            if j < 0 or chain[j][3] >= piece[3]:
                break
            piece = (chain[j][0], piece[1], chain[j][2], piece[3])
            del chain[j:]
        chain.append((*piece, j))
    return [(s, e, b - a) for s, e, a, b, _ in found]


def _link(chain: list, j: int) -> int:
    """Of a candidate: the nearest earlier one that begins lower (kept when it was added)."""
    return chain[j][4]


@dataclass
class Model:
    toxic: np.ndarray
    other: np.ndarray
    totals: tuple[float, float]
    decay: float = 1.0  #: lambda
    scale: float = 1.0  #: K
    curve: tuple[float, float] = (0.0, 1.0)  #: of the evidence's logistic curve
    constant: float | None = None  #: the score of all, where labels don't tell


def fold() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS


#: Labelled rows (16 bytes each) that are broadcast to the texts at most; beyond it both sides are shuffled.
BROADCAST_LABELS = 4_000_000


def training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the labelled rows outside the held-out fold."""
    marked = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    marked = marked.filter(fold() != 0)
    few = labels.count() <= BROADCAST_LABELS
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marked) if few else marked, "doc_id")


def count_tokens(rows: DataFrame) -> DataFrame:
    """(cell, label, n): different tokens of each text, per cell of their prefixes and themselves,
    and in all (cell -1). A token counts once a text, however often the text repeats it."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts = np.zeros((2, 1 << CELL_BITS), np.int64)
        totals = [0, 0]
        for batch in batches:
            labels = batch.column("label").to_pylist()
            for first, texts in batched(batch.column("text").to_pylist()):
                for label in (0, 1):
                    often = Counter(w for words, y in zip(texts, labels[first:], strict=False) if y == label for w in set(words))
                    if often:
                        times = np.fromiter(often.values(), np.int64, len(often))
                        np.add.at(counts[label], cells(list(often)), times[:, None])
                        totals[label] += int(times.sum())
        for label in (0, 1):
            some = np.flatnonzero(counts[label])
            n = np.r_[counts[label][some], totals[label]]
            yield pa.record_batch([pa.array(np.r_[some, -1]), pa.array(np.full(len(n), label, np.int32)), pa.array(n)], names=["cell", "label", "n"])

    parts = rows.select("label", "text").mapInArrow(run, "cell long, label int, n long")
    return parts.groupBy("cell", "label").agg(F.sum("n").alias("n"))


def count_table(rows: DataFrame) -> Model:
    """The counts, on the driver: two arrays of fixed size."""
    arrays, totals = np.zeros((2, 1 << CELL_BITS), np.float32), [0.0, 0.0]
    table = count_tokens(rows).toArrow()
    cell, label, n = (table.column(c).to_numpy() for c in ("cell", "label", "n"))
    for k in (0, 1):
        mine = label == k
        arrays[k][cell[mine & (cell >= 0)]] = n[mine & (cell >= 0)]
        totals[k] = float(n[mine & (cell < 0)].sum())
    return Model(arrays[1], arrays[0], (totals[1], totals[0]))


def passages(docs: DataFrame, model: Model, labels: bool = False) -> DataFrame:
    """SEGMENTS rows: per row of ``docs`` its tokens and all its maximal segments.

    labels: the rows are training rows; each is scored as if it had not been counted,
    so that what is fitted on them holds for new documents, and ``label`` is handed on.
    """
    schema = SEGMENTS + ", label int" * labels
    held = docs.sparkSession.sparkContext.broadcast((model.toxic, model.other, model.totals))  # fixed size: 8 MB

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        odds = LogOdds(*held.value)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int32()]
        names = [x.split()[0] for x in schema.split(", ")]
        rows, size = [], 0
        for batch in batches:
            ids, given = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist() if labels else None
            for first, texts in batched(batch.column("text").to_pylist()):
                for k, scores in enumerate(odds.of(texts, given[first : first + len(texts)] if given else None), first):
                    found = maximal_segments(scores)
                    rows.append((ids[k], len(scores), *([x[j] for x in found] for j in range(3)), *([given[k]] if given else [])))
                    size += 1 + len(found)
                    if size > 50_000:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)], names=names)
                        rows, size = [], 0
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(["label"] if labels else [])).mapInArrow(run, schema)


def extreme_values(score: np.ndarray, n: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """(lambda, K) by maximum likelihood; a score of 0 means: no segment above 0."""
    found = score > 0
    if not times[found].sum():
        return 1.0, 1.0 / max(1.0, float((n * times).sum()))

    def fit(decay: float) -> tuple[float, float]:
        load = float((times * n * np.exp(-decay * score)).sum())
        m = float(times[found].sum())
        scale = m / load
        return m * (math.log(scale) + math.log(decay)) - decay * float((times * score)[found].sum()) - scale * load, scale

    low, high = 0.05, 5.0
    for _ in range(80):
        a, b = high - 0.618 * (high - low), low + 0.618 * (high - low)
        low, high = (low, b) if fit(a)[0] > fit(b)[0] else (a, high)
    decay = (low + high) / 2
    return decay, fit(decay)[1]


def logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope by Newton's method; the classes as often as they occur."""
    w = np.zeros(2)
    X = np.column_stack([np.ones(len(x)), x])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -500, 500)))
        slope = X.T @ (times * (y - p)) - ridge * w
        curve = (X * (times * p * (1 - p))[:, None]).T @ X + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w + step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def evidence(scores: np.ndarray, n_tokens: int, decay: float, scale: float) -> float:
    """How far a document's passages are from clean text: the largest, over r, -log of the
    probability that r passages together are this good.

    With normalised scores (lambda x - log K n) the sum t of the r best exceeds its value
    with probability exp(-t) t**(r-1) / (r! (r-1)!) in clean text. Below zero: the best passage.
    """
    floor = math.log(scale * max(1, n_tokens))
    if not len(scores):
        return -floor
    normal = decay * np.sort(scores)[::-1] - floor
    r = np.arange(1, len(normal) + 1)
    t = np.cumsum(normal)
    ways = np.cumsum(np.log(r))  # log r!
    valid = t > np.maximum(r - 1, 1e-9)
    if not valid.any():
        return float(normal[0])
    r, t, ways = r[valid], t[valid], ways[valid]
    return float((t - (r - 1) * np.log(t) + 2 * ways - np.log(r)).max())


def with_evidence(found: DataFrame, model: Model, significance: float, label: bool = False) -> DataFrame:
    """(doc_id, evidence, passages) of SEGMENTS rows; passages are the significant ones."""
    decay, scale = model.decay, model.scale
    extra = ["label"] if label else []

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            told, strong = [], []
            for n, x in zip(batch.column("n_tokens").to_pylist(), batch.column("scores"), strict=True):
                own = x.values.to_numpy(zero_copy_only=False)
                told.append(evidence(own, n, decay, scale))
                strong.append(int((scale * n * np.exp(-decay * own) <= significance).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(told, pa.float64()), pa.array(strong, pa.int64()), *(batch.column(c) for c in extra)], names=["doc_id", "evidence", "passages", *extra])

    return found.select("doc_id", "n_tokens", "scores", *extra).mapInArrow(run, "doc_id long, evidence double, passages long" + ", label int" * label)


#: Steps and bounds of the histograms that reach the driver.
FINE, WIDEST = 0.05, 25.0


def learn(docs: DataFrame, labels: DataFrame, significance: float = 0.05) -> Model:
    """Fit counts, extreme-value constants and the curve on the training rows."""
    base = run_dir(docs.sparkSession, "toxicity")
    rows = saved(training(docs, labels), f"{base}/training")
    model = count_table(rows)
    seen = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(seen) < 2:
        model.constant = 0.5 if not seen else float(1 in seen)
        return model
    marked = saved(passages(rows, model, labels=True), f"{base}/segments")
    best = F.least(F.coalesce(F.array_max("scores"), F.lit(0.0)), F.lit(WIDEST))
    clean = marked.filter("label = 0 and n_tokens > 0").groupBy((F.ceil(best / FINE) * FINE).alias("s"), F.round(F.log2("n_tokens") * 4).alias("n")).count().toPandas()
    if len(clean):
        model.decay, model.scale = extreme_values(clean.s.to_numpy(float), 2 ** (clean.n.to_numpy(float) / 4), clean["count"].to_numpy(float))
    own = F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), F.col("evidence")))
    bins = with_evidence(marked, model, significance, label=True).groupBy(F.round(own / FINE).alias("e"), "label").count().toPandas()
    model.curve = logistic(bins.e.to_numpy(float) * FINE, bins.label.to_numpy(float), bins["count"].to_numpy(float))
    return model


def significant(found: DataFrame, model: Model, significance: float = 0.05) -> DataFrame:
    """One row per significant passage: doc_id, start and end (tokens), score, expected (number
    of passages this good in a clean document of the length)."""
    rows = found.select("doc_id", "n_tokens", F.explode(F.arrays_zip("starts", "ends", "scores")).alias("p"))
    expected = F.lit(model.scale) * F.col("n_tokens") * F.exp(F.lit(-model.decay) * F.col("p.scores"))
    return rows.select("doc_id", F.col("p.starts").alias("start"), F.col("p.ends").alias("end"), F.col("p.scores").alias("score"), expected.alias("expected")).filter(F.col("expected") <= significance)


def classify(docs: DataFrame, labels: DataFrame, significance: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, passages (significant ones)."""
    model = learn(docs, labels, significance)
    found = with_evidence(passages(docs, model), model, significance)
    a, b = model.curve
    odds = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.lit(a) + F.lit(b) * F.col("evidence")))
    score = F.lit(model.constant) if model.constant is not None else 1 / (1 + F.exp(-odds))
    return found.select("doc_id", (fold() == 0).alias("held_out"), score.alias("score"), (score >= CUT).cast("int").alias("predicted"), "passages")

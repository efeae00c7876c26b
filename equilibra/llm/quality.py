"""Quality rules: a linear-chain conditional random field labels lines.

Each line with a word gets features (length, symbols, capitals, repeats in the text, ...).
The field has a weight per feature and one per pair of neighbouring labels;
Viterbi decoding marks every line as content or boilerplate, and a document is kept if
its content lines hold at least three tenths of its words. Base rules come first: texts
of under ten words, or with more than a fifth of the words in repeated
five-word windows, are rejected.

Labels change inside documents: a line that many documents hold among changing
neighbours (``common_lines``) is boilerplate also in a good document. The weights
are learnt by maximum likelihood: in documents that ``labels.quality`` marks 1, common
lines are boilerplate and the others content; in those marked 0 all are boilerplate.
Sample: at most ``sample`` labelled documents (by a hash of doc_id, none of the held-out
fold), of each at most ``STRETCHES`` stretches of 64 lines, evenly spread; the classes
count equally. Without both classes the field is neutral, and only the base rules
decide. Everything else covers all rows. ``judge`` shuffles no texts, only keys, scores and
sizes of lines; ``keep`` shuffles its rows once. Common lines, which grow with the corpus, are joined.

Defined cases: null text has no words (rejected). Null or repeated doc_ids are
judged row by row. Lines without a word are neither label. Empty tables give no
rows. ``keep`` returns all columns of its input. Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equilibra.llm import _text
from equilibra.llm._work import bit_words, bits_for, cells, packed, run_dir, saved, tidy

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LABELS = 2  # 0 boilerplate, 1 content
COLUMNS = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, content_words long"
#: Beside COLUMNS, of texts that wait for a look-up: hash, keys that may be common, their places, lines' scores and sizes.
PENDING = "t binary, keys array<long>, places binary, scores binary, sizes binary"
STRETCH, STRETCHES = 64, 8
#: Content lines must hold this share of a document's words: on labelled documents outside the
#: held-out fold, half instead of 0.3 loses good short texts below notices, and finds no more bad ones.
LEAST = 0.3


class Common:
    """The common lines: a stored table of their keys (``h``), as many as the corpus has, and a
    bit table of bounded size that passes all of them and few others."""

    def __init__(self, keys: DataFrame | None = None):
        self.keys, self.size = keys, 0 if keys is None else keys.count()
        self.bits = bits_for(self.size)
        self.words = np.zeros(1 << (self.bits - 6), np.uint64)
        if self.size:
            rows = bit_words(keys, self.bits).collect()  # at most 2**20
            self.words[[r["__word"] for r in rows]] = np.array([r["__bits"] for r in rows], np.int64).view(np.uint64)

    def __len__(self) -> int:
        return self.size


def _hits(h: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    """Places of the keys that may be common."""
    top = h.view(np.uint64) >> np.uint64(64 - bits)
    return np.flatnonzero((words[(top >> np.uint64(6)).astype(np.int64)] >> (top & np.uint64(63))) & np.uint64(1))


def _keys(text: str | None) -> list[int]:
    return [_text.line_key(x) for x in (text or "").split("\n") if x.strip(_text.BLANKS)]


class Field:
    """Weights of the field: ``lines`` (features) favours content, ``pairs`` (2 x 2) neighbours;
    ``common``: the common lines."""

    def __init__(self, lines: np.ndarray, pairs: np.ndarray, common: Common | None = None):
        self.lines, self.pairs = lines, pairs
        self.common = Common() if common is None else common

    def known(self) -> frozenset[int]:
        """All common lines, on the driver: for a look at small corpora. ``judge`` and ``keep`` join them."""
        return frozenset() if self.common.keys is None else frozenset(r["h"] for r in self.common.keys.collect())

    @classmethod
    def neutral(cls) -> Field:
        return cls(np.zeros(len(_text.LINE_FEATURES)), np.zeros((LABELS, LABELS)))

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels of a text's lines (a tie is content)."""
        return self.decode(features @ self.lines)

    def decode(self, score: np.ndarray) -> np.ndarray:
        """The same from the lines' scores."""
        best, back = np.array([0.0, score[0]]), np.zeros((len(score), LABELS), np.int8)
        (aa, ab), (ba, bb) = self.pairs.tolist()
        x, y = best.tolist()
        for t, s in enumerate(score[1:].tolist(), 1):
            back[t] = y + ba >= x + aa, y + bb >= x + ab
            x, y = max(x + aa, y + ba), max(x + ab, y + bb) + s
        out = np.zeros(len(score), np.int8)
        out[-1] = y >= x
        for t in range(len(score) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out


def line_labels(features: np.ndarray, quality: int) -> np.ndarray:
    """A document's label says what its lines are, but that common lines are boilerplate anywhere."""
    return ((quality == 1) & (features[:, _text.LINE_FEATURES.index("common")] == 0)).astype(np.int64)


def fit(texts: list[np.ndarray], labels: list[int], steps: int = 300, rate: float = 0.1, decay: float = 1e-3, pair_decay: float = 0.1) -> Field:
    """Maximum likelihood by gradient ascent (Adam), of the lines' labels given their documents'.

    Weights of pairs decay more, so that two common lines don't outvote the paragraph between them.
    """
    if len(set(labels)) < 2:
        return Field.neutral()
    parts = [(x[k : k + STRETCH], y) for x, y in zip(texts, labels, strict=True) for k in range(0, len(x), STRETCH)]
    longest, width = max(len(x) for x, _ in parts), parts[0][0].shape[1]
    X, real, Y = np.zeros((len(parts), longest, width)), np.zeros((len(parts), longest), bool), np.zeros((len(parts), longest), np.int64)
    for k, (x, y) in enumerate(parts):
        X[k, : len(x)], real[k, : len(x)], Y[k, : len(x)] = x, True, line_labels(x, y)
    good = np.array([y for _, y in parts]) == 1
    share = np.where(good, 0.5 / max(1, good.sum()), 0.5 / max(1, (~good).sum()))
    seen_pairs = np.zeros((LABELS, LABELS))
    np.add.at(seen_pairs, (Y[:, :-1], Y[:, 1:]), share[:, None] * real[:, 1:])
    theta = np.zeros(width + LABELS * LABELS)
    shrink = np.r_[np.full(width, decay), np.full(LABELS * LABELS, pair_decay)]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, pairs = theta[:width], theta[width:].reshape(LABELS, LABELS)
        emit = np.stack([np.zeros(real.shape), X @ w], -1)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0]
        for t in range(1, longest):
            move = np.logaddexp.reduce(ahead[:, t - 1, :, None] + pairs, 1) + emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], move, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            move = np.logaddexp.reduce(pairs + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None], move, behind[:, t + 1])
        total = np.logaddexp.reduce(ahead[:, -1], 1)
        content = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]) * real
        g_lines = np.einsum("k,kt,ktf->f", share, (Y - content) * real, X)
        both = np.exp(ahead[:, :-1, :, None] + pairs + (emit + behind)[:, 1:, None, :] - total[:, None, None, None]) * real[:, 1:, None, None]
        g_pairs = seen_pairs - np.einsum("k,ktij->ij", share, both)
        g = np.concatenate([g_lines, g_pairs.ravel()]) - shrink * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(theta[:width], theta[width:].reshape(LABELS, LABELS))


def common_lines(docs: DataFrame, least: int = 5, most: int | None = None) -> DataFrame:
    """Keys (``h``) of the lines that many documents hold among changing neighbours.

    Counted over all documents, each line of a document once, with the line before it and the one
    after it: a line is common if on one of the two sides it has at least ``least`` different
    neighbours, none of them in over half of its documents. So lines of copied documents, which bring
    their neighbours with them, aren't common. The rule is the same for any size of the corpus, so
    there may be as many common lines as it has; who wants at most twice ``most`` of them asks for
    one neighbour for every ``most`` lines of the corpus too.
    """

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        out: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int64(), pa.int8(), pa.int64()), strict=True)], names=["h", "side", "near"])

        for (text,) in cells(batches, "text"):
            keys = _keys(text)
            seen: set[int] = set()
            for k, h in enumerate(keys):
                if h not in seen:
                    seen.add(h)
                    out += (h, 0, keys[k - 1] if k else 0), (h, 1, keys[k + 1] if k + 1 < len(keys) else 0)
                    if len(out) >= 20_000:
                        yield batch()
                        out = []
        if out:
            yield batch()

    if most is not None:
        newlines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
        least = max(least, -(-(docs.agg(F.sum(newlines)).first()[0] or 0) // most))
    near = docs.select("text").mapInArrow(tidy(read), "h long, side tinyint, near long").groupBy("h", "side", "near").agg(F.count(F.lit(1)).alias("n"))
    sides = near.groupBy("h", "side").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"), F.max("n").alias("top"))
    return sides.filter((F.col("kinds") >= least) & (2 * F.col("top") <= F.col("n"))).select("h").distinct()


def _stretches(n: int) -> list[int]:
    """Where the sampled stretches of a text of ``n`` lines start."""
    starts = range(0, n, STRETCH)
    return list(starts) if len(starts) <= STRETCHES else [starts[k * len(starts) // STRETCHES] for k in range(STRETCHES)]


def learn(docs: DataFrame, labels: DataFrame, sample: int = 2000) -> Field:
    """Find the common lines of all documents and fit a field on at most ``sample`` labelled ones."""
    common = Common(saved(common_lines(docs), f"{run_dir(docs.sparkSession, 'quality')}/common"))
    outside = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    marked = labels.filter("doc_id is not null and quality in (0, 1)").filter(outside).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    some = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "labelled")
    texts = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("labelled"))

    words, bits = common.words, common.bits

    def taken_of(text: str | None) -> list[int]:
        """The keys that may be common of a text's sampled stretches."""
        keys = np.array(_keys(text), np.int64)
        return list({int(h) for k in _stretches(len(keys)) for h in keys[k : k + STRETCH][_hits(keys[k : k + STRETCH], words, bits)]})

    def maybe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for (text,) in cells(batches, "text"):
            yield pa.record_batch([pa.array(taken_of(text), pa.int64())], names=["h"])

    # At most ``sample`` documents' stretches are looked up; equal texts are met once.
    known = frozenset()
    if common.size:
        known = frozenset(r["h"] for r in texts.select("text").mapInArrow(tidy(maybe), "h long").distinct().join(common.keys, "h", "left_semi").collect())

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for doc_id, quality, text in cells(batches, "doc_id", "quality", "text"):
            features, _ = _text.lines(text or "", known)
            data = b"".join(features[k : k + STRETCH].astype(np.float32).tobytes() for k in _stretches(len(features)))
            yield pa.record_batch([pa.array([doc_id], pa.int64()), pa.array([quality], pa.int64()), pa.array([data], pa.binary())], names=["doc_id", "quality", "features"])

    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("quality"), "text").mapInArrow(read, "doc_id long, quality long, features binary")
    # Of rows that repeat a doc_id the one of the greatest features counts: one for each sampled label.
    rows = rows.groupBy("doc_id", "quality").agg(F.max("features").alias("features")).collect()
    found = sorted((bytes(r["features"]), r["quality"]) for r in rows)
    found = [(np.frombuffer(x, np.float32).reshape(-1, len(_text.LINE_FEATURES)), y) for x, y in found if x]
    field = fit([x for x, _ in found], [y for _, y in found])
    field.common = common
    return field


def _base(text: str) -> tuple[dict[str, int], bool]:
    """The base counts, and whether the base rules reject the text."""
    b = _text.base(text, text.encode().split())
    return b, b["n_words"] < 10 or 100 * b["n_repeat_words"] > 20 * b["n_words"]


def verdict(text: str | None, field: Field, known: frozenset[int], least: float = LEAST) -> tuple:
    """The columns after doc_id of one text; ``known``: the common lines, or those that the text has."""
    b, failed = _base(text or "")
    features, sizes = _text.lines(text or "", known)
    content = _content(features @ field.lines, sizes, field)
    return (*(b[c] for c in BASE), failed, not failed and content >= least * int(sizes.sum()), content)


def _content(scores: np.ndarray, sizes: np.ndarray, field: Field) -> int:
    """Words in content lines."""
    return int(sizes[field.decode(scores) == 1].sum()) if len(sizes) else 0


def _judged(docs: DataFrame, field: Field, least: float) -> DataFrame:
    """COLUMNS and the text's SHA-256 ``t``, per row of ``docs``.

    A text whose lines the bit table rules out is judged where it is read. Of the others the lines'
    scores and sizes travel, not the text: keys that may be common meet the common lines, and
    what a text has of them comes back to it by its hash. Equal texts are looked up once.
    """
    words, bits, some = field.common.words, field.common.bits, len(field.common) > 0
    plain = Field(field.lines, field.pairs)
    plain.common = None  # the table stays on the driver

    def first(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc, text, t in cells([batch], "doc_id", "text", "t"):
                text = text or ""
                b, failed = _base(text)
                features, sizes = _text.lines(text)
                keys = np.array(_keys(text) if some else [], np.int64)
                at = _hits(keys, words, bits) if some else []
                head = (doc, *(b[c] for c in BASE), failed)
                scores = features @ plain.lines
                if len(at):
                    rows.append((*head, None, None, t, keys[at].tolist(), at.astype(np.int32).tobytes(), scores.tobytes(), sizes.astype(np.int32).tobytes()))
                else:
                    content = _content(scores, sizes, plain)
                    rows.append((*head, not failed and content >= least * int(sizes.sum()), content, t, None, None, None, None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema(), strict=True)], schema=schema())

    def schema():
        import pyarrow as pa

        kinds = {"boolean": pa.bool_(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
        return pa.schema([(n, kinds[kind]) for n, kind in (c.split() for c in f"{COLUMNS}, {PENDING}".split(", "))])

    def second(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weight = plain.lines[_text.LINE_FEATURES.index("common")]
        for batch in batches:
            rows = []
            for *head, t, keys, at, scores, sizes, found in cells([batch], *(c.split()[0] for c in COLUMNS.split(", ")[:-2]), "t", "keys", "places", "scores", "sizes", "found"):
                scores, sizes, at, found = np.frombuffer(scores).copy(), np.frombuffer(sizes, np.int32), np.frombuffer(at, np.int32), set(found or [])
                scores[at[[h in found for h in keys]]] += weight
                content = _content(scores, sizes, plain)
                rows.append((*head, not head[-1] and content >= least * int(sizes.sum()), content, t))
            if rows:
                out = pa.schema(list(schema())[: len(COLUMNS.split(", ")) + 1])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("t"))
    done = read.mapInArrow(tidy(first), f"{COLUMNS}, {PENDING}")
    names = [c.split()[0] for c in COLUMNS.split(", ")] + ["t"]
    if not some:
        return done.select(names)
    done = saved(done, f"{run_dir(docs.sparkSession, 'quality')}/judged")
    waiting = done.filter(F.col("places").isNotNull())
    asked = waiting.select("t", F.explode("keys").alias("h")).distinct()
    # A list per text, of its own lines.
    found = asked.join(field.common.keys, "h", "left_semi").groupBy("t").agg(F.collect_list("h").alias("found"))
    late = waiting.join(found, "t", "left").mapInArrow(tidy(second), f"{COLUMNS}, t binary")
    return done.filter(F.col("places").isNull()).select(names).unionByName(late)


def judge(docs: DataFrame, field: Field, least: float = LEAST) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, kept, content_words."""
    return _judged(docs, field, least).drop("t")


def keep(docs: DataFrame, field: Field, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns: a text's verdict holds for all
    rows that have it, and meets them by the text's hash."""
    kept = _judged(docs.select(F.lit(None).cast("long").alias("doc_id"), "text"), field, least).filter("kept").select(F.col("t").alias("_kept")).distinct()
    rows = packed(docs).withColumn("t", F.unhex(F.sha2(F.coalesce("row.text", F.lit("")), 256)))
    return rows.join(kept, F.col("t") == F.col("_kept"), "left_semi").select("row.*")

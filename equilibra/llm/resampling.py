"""Target-distribution importance resampling over hashed n-grams.

1. Scan. A text is lower-cased (A-Z), its separators collapse to single spaces, and one
   regular expression per n, run with overlapping matches and look-arounds at the
   borders of words, gives the span of every n-gram; the CRC-32 of a span picks its bucket.
   Each document's buckets are written once, as two or four bytes each, so texts are read once.
2. Counts. Every task adds its buckets up in an array and hands on at most ``buckets``
   rows; sums of all documents and of all target texts give each bucket's gain, a
   thousandth of a natural logarithm of the ratio of smoothed shares.
3. Draw. A document's weight is the mean gain of its features; with a Gumbel number made of
   its id, the highest scores are a sample without replacement by weight. Ranks
   come from a range partition of (score, id) and row counts of its partitions.

The driver holds one count per bucket and one per partition. Nothing else is gathered.

Defined cases: null text has no words (weight 0, no rank). Null doc_ids are hashed as the
empty string and rank behind other ids of their score; rows that repeat a
doc_id are documents of their own, in a fixed but arbitrary order where all else is equal.
An empty table gives no rows, an empty target equal shares. Very long texts are read whole.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equilibra.llm._work import numbered, run_dir, saved, spare

SCORED = "doc_id long, n_words long, n_features long, weight long"


@dataclass(frozen=True)
class Sampler:
    """Parameters: n-grams of ``shortest`` to ``longest`` words, ``percent`` of the documents
    of at least ``least_words`` words are drawn."""

    shortest: int = 1
    longest: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: int = 2024

    @property
    def kind(self) -> str:
        return "<u2" if self.buckets <= 1 << 16 else "<u4"


#: Byte table: A-Z to lower case, other ASCII but letters and digits to the space.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def patterns(sampler: Sampler) -> list:
    """One pattern per n: n words with single spaces, between borders of words."""
    import regex

    word = rb"[^ ]+"
    return [regex.compile(rb"(?<![^ ])" + rb" ".join([word] * n) + rb"(?![^ ])") for n in range(sampler.shortest, sampler.longest + 1)]


def collapsed(text: str | None) -> bytes:
    """The words of a text in UTF-8, with single spaces."""
    return b" ".join((text or "").encode().translate(PLAIN).split())


def features(text: bytes, scans: list, buckets: int) -> np.ndarray:
    """The bucket of every n-gram of a collapsed text, repeats included."""
    crc = zlib.crc32
    return np.array([crc(m.group()) % buckets for scan in scans for m in scan.finditer(text, overlapped=True)], np.int64)


def scanned(docs: DataFrame, sampler: Sampler) -> DataFrame:
    """(doc_id, n_words, features) of each row; features are packed bucket numbers."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scans, rows, held = patterns(sampler), [], 0

        def out():
            ids, words, found = zip(*rows, strict=True)
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array(words, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "n_words", "features"])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = collapsed(text.as_py())
                rows.append((doc, words.count(b" ") + 1 if words else 0, features(words, scans, sampler.buckets).astype(sampler.kind).tobytes()))
                held += len(rows[-1][2])
                if held > 4_000_000:
                    yield out()
                    rows, held = [], 0
        if rows:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, features binary")


def totals(table: DataFrame, sampler: Sampler) -> np.ndarray:
    """Occurrences per bucket over a scanned table."""

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count = np.zeros(sampler.buckets, np.int64)
        for batch in batches:
            for x in batch.column("features"):
                count += np.bincount(np.frombuffer(x.as_buffer(), sampler.kind), minlength=sampler.buckets)
        some = np.flatnonzero(count)
        yield pa.record_batch([pa.array(some), pa.array(count[some])], names=["bucket", "n"])

    out = np.zeros(sampler.buckets, np.int64)
    for r in table.select("features").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: floor of a thousand times the logarithm of the ratio of smoothed shares."""
    S, T, m = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (S + m) / ((s + 1.0) * (T + m)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(table: DataFrame, gain: np.ndarray, kind: str) -> DataFrame:
    """SCORED rows: the floored mean gain of each row's features."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n, total = [], []
            for x in batch.column("features"):
                own = np.frombuffer(x.as_buffer(), kind)
                n.append(len(own))
                total.append(int(gain[own].sum()) // max(1, len(own)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(n, pa.int64()), pa.array(total, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return table.mapInArrow(run, SCORED)


def gumbel(seed: int) -> Column:
    """A thousand times a Gumbel number made of the seed and doc_id, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, sampler: Sampler = Sampler()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank (null if not drawn)."""
    base = run_dir(docs.sparkSession, "resampling")
    table = saved(scanned(docs, sampler), f"{base}/features")
    # Target texts have no ids that matter here.
    wanted = scanned(target.select(F.lit(0).alias("doc_id"), "text"), sampler)
    gain = gains(totals(table, sampler), totals(wanted, sampler))
    scored = weighted(table, gain, sampler.kind).withColumn("score", F.col("weight") + gumbel(sampler.seed))
    scored = saved(scored.withColumn("place", F.monotonically_increasing_id()), f"{base}/scored")
    whole = scored.filter(F.col("n_words") >= sampler.least_words)
    drawn = whole.count() * sampler.percent // 100
    # Rows with equal scores and ids are told apart by their place, so no value fills a partition.
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("place")]
    ranked = numbered(whole.repartitionByRange(*order).sortWithinPartitions(*order), f"{base}/ranked", "before")
    rank = F.when(F.col("before") < drawn, F.col("before") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    short = scored.filter(F.col("n_words") < sampler.least_words)
    return ranked.select(*columns, rank.alias("rank")).unionByName(short.select(*columns, F.lit(None).cast("long").alias("rank")))


def draw(docs: DataFrame, target: DataFrame, sampler: Sampler = Sampler()) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; of rows that repeat a doc_id, all if one is drawn."""
    (drawn,) = spare(docs, "drawn")
    chosen = resample(docs, target, sampler).filter("rank is not null").select(F.col("doc_id").alias(drawn)).distinct()
    return docs.join(chosen, F.col("doc_id").cast("long").eqNullSafe(F.col(drawn)), "left_semi")

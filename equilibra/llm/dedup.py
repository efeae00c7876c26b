"""Exact deduplication with counting quotient filters.

1. One pass over the texts writes a small table (doc_id, fingerprint, SHA-256)
   of the normalised texts. A fingerprint is 64 bits: the upper ``slice_bits``
   pick a slice, the next ones are the quotient, the rest the remainder.
2. Every task builds a counting quotient filter (``quotient.py``) per slice from its
   partition, so what repeats in a partition leaves it once. Slices follow the number of
   rows and meet by a shuffle; a task merges the filters of one slice, walking their
   sorted remainders and adding counts. Nothing is lost: slice, quotient and remainder
   together are the fingerprint.
3. Fingerprints with a count above one become a bit table, sized by their number up to
   a fixed most. Only texts that it can't rule out are read as bytes again: they are
   grouped by the whole normalised text (copies fold in each task before the shuffle),
   and groups of two and more are the classes. Two texts with one fingerprint part
   here; a text that only shares a bit comes out alone.

A group of copies may hold a third of all rows: the filters and the byte
groups are partial aggregates, and the join that hands out classes carries no
text and can be split by adaptive execution.

Defined cases: null text is the empty text, which is a text like others. The
least doc_id stays; null ids rank last (a group of null ids only has keep_id
null). Rows that repeat a doc_id and its text are the same document: all carry
the same keep_id, ``group_size`` counts each, ``drop_copies`` returns one.
Further columns are ignored (``duplicates``) or kept (``drop_copies``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra.llm._work import SPACE, bit_words, bits_for, in_words, packed, run_dir, saved
from equilibra.llm.quotient import QuotientFilter

#: Rows that a slice of the fingerprints holds on average, and the most bits that pick one.
SLICE_ROWS, MOST_SLICE_BITS = 2_000_000, 24


def filters(prints: DataFrame, slice_bits: int, room: int = 1_000_000) -> DataFrame:
    """(slice, filter) rows of a table of fingerprints (column ``h``), of each partition.

    A task hands its filters on after ``room`` fingerprints, so its memory is bounded.
    """

    def build(batches: Iterator) -> Iterator:
        held: list[np.ndarray] = []

        def out():
            p = np.sort(np.concatenate(held))
            slices, starts = np.unique(p >> np.uint64(64 - slice_bits), return_index=True)
            ends = [*starts[1:], len(p)]
            dumps = [QuotientFilter.build(p[a:b], slice_bits=slice_bits).dump() for a, b in zip(starts, ends, strict=True)]
            held.clear()
            return pa.record_batch([pa.array(slices.astype(np.int32)), pa.array(dumps, pa.binary())], names=["slice", "cqf"])

        for batch in batches:
            held.append(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= room:
                yield out()
        if sum(map(len, held)):
            yield out()

    return prints.select("h").mapInArrow(build, "slice int, cqf binary")


def repeated(cqfs: DataFrame) -> DataFrame:
    """Fingerprints (h, n) with a count above one, from the filters of all partitions."""

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list[QuotientFilter] = []
        for batch in batches:
            for data in batch.column("cqf"):
                whole.append(QuotientFilter.load(data.as_py()))
                while len(whole) > 1 and len(whole[-1].slots) >= len(whole[-2].slots):
                    whole.append(whole.pop().merge(whole.pop()))
        while len(whole) > 1:
            whole.append(whole.pop().merge(whole.pop()))
        for cqf in whole:
            prints, counts = cqf.items()
            many = counts > 1
            yield pa.record_batch([pa.array(prints[many].view(np.int64)), pa.array(counts[many])], names=["h", "n"])

    return cqfs.groupBy("slice").applyInArrow(merge, "h long, n long")


def normal(text: str):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def slice_bits_for(rows: int) -> int:
    """Bits that pick a slice: as many slices as the rows need, so that a task's memory stays alike."""
    return max(4, min(MOST_SLICE_BITS, (max(1, rows) // SLICE_ROWS).bit_length()))


def byte_groups(docs: DataFrame, prints: DataFrame, base: str) -> DataFrame:
    """(h, sha, keep_id, size) of each group of two and more equal texts."""
    dup = saved(repeated(filters(prints, slice_bits_for(prints.count()))), f"{base}/repeated")
    texts = docs.select("doc_id", normal("text").alias("norm")).withColumn("h", F.xxhash64("norm"))
    bits = bits_for(dup.count())
    routed = in_words(texts, F.col("h"), bit_words(dup.select("h"), bits), bits).filter("__hit")
    groups = routed.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    return saved(groups.select("h", F.sha2("norm", 256).alias("sha"), "keep_id", "size"), f"{base}/groups")


def duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    base = run_dir(docs.sparkSession, "dedup")
    docs = docs.select("doc_id", "text")
    norm = docs.select("doc_id", normal("text").alias("norm"))
    prints = saved(norm.select("doc_id", F.xxhash64("norm").alias("h"), F.sha2("norm", 256).alias("text_sha256")), f"{base}/prints")
    groups = byte_groups(docs, prints, base).withColumnRenamed("h", "gh")
    mine = prints.join(groups, (prints.h == groups.gh) & (prints.text_sha256 == groups.sha), "left")
    keep = F.when(F.col("gh").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return mine.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat a text; the least doc_id stays, and of its rows
    the one of the least text as written. No text is shuffled but those that may have copies."""
    base = run_dir(docs.sparkSession, "dedup")
    prints = saved(docs.select(F.xxhash64(normal("text")).alias("h")), f"{base}/prints")
    groups = byte_groups(docs, prints, base).select("h", "sha", "keep_id").withColumnsRenamed({"h": "__gh", "sha": "__sha", "keep_id": "__keep"})
    marked = packed(docs).withColumn("__norm", normal("row.text")).withColumn("__h", F.xxhash64("__norm"))
    bits = bits_for(groups.count())
    marked = in_words(marked, F.col("__h"), bit_words(groups.select(F.col("__gh").alias("h")), bits), bits)
    sure = marked.filter(~F.col("__hit")).select("row")
    asked = marked.filter("__hit").withColumn("__s", F.sha2("__norm", 256)).drop("__norm", "__hit")
    asked = asked.join(groups, (F.col("__h") == F.col("__gh")) & (F.col("__s") == F.col("__sha")), "left")
    alone = asked.filter("__gh is null").select("row")
    kept = asked.filter("__gh is not null").filter(F.col("row.doc_id").eqNullSafe(F.col("__keep")))
    kept = kept.groupBy("__gh", "__sha").agg(F.min_by("row", F.struct("row.text", F.xxhash64("row"))).alias("row")).select("row")
    return sure.unionByName(alone).unionByName(kept).select("row.*")

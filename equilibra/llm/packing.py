"""Packing documents into sequences: cutting stock by column generation.

A document of L tokens is cut into pieces of ``capacity`` tokens and a rest.
Lengths are counted in units of ``unit`` tokens (rounded up), which gives at
most capacity / unit sizes whatever the corpus. The histogram of sizes is the
demand of a cutting-stock problem: a linear program over patterns (how many
pieces of each size share a sequence), whose columns are priced by a knapsack
dynamic program over its dual values. Rounded down, the patterns are used whole
numbers of times; what rounding leaves is filled largest size first.

Pieces are ranked in each size by doc_id, in range partitions with counts
carried over, so a size that a third of all pieces share is ranked by many
tasks. A piece's rank in its size gives its pattern, the pattern's copy and its
slot by arithmetic; offsets are running sums in a sequence, which holds at most
``capacity`` pieces. The driver sees the histogram and counts per partition.

Defined cases: null or empty text is the end id alone (one piece). Null or
repeated doc_ids are packed like others, each row by itself. Ties in a size
rank by start, length and checksum. No rows give no rows. Other columns are ignored.
Sequences are padded to ``capacity``, except that one whose length is a power
of two stays as it is (``padded`` tells the length).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equilibra.llm._tokens import encoded
from equilibra.llm._work import cells, partition, run_dir, saved, tidy

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, path: str, capacity: int = 4096) -> DataFrame:
    """Every document's pieces in order; each id lies in exactly one."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [x.split()[0] for x in PIECES.split(", ")]
        rows: list[tuple] = []

        def out():
            return pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=names)

        for doc, data in encoded(path, False, cells(batches, "doc_id", "text")):
            n = len(data) // 4
            rows += [(doc, at, min(capacity, n - at), zlib.crc32(data[4 * at : 4 * (at + capacity)]), n) for at in range(0, n, capacity)]
            if len(rows) >= 20_000:
                yield out()
                rows.clear()
        if rows:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(cut), PIECES)


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value and how many of each size, by dynamic programming over the room used."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fit = sizes <= room
        if fit.any():
            got = best[room - sizes[fit]] + values[fit]
            k = int(got.argmax())
            if got[k] > best[room] + 1e-12:
                best[room], last[room] = got[k], np.flatnonzero(fit)[k]
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            counts[last[room]] += 1
            room -= sizes[last[room]]
    return best[capacity], counts


def patterns(demand: dict[int, int], capacity: int, steps: int = 4000) -> list[tuple[int, dict[int, int]]]:
    """[(copies, {size: pieces})] that hold at least the demand of each size.

    Column generation on the linear program, at most ``steps`` pivots (any
    pivot leaves a valid plan, an earlier end only packs less tightly).
    """
    demand = {s: n for s, n in sorted(demand.items()) if n > 0}
    if not demand:
        return []
    sizes, need = np.array(list(demand)), np.array(list(demand.values()), float)
    m = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse, used = np.diag(1 / np.diag(columns)), need / np.diag(columns)
    for step in range(steps):
        if step % 200 == 199:
            inverse = np.linalg.inv(columns)
            used = np.maximum(inverse @ need, 0)
        value, column = _knapsack(sizes, inverse.sum(0), capacity)
        if value <= 1 + 1e-6:
            break
        move = inverse @ column
        ratio = np.full(m, np.inf)
        np.divide(used, move, out=ratio, where=move > 1e-9)
        out = int(ratio.argmin())
        used = np.maximum(used - ratio[out] * move, 0)
        used[out] = ratio[out]
        columns[:, out] = column
        row = inverse[out] / move[out]
        inverse = inverse - np.outer(move, row)
        inverse[out] = row
    copies = np.floor(used + 1e-7).astype(np.int64)
    left = np.array(list(demand.values()), np.int64)
    plan = []
    for j in np.flatnonzero(copies):
        held = columns[:, j].astype(np.int64)
        many = min(int(copies[j]), int((left[held > 0] // held[held > 0]).min()))
        if many:
            plan.append((many, {int(sizes[i]): int(held[i]) for i in np.flatnonzero(held)}))
            left -= many * held
    while left.any():
        room, held = capacity, np.zeros(m, np.int64)
        for i in np.flatnonzero(left)[::-1]:
            held[i] = min(left[i], room // sizes[i])
            room -= held[i] * sizes[i]
        many = int((left[held > 0] // held[held > 0]).min())
        plan.append((many, {int(sizes[i]): int(held[i]) for i in np.flatnonzero(held)}))
        left -= many * held
    return plan


def _slots(plan: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By size: rank from which each pattern serves it, the pattern's first
    sequence, pieces of the size in a copy, and its first slot in a copy."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence, served = 0, dict[int, int]()
    for copies, held in plan:
        slot = 0
        for size in sorted(held, reverse=True):
            rows.setdefault(size, []).append((served.get(size, 0), sequence, held[size], slot))
            served[size] = served.get(size, 0) + copies * held[size]
            slot += held[size]
        sequence += copies
    return {size: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for size, r in rows.items()}


def _ranked(table: DataFrame, base: str) -> DataFrame:
    """Adds ``part`` and ``near``: a row's partition, and its rank in its size there."""
    parted = table.repartitionByRange("size", "doc_id", "start", "length", "ids_crc32").sortWithinPartitions("size", "doc_id", "start", "length", "ids_crc32")

    def number(batches: Iterator) -> Iterator:
        import pyarrow as pa

        size, seen = -1, 0
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            near = np.arange(len(sizes), dtype=np.int64)
            starts = np.flatnonzero(np.r_[True, sizes[1:] != sizes[:-1]]) if len(sizes) else []
            for a, b in zip(starts, [*starts[1:], len(sizes)], strict=True):
                before = seen if sizes[a] == size else 0
                near[a:b] += before - a
                size, seen = sizes[a], before + b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(sizes), partition(), np.int32)), pa.array(near)], names=[*batch.schema.names, "part", "near"])

    return saved(parted.mapInArrow(number, f"{PIECES}, size int, part int, near long"), f"{base}/ranked")


def pack(docs: DataFrame, path: str, capacity: int = 4096, unit: int = 16) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded."""
    base = run_dir(docs.sparkSession, "packing")
    table = saved(pieces(docs, path, capacity).withColumn("size", F.ceil(F.col("length") / unit).cast("int")), f"{base}/pieces")
    demand = {r["size"]: r["count"] for r in table.groupBy("size").count().collect()}
    slots = _slots(patterns(demand, capacity // unit))
    ranked = _ranked(table, base)
    before, counted = {}, dict[int, int]()
    for r in sorted(ranked.groupBy("size", "part").count().collect(), key=lambda r: r["part"]):
        before[r["size"], r["part"]] = counted.get(r["size"], 0)
        counted[r["size"]] = counted.get(r["size"], 0) + r["count"]

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            size, part, near = (batch.column(n).to_numpy() for n in ("size", "part", "near"))
            sequence, slot = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s, p in {*zip(size.tolist(), part.tolist(), strict=True)}:
                at = (size == s) & (part == p)
                rank = near[at] + before[s, p]
                ranks, first, held, slot_from = slots[s]
                k = np.searchsorted(ranks, rank, "right") - 1
                inside = rank - ranks[k]
                sequence[at] = first[k] + inside // held[k]
                slot[at] = slot_from[k] + inside % held[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(slot)], names=[*batch.schema.names[:5], "sequence_id", "slot"])

    placed = ranked.mapInArrow(place, f"{PIECES}, sequence_id long, slot long")
    row = Window.partitionBy("sequence_id")
    total = F.sum("length").over(row)
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        (F.sum("length").over(row.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("offset"),
        F.when(F.bit_count(total) == 1, total).otherwise(F.lit(capacity).cast("long")).alias("padded"),
    )

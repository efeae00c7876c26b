"""Near-duplicate classes: DartMinHash signatures, banded joining, exact verification.

Similarity is the weighted Jaccard similarity of two texts' five-word shingles
(lower case, words between ASCII white space), the weight of a shingle being
how often it occurs; texts of under five words are one shingle. Links are pairs
of at least 0.8; classes are the connected components of links.

1. Signatures. A shingle of weight w owns the region [0, w) of a weight axis,
   cut at 1, 2, 4, 8 ... . Hashed darts fall on each stretch as a Poisson
   process in rank: the k-th gap, the dart's place and its coordinate are
   hashes of (shingle, stretch, k), so every text sees the same darts. A text
   throws only those up to a rank where its total weight gives each of its 120
   coordinates about nine; the earliest dart inside its regions wins a
   coordinate. Work is linear in shingles plus darts, whatever the weights.
   A coordinate left empty doubles that rank for its text.
2. Bands of five coordinates are join keys (24; a pair at 0.8 shares none with
   probability 7e-5, at 0.85 1e-6). Texts are told apart by a 64-bit hash, so
   copies fold before any join.
3. In each bucket, texts meet two pivots only: the text that shares most
   buckets, and one by hash. Pairs are verified exactly on the shingles, links
   joined to components: linear in the rows of a bucket.
4. What pivots leave: clusters (texts connected by buckets) with more than one
   component. Texts outside a cluster's largest component are compared with all of
   the cluster in blocks, exactly, and each block hands on only links that
   join components. So no link is lost but by step 2, and no pairs are listed.

The texts of candidates are read a second time, routed by a bit table of fixed
size. A hot group folds (copies) or is met by pivots in joins that adaptive execution splits.

Defined cases: null text counts as empty; texts without words are equal to each
other and to nothing else. The class is named by its least doc_id (null if all
are null). Repeated rows are members like others. Further columns are ignored.
``drop_near_copies`` decides by row: rows of one doc_id may have different texts.
An empty table gives no rows. Very long texts are cut nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equilibra.llm._work import SPACE, bit_words, in_words, packed, run_dir, saved, tidy
from equilibra.llm.components import components

WORDS, SIMILARITY, BANDS, ROWS = 5, 0.8, 24, 5
PART, WIDE = 400_000, 4096  #: elements, and shared elements, that a block comparison holds at a time
BLOCK, ELEMENTS = 512, 500_000  #: texts, and elements, of a block (one text at least)
DARTS = 9.0  #: expected darts per coordinate at the first rank bound
MIX1, MIX2, GOLD, BASE = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0x100000001B3))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def step(k: int) -> np.uint64:
    """The k-th step of a stream of hashes."""
    return np.uint64(int(GOLD) * k & (1 << 64) - 1)


class WordHashes(dict):
    """Cache: word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = WordHashes()


def forgetful(task):
    """The task's function, after which the cache of word hashes is empty (named when it runs:
    workers have a cache of their own)."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            HASHES.clear()

    return run


def shingles(text: str) -> np.ndarray:
    """Hashes of a text's word windows, one per place; a text of fewer words is one window."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    if len(h) < WORDS:
        h = np.concatenate([h, np.zeros(WORDS - len(h), np.uint64)])
    n = len(h) - WORDS + 1
    out = h[:n].copy()
    for k in range(1, WORDS):
        out = out * BASE * GOLD + h[k : n + k]
    return mix(out)


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """Each place as an element of its own: the k-th occurrence of a shingle, ascending."""
    h = np.sort(hashes)
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    if len(first) == len(h):
        return h
    nth = np.arange(len(h)) - np.repeat(first, np.diff(np.r_[first, len(h)]))
    return np.sort(np.where(nth == 0, h, mix(h + GOLD * nth.astype(np.uint64))))


def dart_signatures(elements: list[tuple[np.ndarray, np.ndarray]], size: int = BANDS * ROWS, darts: float = DARTS) -> np.ndarray:
    """Signatures (sets x size, unsigned 64-bit) of weighted sets.

    elements: per set the element hashes (distinct) and their weights (above 0).
    Two signatures agree in a coordinate with the sets' weighted Jaccard similarity.
    """
    count = len(elements)
    out, todo, bound = np.zeros((count, size), np.uint64), np.arange(count), darts
    while len(todo):
        which = np.concatenate([np.full(len(elements[i][0]), k) for k, i in enumerate(todo)])
        h = np.concatenate([elements[i][0] for i in todo])
        w = np.concatenate([elements[i][1] for i in todo]).astype(float)
        last = bound / np.bincount(which, w, len(todo))
        ranks, slots, names = [], [], []
        low, width, stretch = 0.0, 1.0, 0
        while len(h):
            seed, rank, mine, weight = mix(h + step(stretch + 1)), np.zeros(len(h)), which, w
            k = 0
            while len(seed):
                k += 1
                dart = mix(seed + step(k))
                rank = rank - np.log(((dart >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / (size * width)
                alive = rank <= last[mine]
                if not alive.all():
                    seed, rank, mine, weight, dart = seed[alive], rank[alive], mine[alive], weight[alive], dart[alive]
                second = mix(dart ^ MIX1)
                slot = mine * size + (second % np.uint64(size)).astype(np.int64)
                if len(partial := np.flatnonzero(weight < low + width)):
                    inside = np.ones(len(dart), bool)
                    place = low + width * (mix(second[partial] ^ MIX2) >> np.uint64(11)).astype(float) * 2.0**-53
                    inside[partial] = place < weight[partial]
                    ranks.append(rank[inside]), slots.append(slot[inside]), names.append(dart[inside])
                else:
                    ranks.append(rank), slots.append(slot), names.append(dart)
            low, width, stretch = (1.0, 1.0, 1) if stretch == 0 else (low * 2, low * 2, stretch + 1)
            more = w > low
            h, w, which = h[more], w[more], which[more]
        rank, slot, name = np.concatenate(ranks), np.concatenate(slots), np.concatenate(names)
        latest = np.argsort(-rank, kind="stable")
        found, filled = np.zeros(len(todo) * size, np.uint64), np.zeros(len(todo) * size, bool)
        found[slot[latest]], filled[slot] = name[latest], True
        whole = filled.reshape(-1, size).all(1)
        out[todo[whole]] = found.reshape(-1, size)[whole]
        todo, bound = todo[~whole], bound * 2
    return out


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(sets x bands) join keys; the band's number is part of its key."""
    parts = signatures.reshape(len(signatures), bands, -1)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * GOLD), parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        key = mix(key * BASE + parts[:, :, k])
    return key


def norm_text(text: str = "text") -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SPACE, " "))


def normal(docs: DataFrame) -> DataFrame:
    """(doc_id, norm, node): the words of the text with single spaces, and their hash."""
    return docs.select("doc_id", norm_text().alias("norm")).withColumn("node", F.xxhash64("norm"))


def signatures(texts: DataFrame) -> DataFrame:
    """(doc_id, node, n, bands) of each text; n is its number of shingles."""

    def sign(batches: Iterator) -> Iterator:
        def out(ids, nodes, sets, sizes):
            keys = np.zeros((len(sets), 0), np.uint64)
            full = [k for k, s in enumerate(sets) if len(s[0])]
            lists: list = [[]] * len(sets)
            if full:
                keys = band_keys(dart_signatures([sets[k] for k in full])).view(np.int64)
                for k, row in zip(full, keys, strict=True):
                    lists[k] = row
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "node", "n", "bands"])

        for batch in batches:
            ids, nodes, sets, sizes, held = [], [], [], [], 0
            for doc, node, text in zip(batch.column("doc_id").to_pylist(), batch.column("node").to_pylist(), batch.column("norm"), strict=True):
                h = shingles(text.as_py())
                ids.append(doc), nodes.append(node), sets.append(np.unique(h, return_counts=True)), sizes.append(len(h))
                held += len(h) + 300
                if held > 100_000:
                    yield out(ids, nodes, sets, sizes)
                    ids, nodes, sets, sizes, held = [], [], [], [], 0
            if ids:
                yield out(ids, nodes, sets, sizes)

    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), "node", "norm").mapInArrow(tidy(forgetful(sign)), "doc_id long, node long, n long, bands array<long>")


def candidate_shingles(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(node, n, elements) of the texts in buckets, once for each different text."""
    words = bit_words(members.select(F.col("node").alias("h")).distinct())
    texts = in_words(normal(docs).select("norm", "node"), F.col("node"), words).filter("__hit").select("node", "norm").distinct()

    def cut(batches: Iterator) -> Iterator:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                sets = [occurrences(shingles(t.as_py())).view(np.int64) for t in part.column("norm")]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "n", "elements"])

    return texts.mapInArrow(tidy(forgetful(cut)), "node long, n long, elements array<long>")


def pivot_pairs(members: DataFrame) -> DataFrame:
    """(a, b) with a > b: each bucket's texts with its two pivots, sizes permitting."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("in_key"))
    shared = members.join(sizes, "key").groupBy("node").agg(F.sum("in_key").alias("shared"))
    known = members.join(shared, "node")
    pivots = known.groupBy("key").agg(
        F.max(F.struct("shared", "node", "n")).alias("centre"), F.min(F.struct(F.xxhash64("node", "key").alias("order"), "node", "n")).alias("other")
    )
    pivots = pivots.select(F.col("key").alias("pkey"), F.explode(F.array(F.struct("centre.node", "centre.n"), F.struct("other.node", "other.n"))).alias("p"))
    pairs = members.join(pivots, F.col("key") == F.col("pkey"))
    near = F.least("n", "p.n") / F.greatest("n", "p.n") >= SIMILARITY
    return pairs.filter(near & (F.col("node") != F.col("p.node"))).select(F.greatest("node", "p.node").alias("a"), F.least("node", "p.node").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity is high enough, exactly."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("elements").alias("e_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("elements").alias("e_b"))
    met = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("e_a", "e_b")))
    return met.filter(F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common")) >= SIMILARITY).select("a", "b")


def _links(nodes: np.ndarray, groups: np.ndarray, active: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join different groups of one cluster's nodes, as few as join them;
    pairs with at least one active node are compared."""
    size = np.array([len(s) for s in sets], float)
    common = np.zeros((len(sets), len(sets)))
    # Elements are hashes, so ranges of them are even parts: one part at a time.
    parts = int(size.sum()) // PART + 1
    edges = [np.uint64((1 << 64) * k // parts) for k in range(parts)]
    cuts = [[*np.searchsorted(s, edges).tolist(), len(s)] for s in sets]
    for k in range(parts):
        some = [s[c[k] : c[k + 1]] for s, c in zip(sets, cuts, strict=True)]
        _, column = np.unique(np.concatenate(some), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in some])
        often = np.bincount(column, minlength=1) > 1
        keep = often[column]
        column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for at in range(0, int(often.sum()), WIDE):
            a, b = np.searchsorted(column, (at, at + WIDE))
            held = np.zeros((len(sets), WIDE), np.float32)
            held[owner[a:b], column[a:b] - at] = 1
            common += held @ held.T
    close = common / (size[:, None] + size[None, :] - common) >= SIMILARITY
    close &= (groups[:, None] != groups[None, :]) & (active[:, None] | active[None, :])
    root = {g: g for g in groups.tolist()}

    def find(g: int) -> int:
        while root[g] != g:
            root[g] = g = root[root[g]]
        return g

    out = []
    for i, j in zip(*np.nonzero(np.triu(close)), strict=True):
        x, y = find(int(groups[i])), find(int(groups[j]))
        if x != y:
            root[x] = y
            out.append((int(nodes[i]), int(nodes[j])))
    return out


def block_links(members: DataFrame, clusters: DataFrame, linked: DataFrame, sets: DataFrame, folder: str) -> DataFrame:
    """Links (a, b) between components of one cluster that pivots didn't find."""
    nodes = members.select("node", "n").distinct().join(clusters.withColumnRenamed("component", "cluster"), "node").join(linked.withColumnRenamed("component", "part"), "node", "left")
    nodes = saved(nodes.select("node", "n", "cluster", F.coalesce("part", "node").alias("part")), f"{folder}/nodes")
    blocks = lambda texts, elements: F.ceil(F.greatest(texts / BLOCK, elements / ELEMENTS))
    parts = nodes.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"))
    open_ = parts.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("size", "part", "n")).alias("main"), F.sum("size").alias("all"), F.sum("n").alias("n")
    ).filter("parts > 1")
    rest = blocks(F.col("all") - F.col("main.size"), F.col("n") - F.col("main.n"))
    open_ = open_.select("cluster", F.col("main.part").alias("main"), blocks(F.col("main.size"), F.col("main.n")).alias("mains"), rest.alias("rests"), (blocks(F.col("all"), F.col("n")) <= 1).alias("small"))
    left = nodes.join(open_, "cluster").withColumn("active", F.col("part") != F.col("main"))
    spot = F.when(F.col("active"), F.col("mains") + F.pmod(F.xxhash64("node"), F.col("rests"))).otherwise(F.pmod(F.xxhash64("node"), F.col("mains")))
    small = F.col("small")
    left = left.withColumn("spot", F.when(small, F.lit(0).cast("long")).otherwise(spot))
    others = F.when(small, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.when(F.col("active"), F.lit(0).cast("long")).otherwise(F.col("mains")), F.col("mains") + F.col("rests") - 1)
    )
    dealt = left.withColumn("other", F.explode(others))
    # Clusters of one block share groups of about a block's size; larger ones have a group for each pair of blocks.
    heaps = max(1, (nodes.agg(F.sum("n")).first()[0] or 0) // ELEMENTS)
    group = F.when(small, F.pmod(F.xxhash64("cluster"), F.lit(heaps))).otherwise(F.xxhash64("cluster", F.least("spot", "other"), F.greatest("spot", "other")))
    dealt = dealt.select("node", "cluster", "part", "active", group.alias("group"), F.when(small, F.lit(0)).otherwise(1).alias("kind"))
    dealt = dealt.join(sets.select("node", "elements"), "node").select("group", "kind", "cluster", "node", "part", "active", "elements")

    def compare(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        for batch in batches:
            for cluster, node, part, active, elements in zip(*(batch.column(n).to_pylist() for n in ("cluster", "node", "part", "active")), batch.column("elements"), strict=True):
                held.setdefault(cluster, {})[node] = part, active, elements.values.to_numpy().view(np.uint64)
        links = []
        for found in held.values():
            names = np.array(list(found), np.int64)
            links += _links(names, np.array([x[0] for x in found.values()]), np.array([x[1] for x in found.values()]), [x[2] for x in found.values()])
        yield pa.record_batch([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    return dealt.groupBy("kind", "group").applyInArrow(compare, "a long, b long")


def grouped(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, node, group) of each row of ``docs``; a class is the rows of one group."""
    docs = docs.select("doc_id", "text")
    signed = saved(signatures(normal(docs)), f"{folder}/signed")
    bands = signed.select("node", "n", F.explode("bands").alias("key"))
    keys = bands.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key", "lo")
    members = saved(bands.join(keys, "key").distinct(), f"{folder}/members")
    sets = saved(candidate_shingles(docs, members), f"{folder}/shingles")
    links = saved(verified(pivot_pairs(members), sets), f"{folder}/links")
    linked = components(links, f"{folder}/linked")
    clusters = components(members.select(F.col("node").alias("a"), F.col("lo").alias("b")), f"{folder}/clusters")
    more = saved(block_links(members, clusters, linked, sets, folder), f"{folder}/more")
    if not more.isEmpty():
        linked = components(links.unionByName(more), f"{folder}/all")
    mine = signed.select("doc_id", "node").join(linked.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left")
    return mine.select("doc_id", "node", F.coalesce("component", "node").alias("group"))


def classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept."""
    folder = run_dir(docs.sparkSession, "neardup")
    mine = saved(grouped(docs, folder).select("doc_id", "group"), f"{folder}/groups")
    named = mine.groupBy("group").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")).withColumnRenamed("group", "of")
    named = saved(named, f"{folder}/named")
    return mine.join(named, F.col("group") == F.col("of")).select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the one of the least doc_id (null only if all are),
    and of its texts the one of the least hash. Rows are told apart by doc_id and text; of
    rows that repeat both, one stays."""
    folder = run_dir(docs.sparkSession, "neardup")
    mine = saved(grouped(docs, folder), f"{folder}/groups")
    first = mine.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first"))
    first = saved(first.select(F.col("group").alias("of"), F.col("first.doc_id").alias("first_id"), F.col("first.node").alias("first_node")), f"{folder}/first")
    mine = mine.join(first, F.col("group") == F.col("of"))
    mine = mine.withColumn("stays", F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("node") == F.col("first_node")))
    marks = mine.groupBy("doc_id", "node", "stays").agg(F.count(F.lit(1)).alias("rows")).filter("not stays or rows > 1")
    marks = saved(marks.select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"), F.col("stays").alias("__stays")), f"{folder}/marks")
    # Rows that the bit table rules out pass without a shuffle.
    id_ = F.col("row.doc_id").cast("long")
    marked = in_words(packed(docs), F.xxhash64(id_), bit_words(marks.select(F.xxhash64("__id").alias("h"))))
    asked = marked.filter("__hit").withColumn("__text", F.xxhash64(norm_text("row.text")))
    asked = asked.join(marks, id_.eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__node")), "left")
    out = marked.filter(~F.col("__hit")).select("row").unionByName(asked.filter("__stays is null").select("row"))
    if not marks.filter("__stays").isEmpty():
        out = out.unionByName(asked.filter("__stays").dropDuplicates(["__id", "__node"]).select("row"))
    return out.select("row.*")

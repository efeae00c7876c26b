"""Mixing sources to target weights by hierarchical budgeting.

Domains, their languages and their sources form a tree; each node has a weight
among its siblings. A leaf can give its tokens ``epochs`` times, a node what
its leaves can. The budget goes down the tree: at each node children get shares
by weight, a child that can't fill its share takes what it has, and what is
left goes to its siblings by their weights. A shortage in a leaf is thus made up by
its siblings, then by the other languages of the domain, then by other domains.

A leaf's budget is whole epochs plus a token-prefix of one more: its documents in
the order of a seeded hash of (seed, epoch, doc_id), as long as the running sum of
tokens stays within the rest. That cut is found without sorting a leaf: token sums
per leaf and hash bucket, a running sum over buckets, and the exact order only
in the one bucket where the budget ends (buckets hold some ten thousand documents).
One cutoff per leaf remains, so choosing rows takes a join with the leaves,
no sort, and no shuffle of texts where the leaves are few.

Only DataFrame functions. The driver reads two numbers: documents and tokens.

Defined cases: tokens are words between ASCII white space; null text has none.
Null lang or source count as ``unknown``. A document without tokens never costs
budget: it comes with whole epochs, and with a prefix that it stands in. Null
doc_ids are hashed as a missing part; rows that repeat a doc_id are taken or left
together. Shares are rounded down (less than one token a node). Weights of 0 get nothing.
An empty table gives no rows. Extra columns are kept by ``mixed``, ignored by ``choose``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equilibra.llm._work import packed, run_dir, saved

LEAF = ["__domain", "__lang", "__source"]


@dataclass(frozen=True)
class Mix:
    """The weighted tree. ``domains`` names the sources of each domain; sources not
    named belong to ``other``. Weights are whole numbers among siblings, 1 where not given."""

    domains: dict[str, tuple[str, ...]]
    domain_weights: dict[str, int] = field(default_factory=dict)
    language_weights: dict[str, int] = field(default_factory=dict)
    source_weights: dict[str, int] = field(default_factory=dict)
    share: float = 1.0  #: budget in tokens, as a share of the table's
    epochs: int = 4
    seed: int = 7


WEB = tuple(f"src{k}" for k in range(10))
BOOKS = tuple(f"src{k}" for k in range(10, 15))
NEWS = tuple(f"src{k}" for k in range(15, 20))
PRODUCTION = Mix({"web": WEB, "books": BOOKS, "news": NEWS}, {"web": 5, "books": 3, "news": 2}, {"en": 4, "de": 2, "fr": 2})


def _choice(value: Column, pairs: dict, default) -> Column:
    """value looked up in a small dictionary."""
    if not pairs:
        return F.lit(default)
    table = F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))
    return F.coalesce(F.try_element_at(table, value), F.lit(default))


def _leaves(docs: DataFrame, mix: Mix) -> DataFrame:
    owners = {s: d for d, sources in mix.domains.items() for s in sources}
    source = F.coalesce("source", F.lit("unknown"))
    return docs.withColumns({"__domain": _choice(source, owners, "other"), "__lang": F.coalesce("lang", F.lit("unknown")), "__source": source})


def _fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Give each parent's ``budget`` to its children (weight ``w``, most ``cap``): adds ``got``."""
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = siblings.orderBy(F.col("cap") / F.col("w"), name)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    nodes = nodes.withColumn("b", F.least("budget", F.sum("cap").over(siblings)))
    nodes = nodes.withColumn("w_rest", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    nodes = nodes.withColumn("c_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    nodes = nodes.withColumn("full", wide("cap") * wide("w_rest") <= (wide("b") - wide("c_before")) * wide("w"))
    nodes = nodes.withColumn("b_left", F.col("b") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(siblings), F.lit(0)))
    nodes = nodes.withColumn("w_left", F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings))
    share = F.expr("cast((cast(b_left as decimal(20,0)) * cast(w as decimal(18,0))) div w_left as long)")
    return nodes.withColumn("got", F.when(F.col("full"), F.col("cap")).otherwise(share)).drop("b", "w_rest", "c_before", "full", "b_left", "w_left", "budget")


def budgets(leaves: DataFrame, mix: Mix, budget: int) -> DataFrame:
    """Leaves (LEAF, n) with ``whole`` epochs and the ``rest`` in tokens."""
    caps = leaves.withColumn("leaf_cap", F.col("n") * mix.epochs)

    def level(keys: list[str], weights: Column, above: DataFrame | None) -> DataFrame:
        nodes = caps.groupBy(*keys).agg(F.sum("leaf_cap").alias("cap")).withColumn("w", weights.cast("long")).filter("w > 0")
        nodes = nodes.withColumn("budget", F.lit(budget).cast("long")) if above is None else nodes.join(above, keys[:-1])
        return _fill(nodes, keys[:-1], keys[-1]).select(*keys, F.col("got").alias("budget"))

    top = level(LEAF[:1], _choice(F.col("__domain"), mix.domain_weights, 1), None)
    mid = level(LEAF[:2], _choice(F.col("__lang"), mix.language_weights, 1), top)
    low = level(LEAF, _choice(F.col("__source"), mix.source_weights, 1), mid)
    given = leaves.join(low, LEAF).filter("n > 0")
    return given.withColumn("whole", F.expr("budget div n")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("n"))


def _hash(mix: Mix) -> Column:
    """60 bits that order a leaf's documents in its partial epoch."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(mix.seed)), F.col("whole").cast("string"), F.col("doc_id").cast("string"))), 1, 15), 16, 10).cast("long")


def cutoffs(docs: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf: LEAF, ``whole`` epochs, and the last (hash, doc_id) of the prefix, ``cut_h`` and ``cut_id``."""
    base = run_dir(docs.sparkSession, "mixing")
    tokens = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    table = saved(_leaves(docs.select("doc_id", "text", "lang", "source"), mix).select("doc_id", *LEAF, tokens.alias("tokens")), f"{base}/tokens")
    leaves = saved(table.groupBy(*LEAF).agg(F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("docs")), f"{base}/leaves")
    whole = leaves.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("docs"), F.lit(0)).alias("docs")).first()
    given = saved(budgets(leaves.select(*LEAF, "n"), mix, int(whole["n"] * mix.share)), f"{base}/budgets")
    shift = 60 - max(6, (whole["docs"] // 10_000).bit_length())
    hashed = table.join(given.select(*LEAF, "whole", "rest"), LEAF).withColumn("h", _hash(mix)).withColumn("bucket", F.shiftright("h", shift))
    sums = hashed.groupBy(*LEAF, "bucket").agg(F.sum("tokens").alias("t"), F.max("rest").alias("rest"))
    leaf = Window.partitionBy(*LEAF)
    running = sums.withColumn("upto", F.sum("t").over(leaf.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    ends = running.filter("upto > rest").groupBy(*LEAF).agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before")), "bucket").alias("e")).select(*LEAF, "e.bucket", "e.before")
    ends = saved(ends, f"{base}/ends")
    near = hashed.join(ends, [*LEAF, "bucket"]).groupBy(*LEAF, "h", "doc_id").agg(F.sum("tokens").alias("t"), F.max("rest").alias("rest"), F.max("before").alias("before"))
    near = near.withColumn("upto", F.col("before") + F.sum("t").over(leaf.orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
    last = near.filter("upto <= rest").groupBy(*LEAF).agg(F.max(F.struct("h", "doc_id")).alias("last"))
    cut = given.join(ends, LEAF, "left").join(last, LEAF, "left")
    at = F.when(F.col("rest") == 0, F.lit(-1)).otherwise(F.coalesce("last.h", F.shiftleft("bucket", shift) - 1))
    return saved(cut.select(*LEAF, "whole", at.cast("long").alias("cut_h"), F.col("last.doc_id").alias("cut_id")), f"{base}/cutoffs")


def _taken(docs: DataFrame, mix: Mix) -> DataFrame:
    """Rows of ``docs`` (with LEAF) once for each epoch that takes them, numbered ``__epoch``."""
    chosen = docs.join(cutoffs(docs, mix), LEAF).withColumn("__h", _hash(mix))
    inside = (F.col("__h") < F.col("cut_h")) | ((F.col("__h") == F.col("cut_h")) & (F.col("cut_id").isNull() | F.col("doc_id").isNull() | (F.col("doc_id") <= F.col("cut_id"))))
    times = F.col("whole") + F.when(inside, 1).otherwise(0)
    return chosen.withColumn("__times", times.cast("long")).filter("__times > 0").withColumn("__epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__times") - 1)))


def choose(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """One row for each time a document is taken: doc_id, domain, lang, source, epoch."""
    taken = _taken(_leaves(docs.select("doc_id", "text", "lang", "source"), mix), mix)
    return taken.select("doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"), F.col("__source").alias("source"), F.col("__epoch").alias("epoch"))


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all their columns, as often as it takes them."""
    rows = packed(docs).select("row", "row.doc_id", "row.text", "row.lang", "row.source")
    return _taken(_leaves(rows, mix), mix).select("row.*")

"""URL rules by a sort-merge range join over nested intervals.

A rule (verdict, host, path) fits its host and all subdomains where the url's
path starts with the rule's. With the host's labels reversed, "host and its
subdomains" is a prefix, and a prefix is an interval of sorted keys: from
``com example`` up to the next key that doesn't start with it. A key is the
first characters of the path, as many as a rule's path has, then the reversed
host, so rules of the same path length are intervals on one line; they nest or are
apart. Rules become boundaries: at each, the stack of rules that are open from
there on. Urls and boundaries are sorted together and swept; a url takes the top
of the stack of the last boundary before it. One sweep per distinct length of
rule paths; of the tops, the longest rule (host and path) wins.

Urls are dealt over sweeps by a hash of the row and its place, so neither a hot host nor a
hot url meets in one task; every sweep gets the boundaries (two per rule).
Only page_id and url are read.

Defined cases: null url, or one without ``://``: host and path are empty, no rule
fits. No fitting rule: rule null, verdict ``default``. A rule given with both
verdicts blocks. Equal lengths: the longer host wins. Null or repeated
page_ids are judged row by row; no rows or no rules are fine. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Separators in keys: between path and host, after each label, and the first one past it.
CUT, LABEL, PAST = "\x00", "\x01", "\x02"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _plain(text: Column) -> Column:
    return F.translate(text, CUT + LABEL + PAST, "���")


def _labels(name: Column) -> Column:
    return F.reverse(F.split(_plain(name), r"\."))


def _joined(labels: Column) -> Column:
    return F.concat(F.array_join(labels, LABEL), F.lit(LABEL))


def boundaries(rules: DataFrame) -> DataFrame:
    """(width, key, stack): from ``key`` on, the rules open among those of that path length.

    A stack lists (length, host length, rule, verdict) from the widest rule to the narrowest.
    """
    one = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    one = one.select(
        _labels(F.translate("host", UPPER, LOWER)).alias("labels"),
        F.length("path").alias("width"),
        _plain(F.col("path")).alias("path"),
        F.struct((F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host"), F.concat("host", "path").alias("rule"), "verdict").alias("entry"),
    )
    keyed = one.withColumn("key", F.concat("path", F.lit(CUT), _joined(F.col("labels"))))
    around = keyed.select("key", "width", "path", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("depth"))
    around = around.select("key", "width", F.concat("path", F.lit(CUT), _joined(F.slice("labels", F.lit(1), F.col("depth")))).alias("outer"))
    outer = keyed.select(F.col("key").alias("outer"), "entry")
    stacks = around.join(outer, "outer").groupBy("width", "key").agg(F.sort_array(F.collect_list("entry")).alias("stack"))
    opens = stacks.select("width", "key", "stack")
    closes = stacks.select("width", F.expr(f"concat(substring(key, 1, length(key) - 1), '{PAST}')").alias("key"), F.expr("slice(stack, 1, size(stack) - 1)").alias("stack"))
    return opens.unionByName(closes)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", sweeps: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of ``pages``."""
    spark = pages.sparkSession
    sweeps = sweeps or max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    widths = sorted(r["w"] for r in rules.select(F.length("path").alias("w")).distinct().collect())
    urls = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col("url").alias("__url"))
    if not widths:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    edges = boundaries(rules)
    stack_type = edges.schema["stack"].dataType
    reversed_host = _joined(_labels(F.col("host")))
    found = urls.select(
        F.lit(True).alias("is_url"),
        F.pmod(F.xxhash64("page_id", "__url", F.monotonically_increasing_id()), F.lit(sweeps)).alias("sweep"),
        "page_id",
        "host",
        "path",
        *(F.when((F.length("path") >= w) & (F.col("host") != ""), F.concat(_plain(F.substring("path", 1, w)), F.lit(CUT), reversed_host)).alias(f"key_{w}") for w in widths),
        *(F.lit(None).cast(stack_type).alias(f"stack_{w}") for w in widths),
    )
    marks = edges.select(
        F.lit(False).alias("is_url"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sweeps - 1).cast("long"))).alias("sweep"),
        F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
        *(F.when(F.col("width") == w, F.col("key")).alias(f"key_{w}") for w in widths),
        *(F.when(F.col("width") == w, F.col("stack")).alias(f"stack_{w}") for w in widths),
    )

    def sweep(rows: DataFrame, w: int) -> DataFrame:
        order = Window.partitionBy("sweep").orderBy(F.col(f"key_{w}").asc_nulls_first(), "is_url").rowsBetween(Window.unboundedPreceding, 0)
        stack = F.last(f"stack_{w}", ignorenulls=True).over(order)
        return rows.withColumn(f"top_{w}", F.when(F.col("is_url") & F.col(f"key_{w}").isNotNull(), F.try_element_at(stack, F.lit(-1))))

    swept = reduce(sweep, widths, found.unionByName(marks)).filter("is_url")
    best = F.array_max(F.array(*(F.col(f"top_{w}") for w in widths)))
    return swept.select("page_id", "host", "path", best.alias("best")).select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))

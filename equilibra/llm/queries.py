"""Queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from equilibra.llm import classifier, dedup, mixing, neardup, packing, quality, resampling, seekable, sharding, toxicity, urls, warc, whitening
from equilibra.llm._work import table

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
SHARDS, SLOTS = sharding.shard_names(40), 4099


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def rules(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(verdict, host, path)")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicates(table(spark, sf_dir, "documents"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), rules(spark))


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.choose(table(spark, sf_dir, "documents"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seekable.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.round_trip(table(spark, sf_dir, "documents"), ["doc_id"], SHARDS, SLOTS).select("doc_id", "slot", "shard")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_duplicates": near_duplicates,
        "op2_packing": packed,
        "op3_exact_dedup": exact_duplicates,
        "op4_url_filter": url_verdicts,
        "op5_mixing": mixture,
        "op6_token_files": token_files,
        "op7_sharding": shards,
        "op8_quality_rules": quality_rules,
        "op9_quality_classifier": quality_scores,
        "op10_warc": captures,
        "op11_whitening": whitened,
        "op12_resampling": resampled,
        "op13_toxicity": toxic_scores,
    }


#: The words between ASCII white space, as DuckDB's pattern.
WORD = r"[^\x20\x09-\x0D]+"


def _dedup_sql() -> str:
    return r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)"""


def _urls_sql() -> str:
    rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return rf"""
WITH r(verdict, rhost, rpath) AS (VALUES {rows}),
u AS (SELECT page_id, coalesce(lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)), '') AS host, coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
best AS (SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (host, path)"""


def _shards_sql() -> str:
    table = ", ".join(f"'{SHARDS[k]}'" for k in sharding.lookup_table(SHARDS, SLOTS))
    return f"""
WITH s AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, ([{table}])[slot + 1] AS shard FROM s"""


def mixture_sql(m: mixing.Mix = mixing.PRODUCTION) -> str:
    pick = lambda c, pairs, other: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in pairs.items()) + f" ELSE {other} END" if pairs else str(other)
    domain = pick("source", {s: f"'{d}'" for d, names in m.domains.items() for s in names}, "'other'")

    def fill(name: str, nodes: str, keys: str, parent: str) -> str:
        part = f"PARTITION BY {parent}" if parent else ""
        last = keys.rsplit(", ", 1)[-1]
        return f"""
{name}_a AS (SELECT *, least(budget, sum(cap) OVER ({part})) AS b, sum(w) OVER ({part} ORDER BY cap / w, {last} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest,
  coalesce(sum(cap) OVER ({part} ORDER BY cap / w, {last} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c_before FROM ({nodes})),
{name}_b AS (SELECT *, cap * w_rest <= (b - c_before) * w AS sated FROM {name}_a),
{name} AS (SELECT {keys}, CAST(CASE WHEN sated THEN cap ELSE ((b - coalesce(sum(cap) FILTER (sated) OVER ({part}), 0)) * w) // sum(w) FILTER (NOT sated) OVER ({part}) END AS BIGINT) AS budget FROM {name}_b)"""

    top = f"SELECT domain, sum(cap) AS cap, {pick('domain', m.domain_weights, 1)} AS w, any_value(budget) AS budget FROM leaf, total GROUP BY domain"
    mid = f"SELECT domain, lang, sum(cap) AS cap, {pick('lang', m.language_weights, 1)} AS w, any_value(top.budget) AS budget FROM leaf JOIN top USING (domain) GROUP BY domain, lang"
    low = f"SELECT domain, lang, source, sum(cap) AS cap, {pick('source', m.source_weights, 1)} AS w, any_value(mid.budget) AS budget FROM leaf JOIN mid USING (domain, lang) GROUP BY domain, lang, source"
    return rf"""
WITH d AS (SELECT doc_id, {domain} AS domain, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS HUGEINT) AS n, CAST({m.epochs} * sum(tokens) AS HUGEINT) AS cap FROM d GROUP BY domain, lang, source),
total AS (SELECT CAST(floor({m.share} * sum(n)) AS HUGEINT) AS budget FROM leaf),
{fill("top", top, "domain", "")}, {fill("mid", mid, "domain, lang", "domain")}, {fill("low", low, "domain, lang, source", "domain, lang")},
given AS (SELECT domain, lang, source, CAST(budget // n AS BIGINT) AS whole, budget - (budget // n) * n AS rest FROM leaf JOIN low USING (domain, lang, source) WHERE n > 0),
h AS (SELECT d.*, whole, rest, CAST('0x' || substr(md5(concat_ws('|', '{m.seed}', CAST(whole AS VARCHAR), CAST(doc_id AS VARCHAR))), 1, 15) AS BIGINT) AS h FROM d JOIN given USING (domain, lang, source)),
run AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id) AS upto FROM h),
times AS (SELECT *, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS k FROM run)
SELECT doc_id, domain, lang, source, unnest(range(k)) AS epoch FROM times WHERE k > 0"""


def oracle_sql() -> dict[str, str]:
    """For the operators that SQL can express; tests hold the others against brute force."""
    return {"op3_exact_dedup": _dedup_sql(), "op4_url_filter": _urls_sql(), "op5_mixing": mixture_sql(), "op7_sharding": _shards_sql()}

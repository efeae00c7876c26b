"""Resampling against brute force over every word of every text."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from equilibra.llm import resampling
from equilibra.llm.queries import queries
from equilibra.llm.resampling import Sampler

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, s):
    w = words(text)
    return [zlib.crc32(" ".join(w[k : k + n]).encode()) % s.buckets for n in range(s.shortest, s.longest + 1) for k in range(len(w) - n + 1)]


def brute(docs, targets, s):
    """{doc_id: (doc_id, n_features, weight, score, rank)}; ids must differ."""
    own = {d: grams(t, s) for d, t in docs}
    source, target = Counter(x for f in own.values() for x in f), Counter(x for t in targets for x in grams(t, s))
    S, T, m = source.total(), target.total(), s.buckets
    gain = [math.floor(1000 * math.log((target[b] + 1) * (S + m) / ((source[b] + 1) * (T + m)))) for b in range(m)]
    out = {}
    for d, f in own.items():
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{s.seed}:{d}".encode()).hexdigest()[:8], 16)
        out[d] = [d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None]
    able = sorted((d for d, t in docs if len(words(t)) >= s.least_words), key=lambda d: (-out[d][3], d))
    for k, d in enumerate(able[: len(able) * s.percent // 100], 1):
        out[d][4] = k
    return {d: tuple(x) for d, x in out.items()}


def test_whole_table_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    targets = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries()["op12_resampling"](spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert {r["doc_id"]: tuple(r) for r in got.collect()} == brute(docs, targets, Sampler())


@pytest.mark.parametrize("s", [Sampler(shortest=2, longest=3, buckets=70_000, percent=50, least_words=3), Sampler(longest=2, percent=100, least_words=0)])
def test_longer_grams_and_edges(spark, s):
    rows = [(1, None), (2, ""), (3, "..."), (4, "one"), (5, "a b a b a b a"), (6, "É-É  ÀB\tx9_ß\x7fz"), (7, "A b\nC"), (8, "lang " * 30_000), (9, "a b c d"), (10, "a b c d")]
    targets = ["A B c", None, "é é"]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, features string, before int")
    got = resampling.resample(frame, spark.createDataFrame([(t,) for t in targets], "text string"), s)
    assert {r["doc_id"]: tuple(r) for r in got.collect()} == brute(rows, targets, s)


def test_null_and_repeated_ids_and_clashing_names(spark):
    rows = [(None, "a b c", 0)] * 5 + [(1, "a b c", 0), (1, "q", 1)] + [(k, f"w{k} x", k) for k in range(2, 15)]
    docs, target = spark.createDataFrame(rows, "doc_id long, text string, drawn int"), spark.createDataFrame([("a b",)], "text string")
    got = resampling.resample(docs, target, Sampler(percent=50, least_words=1))
    assert got.count() == 20 and sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 11))
    kept = resampling.draw(docs, target, Sampler(percent=100, least_words=1))
    assert kept.columns == docs.columns and Counter(map(tuple, kept.collect())) == Counter(rows)
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert {r["rank"] for r in resampling.resample(docs, target.limit(0)).collect()} == {None}


def test_spans_are_those_of_the_pattern():
    text = resampling.collapsed("  The cat -- THE cat\nsat ")
    assert text == b"the cat the cat sat"
    s = Sampler(shortest=2, longest=2)
    assert [m.span() for m in resampling.patterns(s)[0].finditer(text, overlapped=True)] == [(0, 7), (4, 11), (8, 15), (12, 19)]

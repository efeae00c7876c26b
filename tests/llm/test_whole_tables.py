"""Queries without SQL, and the pipeline's stages, against brute force over whole tables."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from equilibra.llm import _text
from equilibra.llm.queries import mixture_sql, queries, tokenizer
from tests.llm.test_operators import brute_classes

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def plain_ids(name, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer(name))
    return [np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for t in texts]


def test_packing(spark, docs):
    got = queries()["op2_packing"](spark, SF).toPandas()
    want = dict(zip([d for d, _ in docs], plain_ids("word_bpe_49k.json", [t for _, t in docs]), strict=True))
    assert set(got.doc_id) == set(want)
    for doc, g in got.sort_values("start").groupby("doc_id"):
        ids = want[doc]
        assert set(g.doc_tokens) == {len(ids) // 4} and g.start.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() == len(ids) // 4
        assert g.ids_crc32.tolist() == [zlib.crc32(ids[4 * s : 4 * (s + n)]) for s, n in zip(g.start, g.length, strict=True)]
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 4096
    used = got.groupby("sequence_id").length.sum()
    assert 1 - used.sum() / (4096 * len(used)) < 0.1


def test_token_files(spark, docs):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries()["op6_token_files"](spark, SF).collect()}
    start, want = 0, {}
    for (doc, _), ids in zip(docs, plain_ids("byte_bpe_50k.json", [t for _, t in docs]), strict=True):
        want[doc] = (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert got == want


def test_archives(spark):
    pages = [(r["page_id"], (r["html"] or "").encode()) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    last = defaultdict(int)
    for page, html in pages:
        last[html] = max(last[html], page)
    want = {}
    for page, html in pages:
        sha1 = base64.b32encode(hashlib.sha1(html).digest()).decode()
        want[page] = (len(html), sha1, "response", None) if last[html] == page else (len(html), sha1, "revisit", last[html])
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in queries()["op10_warc"](spark, SF).collect()}
    assert got == want


def brute_base(text):
    """The columns that the rules name, straight from their definition."""
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in BLANKS:
            words += [word] if word else []
            word = ""
        else:
            word += c
    seen = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    often = {j for k in range(len(words) - 4) if seen[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(often), n < 10 or 100 * len(often) > 20 * n


def test_quality_columns(spark, docs):
    got = {r["doc_id"]: r for r in queries()["op8_quality_rules"](spark, SF).collect()}
    assert set(got) == {d for d, _ in docs}
    for doc, text in docs:
        r = got[doc]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_base(text), doc
        assert not (r["base_failed"] and r["kept"])


def test_quality_scores(spark, docs):
    """The same discriminant by plain numpy: covariances of centred rows, determinants, inverses."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _ in docs}
    x = {d: np.array(_text.statistics(t or "")) for d, t in docs}
    sides = [np.array([x[d] for d, _ in docs if d in labels and not held[d] and labels[d] == k]) for k in (0, 1)]
    total = sum(map(len, sides))
    own = [np.cov(s.T, bias=True) for s in sides]
    pooled = sum(len(s) * c for s, c in zip(sides, own, strict=True)) / total
    spread = np.diag(np.maximum(np.diag(pooled), 1e-9))
    pooled = 0.8 * pooled + 0.2 * spread
    shrunk = [0.8 * c + 0.2 * pooled + 1e-3 * spread for c in own]

    def density(row, k):
        off = row - sides[k].mean(0)
        return np.log(len(sides[k]) / total) - 0.5 * np.linalg.slogdet(shrunk[k])[1] - 0.5 * off @ np.linalg.inv(shrunk[k]) @ off

    for r in queries()["op9_quality_classifier"](spark, SF).collect():
        row = x[r["doc_id"]]
        want = 1 / (1 + np.exp(np.clip(density(row, 0) - density(row, 1), -700, 700)))
        assert abs(r["score"] - want) < 1e-6 and r["held_out"] == held[r["doc_id"]] and r["predicted"] == int(r["score"] >= 0.3)


def test_pipeline_stage_by_stage(spark, docs, tmp_path):
    """Each stage's rows, on what the one before kept, are those of brute force."""
    frame, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert out.schema.names == frame.schema.names
        out.write.parquet(f"{tmp_path}/{name}")
        before, frame = frame.collect(), spark.read.schema(frame.schema).parquet(f"{tmp_path}/{name}")
        after = frame.collect()
        assert not Counter(map(tuple, after)) - Counter(map(tuple, before))
        seen[name] = (before, sorted(r["doc_id"] for r in after))
    before, got = seen["quality_rules"]
    kept = {r["doc_id"] for r in queries()["op8_quality_rules"](spark, SF).filter("kept").collect()}
    assert got == sorted(kept) and not any(brute_base(t)[-1] for d, t in docs if d in kept)
    before, got = seen["exact_dedup"]
    first: dict[str, int] = {}
    for r in before:
        norm = " ".join(("x" + (r["text"] or "").translate({ord(c): " " for c in BLANKS}) + "x").split(" "))
        while "  " in norm:
            norm = norm.replace("  ", " ")
        first[norm] = min(r["doc_id"], first.get(norm, r["doc_id"]))
    assert got == sorted(first.values())
    before, got = seen["near_dedup"]
    rows = sorted(((r["doc_id"], r["text"]) for r in before), key=lambda r: r[0])
    group = brute_classes([t for _, t in rows])
    assert got == sorted(rows[k][0] for k in set(group))
    before, got = seen["mixing"]
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(before, frame.schema).toPandas())
    assert got == sorted(d for (d,) in con.sql(f"SELECT doc_id FROM ({mixture_sql(corpus_pipeline.MIX)})").fetchall())
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, SF).toPandas()
    assert sorted(set(packed.doc_id)) == got
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    sizes = dict(zip(texts, (len(x) // 4 for x in plain_ids("word_bpe_49k.json", texts.values())), strict=True))
    assert packed.groupby("doc_id").length.sum().to_dict() == sizes and packed.groupby("sequence_id").length.sum().max() <= 4096

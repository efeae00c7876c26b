"""The operators against brute force, on edge cases and on sf0.001."""

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from equilibra.llm import _text, classifier, dedup, mixing, neardup, packing, quality, seekable, sharding, urls, warc
from equilibra.llm._tokens import Encoder
from equilibra.llm.queries import queries, tokenizer
from equilibra.llm.quotient import QuotientFilter

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, node int, kept string"
PROSE = " ".join(f"word{k % 37} thing{k}" for k in range(60))
EDGE = [
    (1, None, "en", "src0", 0, "x", 1, "y"),
    (2, "", None, "src0", 0, None, None, None),
    (3, "  a\tb \n", "en", None, 5, None, None, None),
    (4, " a b ", "en", "src1", 5, None, None, None),
    (None, PROSE, "en", "src0", 9, None, None, None),
    (5, PROSE, "en", "src0", 9, None, None, None),
    (5, PROSE, "en", "src0", 9, None, None, None),
    (6, PROSE + " end", "de", "src9", 9, None, None, None),
    (7, "lone words here", "fr", "src15", 9, None, None, None),
    (8, PROSE * 400, "en", "src0", 9, None, None, None),
    (9, "tab\x0bé ΑΣ <|endoftext|> don't, x.", "es", "src3", 9, None, None, None),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_tokens_equal_whole_texts(docs):
    texts = [r["text"] for r in docs.collect()] + [r[1] or "" for r in EDGE[:-2]] + [EDGE[-1][1], "\0, a", "a.b, 3.5 c. Dd\nEe", " x", "é́", "..", "a\n\nb"]
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        enc = Encoder(tokenizer(name), spaced, room=500)
        for _ in range(2):
            assert enc.ids(texts) == [enc.pieces.whole(t) + enc.end for t in texts]


def random_texts(count, seed):
    """Texts of all kinds of characters, white space, marks, cases and normal forms."""
    rng, kinds = random.Random(seed), {}
    for c in range(0x30000):
        kinds.setdefault(unicodedata.category(chr(c)), []).append(chr(c))
    kinds.pop("Cs")
    white = [chr(c) for c in range(0x3001) if chr(c).isspace()] + ["\u200b", "\ufeff", "\xad"]
    usual = [*"  \n\n,.!?;:*$%&#|'-_09aAbBzZ", "\u0130", "Σ", "ς", "ß", "ﬁ", "e\u0301", "\u0307", "\u0345", "'s", "<|endoftext|>", "<|ENDOFTEXT|>", "\0", "Ω", "the", "House,", "été.", "straße ", "Привет", "日本"]

    def piece():
        k = rng.random()
        return rng.choice(usual) if k < 0.5 else rng.choice(white) if k < 0.6 else chr(rng.randrange(32, 0x590)) if k < 0.8 else rng.choice(rng.choice(list(kinds.values())))

    return ["".join(piece() for _ in range(rng.choice((1, 2, 3, 4, 6, 9, 14)))) for _ in range(count)]


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_random_texts_have_the_library_s_ids(name, spaced):
    from tokenizers import Tokenizer

    plain, enc = Tokenizer.from_file(tokenizer(name)), Encoder(tokenizer(name), spaced, room=3000)
    texts = ["\xa0\xa0foo bar", "\xa0\tfoo", "foo\xa0", "a \xa0b", "\u0130,Σ", "\u0130,e\u0301", *random_texts(12_000, 11)]
    for k in range(0, len(texts), 300):
        some = texts[k : k + 300]
        want = [np.array([*plain.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes() for t in some]
        assert enc.ids(some) == want


def test_added_tokens_are_one_id(spark):
    from tokenizers import Tokenizer

    texts = ["a b <|endoftext|> c", "a b <|ENDOFTEXT|> c", "x<|endoftext|>. y\n<|startoftext|>", "<|endoftext|>", "<|EndOfText|>,\n<|endoftext|>, z", "Σ <|endoftext|> e\u0301 <|STARTOFTEXT|>", "a b c, d."]
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        plain = Tokenizer.from_file(tokenizer(name))
        want = [np.array([*plain.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes() for t in texts]
        enc = Encoder(tokenizer(name), spaced)
        assert enc.ids(texts) == want and [enc.ids([t])[0] for t in reversed(texts)] == want[::-1]
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        if spaced:
            got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in seekable.round_trip(frame, tokenizer(name)).collect()}
            assert got == {k: (len(x) // 4, zlib.crc32(x)) for k, x in enumerate(want)}
        else:
            got = {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in packing.pack(frame, tokenizer(name)).collect()}
            assert got == {k: (len(x) // 4, zlib.crc32(x)) for k, x in enumerate(want)}


def test_filter_merges_losslessly():
    rng = np.random.default_rng(1)
    for slice_bits, low in ((0, 1), (4, 3 << 60), (24, (7 << 40) + 5)):
        span = 2**60 if slice_bits < 24 else 2**40
        pool = np.r_[rng.integers(0, span, 400), np.arange(40)].astype(np.uint64) + np.uint64(low)
        prints = np.r_[rng.choice(pool, 3000), np.repeat(pool[:1], 70_000)]
        make = lambda x: QuotientFilter.load(QuotientFilter.build(x, slice_bits=slice_bits).dump())
        whole = make(prints[:1000])
        for part in (prints[1000:1001], prints[:0], prints[1001:], np.sort(prints[5:9])):
            whole = whole.merge(make(part))
        want = Counter([*prints.tolist(), *prints[5:9].tolist()])
        assert dict(zip(*(x.tolist() for x in whole.items()), strict=True)) == want
        assert list(want) and all(whole.count(p) == n for p, n in list(want.items())[:50]) and whole.count(low + span + 9) == 0
    large = QuotientFilter.build(np.array([5, 6, 5], np.uint64), np.array([2**61, 1, 3]), 24)
    assert {p: n for p, n in zip(*(x.tolist() for x in large.items()), strict=True)} == {5: 2**61 + 3, 6: 1} and large.count(5) == 2**61 + 3
    many = rng.integers(0, 2**60, 100_000).astype(np.uint64)
    assert len(QuotientFilter.build(many, slice_bits=4).dump()) < 10 * len(many)  # a fingerprint and its count take 16


def test_exact_dedup_edges(edge, none):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in dedup.duplicates(edge).collect()}
    assert {(1, 1, 2, True), (2, 1, 2, False), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 3, True), (None, 5, 3, False), (6, 6, 1, True)} <= got
    assert sorted(r["doc_id"] for r in dedup.drop_copies(edge).collect()) == [1, 3, 5, 6, 7, 8, 9]
    assert dedup.drop_copies(edge).columns == edge.columns
    assert dedup.duplicates(none).count() == dedup.drop_copies(none).count() == 0


def shingle_counts(text):
    words = (text or "").lower().encode().split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(texts):
    sets, root = [shingle_counts(t) for t in texts], list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = (a & b).total()
            if a == b or both and both / (a.total() + b.total() - both) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(k) for k in range(len(texts))]


def test_near_classes(spark, docs, edge, none):
    rows = docs.select("doc_id", "text").orderBy("doc_id").toPandas()
    want = brute_classes(rows.text)
    got = neardup.classes(docs).toPandas().set_index("doc_id").loc[rows.doc_id]
    assert got.class_id.tolist() == [rows.doc_id[k] for k in want]
    edges = {(r["doc_id"], r["class_id"], r["class_size"]) for r in neardup.classes(edge).collect()}
    assert {(2, 1, 2), (4, 3, 2), (6, 5, 4), (None, 5, 4), (7, 7, 1), (8, 8, 1)} <= edges
    assert neardup.classes(none).count() == 0 and neardup.drop_near_copies(none).count() == 0


def test_near_copies_are_dropped_by_row(spark):
    a, b, c = ("".join(f"{w}{k} " for k in range(80)) for w in ("north", "south", "east"))
    rows = [(1, a), (2, a + "more"), (2, "a text of its own"), (3, b), (3, b), (3, b.upper()), (None, c), (None, c), (4, "x"), (None, "x"), (5, "a text of its own"), (2, None), (6, "clean")]
    got = neardup.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ids = Counter((r["doc_id"], (r["text"] or "").lower()) for r in got)
    assert ids == Counter([(1, a), (2, "a text of its own"), (3, b), (None, c), (4, "x"), (2, ""), (6, "clean")])


def test_blocks_find_what_pivots_leave():
    rng = np.random.default_rng(2)
    base = np.sort(rng.integers(0, 2**63, 100).astype(np.uint64))
    sets = [base, base[:95], base[:60], np.sort(rng.integers(0, 2**63, 50).astype(np.uint64))]
    args = np.arange(4), np.arange(4), np.array([False, True, True, True])
    assert neardup._links(*args, sets) == [(0, 1)]


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
    sig = neardup.dart_signatures([(h, a), (h, b), (h[:1], a[:1])], 4000)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_packing(edge, none):
    got = packing.pack(edge, tokenizer("word_bpe_49k.json"), capacity=256).toPandas()
    assert len(got.groupby(["doc_id", "start"], dropna=False)) <= len(got)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= g.padded.iloc[0] <= 256
    assert got[got.doc_id == 8].length.sum() == got[got.doc_id == 8].doc_tokens.iloc[0]
    assert got.sequence_id.nunique() <= 1.1 * got.length.sum() / 256 + 2
    assert packing.pack(none, tokenizer("word_bpe_49k.json")).count() == 0


def test_patterns_hold_the_demand():
    demand = {3: 50, 7: 31, 11: 12, 16: 3}
    plan = packing.patterns(demand, 16)
    held = Counter()
    for copies, counts in plan:
        assert sum(s * k for s, k in counts.items()) <= 16
        held.update({s: copies * k for s, k in counts.items()})
    assert held == demand


def test_url_rules(spark, none):
    pages = [(1, "http://WWW.Example.com/en/x?q"), (2, "ftp://a.net/es/"), (3, None), (4, "no scheme"), (5, "x://xcom/"), (6, "x://com"), (None, "x://b.example.com:8/en/")]
    rules = spark.createDataFrame([("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("allow", "net", "/es/")], "verdict string, host string, path string")
    frame = spark.createDataFrame(pages, "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(frame, rules).collect()}
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2] == ("a.net", "/es/", "net/es/", "block")
    assert got[3] == got[4] == ("", "", None, "allow")
    assert got[5][2] is None and got[6] == ("com", "", None, "allow")
    assert got[None] == ("b.example.com:8", "/en/", None, "allow")
    assert urls.judge(frame.limit(0), rules).count() == 0
    assert urls.judge(frame, rules.limit(0)).filter("rule is not null").isEmpty()


def test_mixing_edges(edge, none):
    got = mixing.mixed(edge, mixing.Mix({}, share=1.0, epochs=1))
    assert got.columns == edge.columns and got.count() <= edge.count()
    assert mixing.choose(none).count() == 0


def test_token_files(edge, none):
    got = seekable.round_trip(edge, tokenizer("byte_bpe_50k.json")).toPandas().sort_values("start")
    assert got.start.tolist() == [0, *got.n_tokens.cumsum()[:-1]] and len(got) == len(EDGE)
    enc = Encoder(tokenizer("byte_bpe_50k.json"), True)
    assert Counter(got.ids_crc32) == Counter(zlib.crc32(x) for x in enc.ids([r[1] for r in EDGE]))
    assert seekable.round_trip(none, tokenizer("byte_bpe_50k.json")).count() == 0


def test_frames_are_read_apart(tmp_path):
    from pyarrow import fs

    local = fs.LocalFileSystem()
    writer = seekable.Writer(local.open_output_stream(str(tmp_path / "f")), frame_ids=16)
    for k, ids in ((1, np.arange(21, dtype="<u4").tobytes()), (None, b"\0" * 4), (2, np.arange(100, dtype="<u4").tobytes())):
        writer.add(k, ids)
    writer.close()
    with local.open_input_file(str(tmp_path / "f")) as f:
        reader = seekable.Reader(f)
        assert reader.document(2).tolist() == list(range(100)) and reader.document(1).tolist() == [0]


def test_sharding(edge):
    table = sharding.lookup_table(sharding.shard_names(7), 101)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    with pytest.raises(ValueError):
        sharding.lookup_table(sharding.shard_names(3), 100)
    got = sharding.assign_shards(edge, ["doc_id"], sharding.shard_names(7), 101)
    assert got.count() == len(EDGE) and got.columns == [*edge.columns, "slot", "shard"]


def test_shards_hold_every_row_once(spark, docs, edge, none):
    frame = edge.drop("node", "h")
    got = sharding.round_trip(frame, ["doc_id"], sharding.shard_names(7), 101)
    table = sharding.lookup_table(sharding.shard_names(7), 101)
    want = Counter()
    for doc_id, text, lang, source, n_chars, _, _, kept in EDGE:
        slot = int(hashlib.md5(str("" if doc_id is None else doc_id).encode()).hexdigest()[:15], 16) % 101
        want[(doc_id, text, lang, source, n_chars, kept, slot, f"shard-{table[slot]:03d}")] += 1
    assert got.columns == [*frame.columns, "slot", "shard"] and Counter(map(tuple, got.collect())) == want
    assert all(f"/shard={r['shard']}/" in r["f"] for r in got.select("shard", F.input_file_name().alias("f")).collect())
    assert sharding.round_trip(none, ["doc_id"], sharding.shard_names(7), 101).count() == 0
    query = queries()["op7_sharding"](spark, SF)
    assert query.columns == ["doc_id", "slot", "shard"] and all("/shard=" in f for f in query.inputFiles())
    whole = spark.read.parquet(query.inputFiles()[0].split("/shard=")[0])
    assert Counter(map(tuple, whole.select(docs.columns).collect())) == Counter(map(tuple, docs.collect()))


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(4)
    field = quality.Field(rng.normal(size=len(_text.LINE_FEATURES)), rng.normal(size=(2, 2)))
    x = rng.normal(size=(7, len(_text.LINE_FEATURES)))
    score = lambda y: sum(x[k] @ field.lines for k in range(7) if y[k]) + sum(field.pairs[a, b] for a, b in zip(y, y[1:], strict=False))
    assert tuple(field.viterbi(x)) == max(product((0, 1), repeat=7), key=score)


def test_repeated_words(monkeypatch):
    rng = np.random.default_rng(5)
    for many in (0, 10**9):
        monkeypatch.setattr(_text, "MANY", many)
        for _ in range(50):
            words = [b"%d" % k for k in rng.integers(0, 3, rng.integers(0, 40))]
            seen = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
            want = {j for k in range(len(words) - 4) if seen[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
            assert _text.repeated_words(words) == len(want)


def test_quality_rules(spark, docs, edge, none):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    field = quality.learn(docs, labels)
    got = quality.judge(docs, field).join(labels, "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.9 and got[got.quality == 0].kept.mean() < 0.2
    for r in quality.judge(edge, field).collect():
        text = next(x[1] for x in EDGE if x[0] == r["doc_id"]) or ""
        assert r["n_words"] == len(re.findall(r"[^\x20\x09-\x0d]+", text))
        assert not r["kept"] or not r["base_failed"]
    assert quality.keep(edge, field).columns == edge.columns
    assert quality.judge(none, quality.learn(none, labels.limit(0))).count() == 0


def test_classifier(spark, docs, edge, none):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = classifier.classify(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.85
    assert classifier.classify(edge, labels).filter("score between 0 and 1").count() == len(EDGE)
    assert {r["score"] for r in classifier.classify(edge, labels.limit(0)).collect()} == {0.5}
    assert classifier.classify(none, labels).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/\r\nx", "<p>é"), (2, None, "<p>é"), (3, "u", None), (4, "u", ""), (None, "u", "<p>é"), (5, "u", "z" * 100_000)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()}
    e = warc.digest("<p>é".encode())
    assert got[2] == (5, e, "response", None) and got[1] == got[None] == (5, e, "revisit", 2)
    assert got[4][2:] == ("response", None) and got[3][2:] == ("revisit", 4) and got[5][0] == 100_000
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_orphan_records(spark):
    row = ("request", "<a>", "<gone>", None, "u", None, None, None, "f", 0)
    got = warc.assemble(spark.createDataFrame([row], warc.RECORD)).collect()
    assert len(got) == 1 and got[0]["response"] is None and len(got[0]["requests"]) == 1


def test_pipeline(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF).toPandas()
    assert len(got) and got.groupby("sequence_id").length.sum().max() <= 4096
    assert isinstance(got, pd.DataFrame) and [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]

"""Line labels: common lines against brute force, boilerplate planted into clean texts, held-out labels."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from equilibra.llm import _text, quality

SF = "/root/testdata/sf0.01"
NOTICE = ["Alle Rechte vorbehalten.", "Read our terms of use here", "Menu | Home | About us"]


def brute_common(texts, least, most):
    near, total = defaultdict(lambda: (Counter(), Counter())), 0
    for text in texts:
        if text is not None:
            total += text.count("\n") + 1
        kept = [x.strip(" \t\n\v\f\r") for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
        for x in set(kept):
            k = kept.index(x)
            near[x][0][kept[k - 1] if k else None] += 1
            near[x][1][kept[k + 1] if k + 1 < len(kept) else None] += 1
    floor = max(least, -(-total // most))
    return {_text.line_key(x) for x, sides in near.items() if any(len(c) >= floor and 2 * max(c.values()) <= c.total() for c in sides)}


def planted(seed=3, count=240):
    """(doc_id, text, quality): clean paragraphs with notices between, and junk; a copied text a hundred times."""
    rng, rows = random.Random(seed), []
    words = ["river", "stone", "walks", "under", "light", "house", "quiet", "morning", "letters", "garden", "follow", "seldom"]
    prose = lambda: " ".join(rng.choices(words, k=rng.randrange(14, 30))).capitalize() + "."
    for k in range(count):
        if k % 4:
            body = [prose() for _ in range(rng.randrange(3, 7))]
            for notice in rng.sample(NOTICE, rng.randrange(1, 3)):
                body.insert(rng.randrange(len(body) + 1), notice)
            rows.append((k, "\n".join(body), 1))
        else:
            rows.append((k, "\n".join("BUY!!! $$$ %d # CLICK" % rng.randrange(10**9) for _ in range(6)), 0))
    copied = "\n".join(prose() for _ in range(5))
    return rows + [(1000 + k, copied, 1) for k in range(100)]


@pytest.mark.parametrize("most", [100_000, 100])
def test_common_lines_as_brute_force(spark, most):
    texts = [*(r[1] for r in planted()), None, "", "\n \n", " Read our terms of use here\r\nx\nx\nx"]
    got = {r["h"] for r in quality.common_lines(spark.createDataFrame([(t,) for t in texts], "text string"), 5, most).collect()}
    assert got == brute_common(texts, 5, most)
    if most > 100:
        assert got == {_text.line_key(x) for x in NOTICE}


def test_notices_in_clean_texts_are_marked(spark):
    rows = planted()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    field = quality.learn(docs, spark.createDataFrame([(k, q) for k, _, q in rows], "doc_id long, quality int"))
    for _, text, good in rows:
        features, _ = _text.lines(text, field.known())
        assert field.viterbi(features).tolist() == [int(good and x not in NOTICE) for x in text.split("\n")]
    got = {r["doc_id"]: r for r in quality.judge(docs, field).collect()}
    for k, text, good in rows:
        assert got[k]["kept"] == bool(good)
        assert got[k]["content_words"] == sum(len(x.split()) for x in text.split("\n") if good and x not in NOTICE)


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.judge(docs, quality.learn(docs, labels)).join(labels, "doc_id").filter("crc32(cast(doc_id as string)) % 5 = 0")
    mixed = (F.col("content_words") > 0) & (F.col("content_words") < F.col("n_words"))
    got = {r["quality"]: r for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.avg(mixed.cast("int")).alias("mixed")).collect()}
    assert got[0]["kept"] < 0.1 and got[1]["kept"] > 0.93 and got[1]["mixed"] > 0.1


def test_long_texts_give_a_bounded_sample(spark):
    text = "\n".join(f"line {k} of a long text." for k in range(50_000))
    docs = spark.createDataFrame([(1, text), (1, text), (2, "JUNK!!! $$$"), (None, text), (3, None)], "doc_id long, text string")
    field = quality.learn(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 0)], "doc_id long, quality int"))
    assert len(field.common) == 0 and quality.judge(docs, field).count() == 5


def test_a_lines_rule_does_not_change_with_the_corpus(spark):
    """A notice among five different neighbours stays common however many other lines there are, and what
    ``judge`` and ``keep`` join in tables is what ``verdict`` says of one text."""
    rows = planted(count=40)
    rare = "Printed on paper from our own forest."
    rows += [(5000 + k, f"first line of letter {k}\n{rare}\nlast line of letter {k}", 1) for k in range(6)]
    filler = [(9000 + k, "\n".join(f"page {k} row {j}" for j in range(10_000)), 1) for k in range(65)]  # 650,000 lines
    docs = spark.createDataFrame([*(r[:2] for r in rows + filler), (None, None), (1000, rows[0][1])], "doc_id long, text string")
    field = quality.learn(docs, spark.createDataFrame([(k, q) for k, _, q in rows], "doc_id long, quality int"))
    known = field.known()
    assert {_text.line_key(x) for x in (*NOTICE, rare)} <= known
    some = docs.filter("doc_id is null or doc_id < 9000")
    want = sorted(((r["doc_id"], *quality.verdict(r["text"], field, known)) for r in some.collect()), key=str)
    assert sorted((tuple(r) for r in quality.judge(some, field).collect()), key=str) == want
    kept = Counter(r["doc_id"] for r in quality.keep(some, field).collect())
    assert kept == Counter(w[0] for w in want if w[-2])

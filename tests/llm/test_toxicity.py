import random

import numpy as np
import pytest

from pricedex.llm import toxicity as T


def corpus(n=600, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    bad = ["zorkel", "vexnut", "quagdrip", "yuckler"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(2, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", "s", "ig"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic if rng.random() > 0.03 else 1 - toxic))  # annotators err
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    return T.train(d, spark.createDataFrame(labels[:400], "doc_id long, quality int, toxic int")), docs, labels


def test_learns_words_and_beginnings_from_noisy_labels(trained):
    model, docs, _ = trained
    assert "b:zorkel" in model.lexicon and "w:vexnut" in model.lexicon
    found = T.Features(model.lexicon)
    right = {True: [], False: []}
    for _, text in docs[400:]:
        true = any(w in text for w in ("zorkel", "vexnut", "quagdrip", "yuckler"))
        right[true].append((model.score(found.of(text)) >= 0.3) == true)
    assert sum(right[True]) / len(right[True]) > 0.85 and sum(right[False]) / len(right[False]) > 0.99


def test_scan_finds_the_entries_of_every_word():
    rng = random.Random(7)
    for _ in range(200):
        text = "".join(rng.choice(["abc", "bca", "ab", "cabcab", " ", " ", "_", "é", "1", "\n", "C", "İ"]) for _ in range(40))
        every = sorted(T.document_entries(text) | T.document_entries("cab abcab bcabca"))
        found = T.Features(every)
        assert {every[i] for i in found.of(text) if i < len(every)} == T.document_entries(text)


def test_guards_skip_no_match():
    import re

    texts = ["you\nidiot", "you\tidiot", "u\nmoron", "you're\nan\tidiot", "you x!", "ur\nfool !", "you!!", "THIS\nIS\tALL LOUD", "f*ck",
             "what?!?", "hate\nyou", "kill\tthem", "nooooooo", "nothing of the kind"]
    for text in texts:
        found = T.Features([]).of(text)
        assert sorted(found) == [i for i, (p, _) in enumerate(T.PATTERNS) if re.search(p, text)], text


def test_scores_of_odd_rows(spark, trained):
    model = trained[0]
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "zorkel vexnuts quagdrip " * 20_000, 1), (None, "!!!! AAA BBB CCC", 1)],
                                 "doc_id long, text string, score int")
    got = {r.doc_id: r.p for r in T.score(spark, docs, model, score_col="p").collect()}
    assert got[1] == got[2] < 0.3 < got[3] and all(0 <= p <= 1 for p in got.values())


def test_no_labels_or_one_class(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    empty = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert {r.score < 1e-6 for r in T.score(spark, docs, T.train(docs, empty)).collect()} == {True}
    one = spark.createDataFrame([(1, 0), (1, 0), (2, 0)], "doc_id long, toxic int")
    assert all(r.score < 0.01 for r in T.score(spark, docs, T.train(docs, one)).collect())
    assert T.score(spark, docs.where("false"), T.train(docs.where("false"), one)).count() == 0


def test_sample_is_bounded_and_weighted(spark):
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(5000)], "doc_id long, toxic int")
    docs = spark.range(5000).selectExpr("id as doc_id", "'x' as text")
    rows = T.sample(docs, labels, max_rows=1000).collect()
    assert sum(r.toxic for r in rows) == 500 and 850 < sum(1 - r.toxic for r in rows) < 1150
    assert abs(sum(r.weight for r in rows) - 5000) < 700


def test_label_model_discounts_repeated_witnesses():
    """Five copies of one weak voter must not outweigh an independent one of the same accuracy."""
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.3
    say = lambda: np.where(rng.random(len(y)) < 0.8, y, ~y).astype(float)
    weak, alone, label = say(), say(), np.where(rng.random(len(y)) < 0.95, y, ~y).astype(float)
    votes = np.stack([label, *[weak] * 5, alone], axis=1)
    patterns, inverse, times = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, found = T.label_model(patterns, times.astype(float), 0.3)
    assert found["share"][1:6].sum() == pytest.approx(1, abs=0.25) and found["share"][6] > 0.6
    assert ((posterior[inverse.ravel()] > 0.5) == y).mean() > 0.93


def test_held_out_accuracy(spark):
    from pricedex.llm.queries import QUERIES, read_table

    sf = "/root/testdata/sf0.1"
    got = QUERIES["op7_toxicity"](spark, sf).where("held_out")
    rows = got.join(read_table(spark, sf, "labels", "doc_id", "toxic"), "doc_id").collect()
    hits = [r.predicted for r in rows if r.toxic == 1]
    false = [r.predicted for r in rows if r.toxic == 0]
    assert sum(hits) / len(hits) > 0.8 and sum(false) / len(false) < 0.02

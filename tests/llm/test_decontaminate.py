import random

import pytest

from pricedex.llm import decontaminate as D


def slow_distance(pattern, text):
    """Smallest edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_myers_against_dynamic_programming():
    rng = random.Random(3)
    for _ in range(200):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 150)))
        distance, end = D.myers(p, t)
        assert distance == slow_distance(p, t)
        assert slow_distance(p, t[:end]) == distance


def slow_words(pattern, text):
    """Smallest edit distance of the pattern to any run of whole words of the text."""
    starts = [j == 0 or text[j - 1] == " " for j in range(len(text) + 1)]
    row = [0]
    for j in range(1, len(text) + 1):
        row.append(0 if starts[j] else row[-1] + 1)
    for i, p in enumerate(pattern, 1):
        new = [row[0] + 1]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(v for j, v in enumerate(row) if j == len(text) or text[j] == " ")


def test_anchored_against_dynamic_programming():
    rng = random.Random(8)
    for _ in range(200):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        row = list(range(len(t) + 1))
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(t, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
            row = new
        assert D.anchored(p, t) == row


def test_items_are_found_as_whole_words(spark):
    docs = spark.createDataFrame([(1, "we concatenate strings"), (2, "the cat sat"), (3, "cat"), (4, "a cat"), (5, "Cat, dog"),
                                  (6, "scat"), (7, "cats")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert {r.doc_id for r in D.matches(spark, docs, items).collect()} == {2, 3, 4, 5}
    assert {r.doc_id for r in D.clean(spark, docs, items).collect()} == {1, 6, 7}


WORDS = [f"{a}{b}{c}" for a in ("ba", "to", "ki", "lu") for b in ("ran", "mes", "dol") for c in ("ti", "", "gar")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(1, len(text) - 1)
        kind = rng.randrange(3)
        text = text[:at] + ("z" if kind else "") + text[at + (kind != 1):]
    return text


def planted(seed=5):
    rng = random.Random(seed)
    items = [(i, sentence(rng, rng.randint(8, 40))) for i in range(12)]
    docs = []
    for i in range(80):
        text = sentence(rng, rng.randint(0, 200))
        if i % 3 == 0:
            _, item = items[i % 12]
            text += ". \n" + edited(rng, item, rng.randint(0, len(item) // 18)).upper() + "!\n" + sentence(rng, 20)
        docs.append((i, text))
    return items, docs


def brute(items, docs):
    out = {}
    for d, text in docs:
        normal = D.normalise(text)
        for i, item in items:
            item = D.normalise(item)
            if item and normal and (k := slow_words(item, normal)) <= len(item) // D.CHARS_PER_EDIT:
                out[d, i] = k
    return out


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_finds_what_brute_force_finds(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_CHARS", block)
    items, docs = planted()
    found = D.matches(spark, spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int"),
                      spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string"))
    got = {}
    for r in found.collect():
        got[r.doc_id, r.item_id] = min(got.get((r.doc_id, r.item_id), 99), r.distance)
        text = dict(docs)[r.doc_id]
        assert 0 <= r.start_char < r.end_char <= len(text)
        part = D.normalise(text[r.start_char:r.end_char])
        assert slow_distance(D.normalise(dict(items)[r.item_id]), part) <= r.distance
    want = brute(items, docs)
    assert got == want and len(want) > 10


def test_clean_keeps_the_others(spark):
    items, docs = planted()
    frame = spark.createDataFrame([(*d, "en") for d in docs], "doc_id long, text string, lang string")
    got = D.clean(spark, frame, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == frame.columns
    assert {r.doc_id for r in got.collect()} == {d for d, _ in docs} - {d for d, _ in brute(items, docs)}


def test_nulls_empties_and_repeats(spark):
    item = "the quick brown fox jumps over the lazy dog again and again"
    docs = spark.createDataFrame([(1, None), (2, ""), (None, item), (3, item + " " + item), (3, item + " " + item),
                                  (4, "y " * 50_000 + item)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, None), (3, " .. "), (1, item)], "item_id long, text string")
    got = D.matches(spark, docs, items).collect()
    assert sorted((str(r.doc_id), r.item_id, r.distance) for r in got) == sorted(
        [("None", 1, 0)] * 2 + [("3", 1, 0)] * 8 + [("4", 1, 0)] * 2)
    assert D.clean(spark, docs, items).count() == 2
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.matches(spark, docs, none).count() == 0 and D.clean(spark, docs, none).count() == 6
    assert D.matches(spark, docs.where("false"), items).count() == 0


def test_query_against_brute_force(spark):
    from pricedex.llm.queries import QUERIES, read_table

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in read_table(spark, sf, "documents").collect() if len(r.text) < 1500]
    items = [(r.item_id, r.text) for r in read_table(spark, sf, "benchmark").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op4_benchmark_decontamination"](spark, sf).collect()}
    short = {d for d, _ in docs}
    import re
    plain = {}  # every exact or nearly exact match has its longest word run whole; the table's passages are exact
    for d, text in docs:
        normal = " ".join(re.findall(r"\w+", text.lower()))
        plain.update({(d, i): 0 for i, t in items if f' {" ".join(re.findall(r"\w+", t.lower()))} ' in f" {normal} "})
    assert {k: v for k, v in got.items() if k[0] in short and v == 0} == plain

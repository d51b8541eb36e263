import pytest

from pricedex.llm import langid as L

ROWS = ([(i, t, "en", "s") for i, t in enumerate(["the cat and the dog", "this is the house", "where is the water", "and then they"] * 5)]
        + [(100 + i, t, "de", "s") for i, t in enumerate(["der hund und die katze", "das ist ein haus", "wo ist das wasser", "und dann"] * 5)])
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark.createDataFrame(ROWS + [(900, None, "xx", ""), (901, "nothing", None, "")], SCHEMA))


def test_words_first_then_shorter_and_shorter_grams(model):
    assert model.langs == ["de", "en"]
    assert model.terms("the") == [model.tables[0]["the"]]
    for word, n in (("thedog", 4), ("hxxxe", 2), ("qqe", 2), ("0w0", 1)):
        longest = next(k for k in L.GRAMS if any(g in model.tables[k] for g in L.grams(word, k)))
        assert longest == n
        assert model.terms(word) == [model.tables[n][g] for g in L.grams(word, n) if g in model.tables[n]]
    assert model.terms("жжж") == []


def test_predictions(spark, model):
    docs = spark.createDataFrame([(1, "Katze und Hund", 1, "x"), (2, "THE DOGS", 2, "x"), (3, None, 3, "x"), (4, " 12 .,!", 4, "x"),
                                  (5, "", 5, "x"), (None, "der die das", 6, "x"), (7, "the " * 100_000, 7, "x"), (8, "жжж", 8, "x"),
                                  (8, "жжж", 8, "x")], "doc_id long, text string, score int, lang string")
    got = L.predict(spark, docs, model, pred_col="pred", score_col="p").collect()
    assert [(r.doc_id, r.pred) for r in got] == [(1, "de"), (2, "en"), (3, "und"), (4, "und"), (5, "und"), (None, "de"), (7, "en"),
                                                (8, "de"), (8, "de")]
    assert all(0 <= r.p <= 1 for r in got) and {r.p for r in got if r.pred == "und"} == {0.0}
    assert [r.score for r in got] == [1, 2, 3, 4, 5, 6, 7, 8, 8]


def test_nothing_learned(spark):
    model = L.train(spark.createDataFrame([], SCHEMA))
    got = L.predict(spark, spark.createDataFrame([(1, "some text")], "doc_id long, text string"), model).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


def test_counts_are_those_of_all_rows(spark, monkeypatch):
    """Counting in small portions changes nothing, and the model's bound keeps the most frequent words."""
    docs = spark.createDataFrame(ROWS, SCHEMA)
    whole = L.train(docs)
    monkeypatch.setattr(L, "FLUSH", 3)
    parts = L.train(docs, max_words=2)
    assert {w for w in parts.tables[0]} == {"the", "is", "das", "und"} or len(parts.tables[0]) == 4
    for n in L.GRAMS:
        assert {g: whole.rates[i].tolist() for g, i in whole.tables[n].items()} == {
            g: parts.rates[i].tolist() for g, i in parts.tables[n].items()}


def test_bounds_of_the_broadcast_change_no_score(spark):
    """Terms beyond the bounds score by their counts in all languages, words and n-grams alike."""
    train = spark.createDataFrame(ROWS, SCHEMA)
    texts = [" ".join(t for _, t, *_ in ROWS[:4]), "wasser house", "thedog hausdie qqe 0w0", "hxxxe", "жжж", "water жжж katze katze",
             "1 2", None, "wasser house"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = L.train(train)

    def scores(model):
        return {r.doc_id: (r.lang_pred, pytest.approx(r.score, abs=1e-12)) for r in L.predict(spark, docs, model).collect()}

    def by_hand(text):
        words = L.WORD.findall((text or "").lower())
        if not words:
            return "und", 0.0
        total = whole.prior + sum(whole.rates[rows].mean(axis=0) for w in words if (rows := whole.terms(w)))
        share = L.np.exp(total - total.max())
        return whole.langs[int(share.argmax())], float(share.max() / share.sum())

    expected = {i: by_hand(t) for i, t in enumerate(texts)}
    assert expected == scores(whole) == scores(L.train(train, max_words=1, max_grams=1)) == scores(L.train(train, max_words=3, max_grams=8))


def test_most_frequent_terms_are_not_ranked_by_language(spark):
    from pyspark.sql import functions as F

    rows = [(lang, n, f"t{i}", 1 + i // 10 if i < 40 else 1) for lang in ("de", "en") for n in (0, 1) for i in range(200)]
    counts = spark.createDataFrame(rows, "lang string, n int, term string, times long")
    times = {r[:3]: r[3] for r in rows}
    for words, more in ((25, 7), (10, 60), (200, 500)):
        top = L._most_frequent(counts, F.when(F.col("n") == 0, words).otherwise(more))
        got = {}
        for r in top.collect():
            got.setdefault((r.lang, r.n), []).append(times[r.lang, r.n, r.term])
        for (lang, n), found in got.items():
            every = sorted((t for k, t in times.items() if k[:2] == (lang, n)), reverse=True)
            assert sorted(found, reverse=True) == every[: words if n == 0 else more]
        assert len(got) == 4
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert all("term#" not in x.split("windowspecdefinition(")[1].split(" ASC")[0].split(" DESC")[0] or "bucket#" in x
               for x in plan.splitlines() if "windowspecdefinition(" in x)


def test_held_out_rule(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in [*range(40), None]], "doc_id long").withColumn("h", L.held_out()).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_held_out_accuracy(spark):
    from pricedex.llm.queries import QUERIES, read_table

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op6_language_id"](spark, sf)
    truth = read_table(spark, sf, "documents", "doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert got.count() == truth.count() and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97

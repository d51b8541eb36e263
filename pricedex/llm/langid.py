"""Language identification by words first, with a backoff to shorter and shorter character n-grams.

Training counts every word of every training row in Spark (partial counts per task, then one shuffle) and, over the
distinct words, all their character n-grams of 4 down to 1 characters (a word's ends are marked; unseen words are new
kinds of words, so each kind counts once). The counts of all terms in all languages are a written table that grows with
the input. A word known in any language scores its log frequency in each; an unknown one the mean log frequency of its
known n-grams at the longest length that has any. The languages' sums give the posterior.

Each language's most frequent words and n-grams (``max_words`` and ``max_grams``) are broadcast, so that the words most
texts are made of are scored where the text is. The other distinct words meet the table in joins by term, unseen ones
with their n-grams, and their scores return to the texts by the texts' digests. The bounds divide the work between the
two ways and change no score.

Cases: a text that is null or has no letter is ``und`` with score 0; rows without a language or text teach nothing; a
null id is never held out; with nothing learned every row is ``und``; words that no language knows at any length leave
the languages' shares of the training rows; extra columns are ignored or passed through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricedex.llm.common import as_row, materialise, row_fields

WORD = re.compile(r"[^\W\d_]+")
GRAMS = (4, 3, 2, 1)
MAX_WORDS = 40_000  # broadcast per language
MAX_GRAMS = 20_000  # broadcast per language and length
SMOOTH = 0.5
FLUSH = 200_000  # distinct words a task counts before it passes them on
TIE_BUCKETS = 4096
CHUNK = 1 << 16  # words of a text that are looked up together


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept for testing: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i: i + n] for i in range(len(marked) - n + 1)]


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}
    for b in batches:
        for lang, text in zip(b["lang"], b["text"], strict=True):
            counts.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            if sum(map(len, counts.values())) > FLUSH:
                yield _flat(counts)
                counts = {}
    if counts:
        yield _flat(counts)


def _flat(counts: dict[str, Counter]) -> pd.DataFrame:
    return pd.DataFrame([(lang, w, n) for lang, c in counts.items() for w, n in c.items()],
                        columns=["lang", "term", "times"])


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many of a language's distinct words have each n-gram (an n-gram counts as often as it stands in a word)."""
    counts: dict[tuple[str, int], Counter] = {}
    for b in batches:
        for lang, words in b.groupby("lang")["term"]:
            for at in range(0, len(words), 2000):
                plain = list(words.iloc[at: at + 2000])
                marked = [f"<{w}>" for w in plain]
                for n in GRAMS:
                    counts.setdefault((lang, n), Counter()).update(
                        [w[i: i + n] for w in (marked if n > 1 else plain) for i in range(len(w) - n + 1)])
            if sum(map(len, counts.values())) > FLUSH:
                yield from _flat_grams(counts)
                counts = {}
    yield from _flat_grams(counts)


def _flat_grams(counts: dict[tuple[str, int], Counter]) -> Iterator[pd.DataFrame]:
    for (lang, n), c in counts.items():
        if c:
            yield pd.DataFrame({"lang": lang, "n": n, "term": list(c), "times": list(c.values())})


class Model:
    """Per-language log frequencies of the most frequent words and n-grams (rows of ``rates``, found by term in
    ``tables``; length 0 holds the words) and the languages' shares of the training rows, which are broadcast. The whole
    is ``counted``, rows (n, term, times by language), whose log frequencies are log(times + SMOOTH) - ``base`` of n."""

    def __init__(self, langs: list[str], prior: np.ndarray, tables: dict[int, dict[str, int]], rates: np.ndarray,
                 base: dict[int, np.ndarray], counted: DataFrame | None = None):
        self.langs, self.prior, self.tables, self.rates, self.base = langs, prior, tables, rates, base
        self.counted = counted

    def frequent(self) -> Model:
        """What is broadcast."""
        return Model(self.langs, self.prior, self.tables, self.rates, self.base)

    def backoff(self, word: str) -> Iterator[tuple[int, list[int], list[str]]]:
        """(n, rows, n-grams without a row) from the longest length to the first that has a row."""
        for n in GRAMS:
            table, found = self.tables[n], grams(word, n)
            rows = [at for g in found if (at := table.get(g)) is not None]
            yield n, rows, [g for g in found if g not in table]
            if rows:
                return

    def terms(self, word: str) -> list[int]:
        """Rows that score a word: its own, or those of its n-grams of the longest length that has any."""
        at = self.tables[0].get(word)
        return [at] if at is not None else [r for _, rows, _ in self.backoff(word) for r in rows]

    def log_rates(self) -> list[Column]:
        """The log frequencies by language of a row of ``counted``."""
        def column(i: int) -> Column:
            bases = F.create_map(*[F.lit(x) for n, base in self.base.items() for x in (n, float(base[i]))])
            return F.log(F.col("times")[i] + F.lit(SMOOTH)) - bases[F.col("n")]

        return [column(i) for i in range(len(self.langs))]


def _most_frequent(counts: DataFrame, most: Column) -> DataFrame:
    """The ``most`` most frequent terms of each language and length, without ranking a language's terms in one task.

    Numbers of terms by frequency tell from which frequency on all are taken. Of the terms at the frequency that
    passes the bound, hash buckets are taken in order as far as they go, the first terms of the last one.
    """
    group = ["lang", "n"]
    by_times = counts.groupBy(*group, "times").agg(F.count("*").alias("here"))
    so_far = F.sum("here").over(Window.partitionBy(*group).orderBy(F.desc("times")))
    passes = F.col("so_far") > most
    cut = by_times.withColumn("so_far", so_far).groupBy(*group).agg(
        F.max(F.when(passes, F.struct("times", (most - F.col("so_far") + F.col("here")).alias("room")))).alias("cut"))
    cut = F.broadcast(materialise(cut, "cuts"))  # one row a language and length
    ranked = counts.join(cut, group)
    ties = ranked.where("times = cut.times and cut.room > 0").select(
        *group, "term", "cut.room", F.pmod(F.xxhash64("term"), F.lit(TIE_BUCKETS)).alias("bucket"))
    before = F.sum("here").over(Window.partitionBy(*group).orderBy("bucket")) - F.col("here")
    places = ties.groupBy(*group, "room", "bucket").agg(F.count("*").alias("here")).select(
        *group, "bucket", (F.col("room") - before).alias("places")).where("places > 0")
    place = F.row_number().over(Window.partitionBy(*group, "bucket").orderBy("term"))
    ties = ties.join(places, [*group, "bucket"]).withColumn("place", place).where("place <= places")
    return ranked.where("cut is null or times > cut.times").select(*group, "term").unionByName(
        ties.select(*group, "term"))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
          max_grams: int = MAX_GRAMS) -> Model:
    """Learn from the rows' text and language: every row and term counts, the most frequent terms are broadcast."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang is not null and text is not null")
    words = materialise(rows.mapInPandas(_count_words, "lang string, term string, times long")
                        .groupBy("lang", "term").agg(F.sum("times").alias("times")), "word-counts")
    gram_counts = (words.mapInPandas(_count_grams, "lang string, n int, term string, times long")
                   .groupBy("lang", "n", "term").agg(F.sum("times").alias("times")))
    counts = materialise(words.select("lang", F.lit(0).alias("n"), "term", "times").unionByName(gram_counts),
                         "term-counts")
    totals: dict[int, dict[str, int]] = {n: {} for n in (0, *GRAMS)}
    for r in counts.groupBy("lang", "n").agg(F.sum("times").alias("times")).collect():
        totals[r.n][r.lang] = r.times
    shares = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(totals[0])
    if not langs:
        return Model([], np.zeros(0), {n: {} for n in totals}, np.zeros((0, 0)), {})
    prior = np.log(np.array([shares[x] for x in langs], float) / max(1, sum(shares.values())))
    times = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("times"))), F.lit(0).cast("long")) for x in langs]
    counted = materialise(counts.groupBy("n", "term").agg(F.array(*times).alias("times")), "terms")
    kinds = {r.n: r["count"] for r in counted.groupBy("n").count().collect()}
    base = {n: np.log([own.get(x, 0) + SMOOTH * (kinds.get(n, 0) + 1) for x in langs]) for n, own in totals.items()}
    top = _most_frequent(counts, F.when(F.col("n") == 0, max_words).otherwise(max_grams))
    # at most (max_words + 4 max_grams) rows for each language
    frequent = counted.join(top.select("n", "term"), ["n", "term"], "left_semi").toArrow()
    rates = np.log(np.array(frequent["times"].to_pylist(), float).reshape(-1, len(langs)) + SMOOTH)
    tables: dict[int, dict[str, int]] = {n: {} for n in totals}
    for i, (n, term) in enumerate(zip(frequent["n"].to_pylist(), frequent["term"].to_pylist(), strict=True)):
        tables[n][term] = i
        rates[i] -= base[n]
    return Model(langs, prior, tables, rates, base, counted)


def _score_frequent(shared):
    """Of each text with words: the sums over its frequent words by language, and its other words with their times."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        at, rates = model.tables[0].get, model.rates
        for b in batches:
            out = []
            for key, text in zip(b["key"], b["text"], strict=True):
                words = WORD.findall(text.lower())
                total, others = np.zeros(len(model.langs)), Counter()
                for start in range(0, len(words), CHUNK):
                    part = words[start: start + CHUNK]
                    rows = list(map(at, part))
                    if None in rows:
                        others.update([w for w, r in zip(part, rows, strict=True) if r is None])
                        rows = [r for r in rows if r is not None]
                    total += rates[rows].sum(axis=0)
                if words:
                    out.append((key, total, list(others), list(others.values())))
            if out:
                yield pd.DataFrame(out, columns=["key", "sums", "words", "times"])
    return run


def _frequent_grams(shared):
    """Of each word and length down to the first with a frequent n-gram: their number, sums and the other n-grams."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for b in batches:
            for start in range(0, len(b), 2000):
                out = [(word, n, len(rows), model.rates[rows].sum(axis=0), others)
                       for word in b["word"].iloc[start: start + 2000] for n, rows, others in model.backoff(word)]
                yield pd.DataFrame(out, columns=["word", "n", "many", "sums", "others"])
    return run


def _sums(rows: DataFrame, langs: int, *key: str) -> DataFrame:
    """The array ``sums`` added up by key, and ``many``."""
    return rows.groupBy(*key).agg(F.sum("many").alias("many"),
                                  F.array(*[F.sum(F.col("sums")[i]) for i in range(langs)]).alias("sums"))


def _word_scores(words: DataFrame, model: Model, shared) -> DataFrame:
    """(word, rates): of the words in the table their own, of the others the mean of their longest known n-grams."""
    langs = len(model.langs)
    own = model.counted.where("n = 0").select(F.col("term").alias("word"), F.array(*model.log_rates()).alias("rates"))
    words = materialise(words.join(own, "word", "left"), "words")
    parts = materialise(words.where("rates is null").select("word").mapInPandas(
        _frequent_grams(shared), "word string, n int, many long, sums array<double>, others array<string>"), "word-grams")
    others = parts.select("word", "n", F.explode("others").alias("term")).join(
        model.counted.where("n > 0"), ["n", "term"]).select(
        "word", "n", F.lit(1).cast("long").alias("many"), F.array(*model.log_rates()).alias("sums"))
    by_length = _sums(parts.drop("others").unionByName(others), langs, "word", "n").where("many > 0")
    longest = by_length.groupBy("word").agg(F.max_by(F.struct("many", "sums"), "n").alias("best"))
    unseen = longest.select("word", F.transform("best.sums", lambda x: x / F.col("best.many")).alias("rates"))
    return words.where("rates is not null").unionByName(unseen)


def predict(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior (0 to 1) as two more columns.

    Columns of these names are replaced. Equal texts are scored once; rows and scores meet by the text's digest.
    """
    if not model.langs:
        return docs.withColumn(pred_col, F.lit("und")).withColumn(score_col, F.lit(0.0))
    shared = spark.sparkContext.broadcast(model.frequent())
    langs = len(model.langs)
    key = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    texts = docs.where(F.col(text_col).isNotNull()).select(key.alias("key"), F.col(text_col).alias("text"))
    texts = materialise(texts.mapInPandas(_score_frequent(shared), "key binary, sums array<double>, words array<string>, "
                                          "times array<long>").dropDuplicates(["key"]), "texts")
    other = texts.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "key", F.col("w.words").alias("word"), F.col("w.times").alias("many"))
    scores = materialise(_word_scores(other.select("word").distinct(), model, shared), "word-scores")
    other = other.join(scores, "word").select(
        "key", "many", F.transform("rates", lambda x: x * F.col("many")).alias("sums"))
    total = _sums(texts.select("key", F.lit(0).cast("long").alias("many"), "sums").unionByName(other), langs, "key")
    total = total.select("key", F.array(*[F.col("sums")[i] + F.lit(float(p)) for i, p in enumerate(model.prior)]).alias("t"))
    best = F.array_max("t")
    name = F.element_at(F.array(*[F.lit(x) for x in model.langs]), F.array_position("t", best).cast("int"))
    share = F.aggregate("t", F.lit(0.0), lambda s, x: s + F.exp(x - best))
    found = materialise(total.select("key", name.alias("language"), (F.lit(1.0) / share).alias("posterior")), "languages")
    joined = docs.select(as_row(docs).alias("row"), key.alias("key")).join(found, "key", "left")
    added = {pred_col: F.coalesce("language", F.lit("und")), score_col: F.coalesce("posterior", F.lit(0.0))}
    return joined.select(*row_fields(docs, "row", added), *[v.alias(c) for c, v in added.items() if c not in docs.columns])

"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

1. Lexicon: document frequencies of words, word beginnings and word inner n-grams by label over a labelled sample
   (counted in Spark); entries far likelier in toxic texts form the lexicon, by log-likelihood ratio.
2. Voters: the lexicon, dealt into groups by kind and rank, and fixed patterns (shouting, masked words, insults aimed at
   a reader ...). A voter says toxic or abstains on a document. The annotators' label is one more, noisy, voter.
3. Label model: EM over the counts of vote patterns (at most 2^voters rows). It estimates each voter's rate in either
   class and the voters' correlations inside the classes; a voter's evidence is divided by how much of it the others
   repeat, so that ten correlated lexicons do not count as ten witnesses.
4. Classifier: logistic regression on lexicon entries and patterns, fitted to the label model's posteriors.

The sample holds at most ``max_rows`` labelled rows of each class (expected number; chosen by a hash of the id): its ids
are broadcast, so the texts are not shuffled, and the fitted rows that reach the driver are bounded by it.

Cases: null text counts as empty and gets the score of a text without any entry; rows with null id or label teach
nothing; repeated labels of an id count by their rows; with labels of one class only, or none, every score is that
class's share (0 with no labels); extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.llm.common import materialise

MAX_ROWS = 20_000
LEXICON = 600
GROUPS = 12  # lexicon voters; with the patterns at most 2^18 vote patterns
MIN_DOCS = 4  # toxic documents that have an entry
MIN_ODDS = 1.5  # smoothed log-odds of an entry between the classes
MIN_STRENGTH = 16.0
FLUSH = 200_000
WORD = re.compile(r"[^\W\d_]+")

# Surface patterns of abuse, one voter each, with a character or word that every match has.
PATTERNS = (
    (r"\b[A-Z]{3,}(?:\s+[A-Z]{3,}){2,}", ()),  # shouting
    (r"[!?]{3,}", ("!!", "??", "!?", "?!")),  # runs of marks
    (r"\b[a-zA-Z]+[*@#$]{1,}[a-zA-Z]+\b", ("*", "@", "#", "$")),  # masked words
    (r"\b(?:you|u)(?:\s+are|'re|r)?\s+(?:an?\s+|such\s+an?\s+)?\w+\s*(?:!|\bidiot|\bmoron)", ("!", "idiot", "moron")),
    (r"\b(?:kill|hurt|hate)\s+(?:you|u|yourself|them)\b", ("kill", "hurt", "hate")),  # threats
    (r"([a-z])\1{5,}", tuple(c * 6 for c in "abcdefghijklmnopqrstuvwxyz")),  # drawn-out letters
)
_PATTERNS = [(re.compile(p), guard) for p, guard in PATTERNS]


@lru_cache(maxsize=30_000)
def entries(word: str) -> tuple[str, ...]:
    """Lexicon entries of a word: itself, its beginnings, its inner 5-grams."""
    out = [f"w:{word}"] + [f"b:{word[:n]}" for n in (3, 4, 5, 6) if len(word) > n]
    return (*out, *(f"i:{word[i:i + 5]}" for i in range(1, len(word) - 4)))


def document_entries(text: str) -> set[str]:
    found: set[str] = set()
    for word in set(WORD.findall(text.lower())):
        found.update(entries(word))
    return found


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for b in batches:
        for text, label in zip(b["text"], b["toxic"], strict=True):
            counts[int(label)].update(document_entries(text))
            if len(counts[0]) + len(counts[1]) > FLUSH:
                yield from _pass_on(counts)
                counts = (Counter(), Counter())
    yield from _pass_on(counts)


def _pass_on(counts: tuple[Counter, Counter]) -> Iterator[pd.DataFrame]:
    keys = list(counts[0] | counts[1])
    if keys:
        yield pd.DataFrame({"entry": keys, "clean": [counts[0][k] for k in keys], "toxic": [counts[1][k] for k in keys]})


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Labelled texts (doc_id, text, toxic, weight): all of a class, or ``max_rows`` of it in expectation."""
    rows = labels.where("doc_id is not null and toxic in (0, 1)").select(
        F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    total = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = {c: min(1.0, max_rows / n) for c, n in total.items()}
    chosen = rows.where("false").withColumn("weight", F.lit(1.0))
    for c, s in share.items():
        part = rows.where(F.col("toxic") == c).where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(s * (1 << 20)))
        chosen = chosen.unionByName(part.withColumn("weight", F.lit(1 / s)))
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    # two narrow columns of about 2 max_rows rows: the bound is the parameter's
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id")


def mine_lexicon(rows: DataFrame, size: int = LEXICON) -> list[str]:
    """Entries that set the toxic texts apart, best first."""
    docs = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n0, n1 = docs.get(0, 0), docs.get(1, 0)
    if not n0 or not n1:
        return []
    counts = rows.select("text", "toxic").mapInPandas(_count, "entry string, clean long, toxic long").groupBy(
        "entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ranked = counts.where(F.col("toxic") >= MIN_DOCS).select(
        "entry", association(F.col("clean"), F.col("toxic"), n0, n1).alias("strength"),
        (F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))).alias("odds"))
    ranked = ranked.where((F.col("odds") >= MIN_ODDS) & (F.col("strength") >= MIN_STRENGTH))
    return [r.entry for r in ranked.orderBy(F.desc("strength"), "entry").limit(size).collect()]


def association(clean: Column, toxic: Column, n0: int, n1: int) -> Column:
    """Log-likelihood ratio of the entry's table of documents (with it or not, clean or toxic)."""

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = (clean + toxic) / F.lit(float(n0 + n1))
    return 2 * (part(toxic, n1 * share) + part(clean, n0 * share)
                + part(n1 - toxic, n1 * (1 - share)) + part(n0 - clean, n0 * (1 - share)))


def deal_voters(lexicon: list[str], groups: int = GROUPS) -> list[list[int]]:
    """The lexicon's entries by voter: neighbours in rank of one kind go to different voters."""
    by_kind: dict[str, list[int]] = {}
    for i, entry in enumerate(lexicon):
        by_kind.setdefault(entry[0], []).append(i)
    order = [i for kind in sorted(by_kind) for i in by_kind[kind]]
    return [v for g in range(groups) if (v := order[g::groups])]


def _letter(c: str) -> bool:
    """Whether ``WORD`` takes the character; no character is no letter."""
    return c.isalnum() and not c.isdecimal()


class Features:
    """Numbers of the lexicon entries and patterns that a text has, from one scan of it (Aho-Corasick)."""

    def __init__(self, lexicon: list[str]):
        self.first = len(lexicon)
        self.size = len(lexicon) + len(_PATTERNS)
        self.automaton = ahocorasick.Automaton()
        by_body: dict[str, list[tuple[int, str]]] = {}
        for i, entry in enumerate(lexicon):
            by_body.setdefault(entry[2:], []).append((i, entry[0]))
        for body, owners in by_body.items():
            self.automaton.add_word(body, (len(body), owners))
        if lexicon:
            self.automaton.make_automaton()

    def of(self, text: str) -> list[int]:
        lower = text.lower()
        found: set[int] = set()
        if self.first:
            for end, (n, owners) in self.automaton.iter(lower):
                inside = end >= n and _letter(lower[end - n])
                goes_on = _letter(lower[end + 1: end + 2])
                for i, kind in owners:
                    if kind == "i" and inside or not inside and goes_on == (kind == "b") and kind != "i":
                        found.add(i)
        for k, (pattern, guard) in enumerate(_PATTERNS):
            body = lower if k >= 3 else text
            if (not guard or any(g in body for g in guard)) and pattern.search(body):
                found.add(self.first + k)
        return sorted(found)


def label_model(votes: np.ndarray, times: np.ndarray, prior: float, rounds: int = 25) -> tuple[np.ndarray, dict]:
    """Posterior of class 1 for each vote pattern (rows of 0/1 votes, the annotators' label in column 0).

    EM over weighted patterns. Rates start from the label; voters' correlations inside the classes divide their
    evidence: a voter whose votes others repeat counts for its share only.
    """
    m = votes.shape[1]
    q = np.where(votes[:, 0] == 1, 0.9, 0.02)
    rates, share = np.zeros((2, m)), np.ones(m)
    for _ in range(rounds):
        covariance = np.zeros((m, m))
        for c, weight in ((0, times * (1 - q)), (1, times * q)):
            rates[c] = (weight @ votes + 0.5) / (weight.sum() + 1)
            centred = votes - rates[c]
            covariance += (centred * weight[:, None]).T @ centred
        covariance /= times.sum()
        spread = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        correlation = np.clip(covariance / np.outer(spread, spread), 0, 1)
        correlation[0, 1:] = correlation[1:, 0] = 0  # annotators work apart from the voters
        np.fill_diagonal(correlation, 1)
        share = 1 / correlation.sum(axis=1)
        yes = share * (np.log(rates[1]) - np.log(rates[0]))
        no = share * (np.log1p(-rates[1]) - np.log1p(-rates[0]))
        score = np.log(prior / (1 - prior)) + votes @ yes + (1 - votes) @ no
        new = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
        if np.abs(new - q).max() < 1e-6:
            q = new
            break
        q = new
    return q, {"rates": rates, "share": share, "correlation": correlation}


def fit(rows: list[list[int]], target: np.ndarray, weight: np.ndarray, size: int, rounds: int = 800,
        ridge: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of feature numbers, to soft targets (accelerated steps under a diagonal bound)."""
    many = np.array([len(r) for r in rows])
    at = np.repeat(np.arange(len(rows)), many)
    col = np.fromiter((c for r in rows for c in r), np.int64, len(at))
    weight = weight / weight.sum()
    ridge = ridge / len(rows)
    bound = 0.25 * weight * (many + 1)  # of a row's part in the curvature, for each of its features
    curve = np.bincount(col, bound[at], minlength=size) + ridge
    w, b = np.zeros(size), float(np.log((weight @ target + 1e-6) / (weight @ (1 - target) + 1e-6)))
    v, vb, momentum = w, b, 1.0
    for _ in range(rounds):
        z = vb + np.bincount(at, v[col], minlength=len(rows))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target)
        w_new = v - (np.bincount(col, error[at], minlength=size) + ridge * v) / curve
        b_new = vb - error.sum() / bound.sum()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / following
        v, vb = w_new + pull * (w_new - w), b_new + pull * (b_new - b)
        w, b, momentum = w_new, b_new, following
    return w, b


class Model:
    def __init__(self, lexicon: list[str], weights: np.ndarray, bias: float, voters: dict | None = None):
        self.lexicon, self.weights, self.bias, self.voters = lexicon, weights, bias, voters

    def score(self, found: list[int]) -> float:
        z = self.bias + (self.weights[found].sum() if found else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic)."""
    rows = materialise(sample(docs, labels, max_rows), "labelled-sample")
    lexicon = mine_lexicon(rows)
    groups = deal_voters(lexicon)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Features(lexicon)
        for b in batches:
            yield pd.DataFrame({"toxic": b["toxic"], "weight": b["weight"], "found": [found.of(t) for t in b["text"]]})

    # at most 2 max_rows rows in expectation, each of feature numbers only
    got = rows.mapInPandas(features, "toxic int, weight double, found array<int>").collect()
    size = len(lexicon) + len(_PATTERNS)
    if not got:
        return Model([], np.zeros(size), -50.0)
    label = np.array([r.toxic for r in got])
    weight = np.array([r.weight for r in got])
    prior = float(np.clip(weight @ label / weight.sum(), 1e-6, 1 - 1e-6))
    if not lexicon:
        return Model([], np.zeros(size), float(np.log(prior / (1 - prior))))
    voter_of = np.full(size, -1)
    for g, members in enumerate(groups):
        voter_of[members] = g
    voter_of[len(lexicon):] = len(groups) + np.arange(len(_PATTERNS))
    votes = np.zeros((len(got), 1 + len(groups) + len(_PATTERNS)))
    votes[:, 0] = label
    for i, r in enumerate(got):
        votes[i, 1 + voter_of[np.array(r.found, int)]] = 1 if r.found else 0
    patterns, inverse = np.unique(votes, axis=0, return_inverse=True)
    posterior, voters = label_model(patterns, np.bincount(inverse.ravel(), weight), prior)
    weights, bias = fit([list(r.found) for r in got], posterior[inverse.ravel()], weight, size)
    return Model(lexicon, weights, bias, voters)


def score(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the toxicity score (0 to 1) as one more column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        found = Features(model.lexicon)
        for batch in texts:
            yield pd.Series([model.score(found.of(t or "")) for t in batch], dtype=float)

    return docs.withColumn(score_col, run(F.col(text_col)))

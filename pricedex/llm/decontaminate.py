"""Benchmark decontamination: test items found in documents within an edit budget.

Texts are compared as lower-case words joined by single spaces. An item of m characters may differ by
``m // chars_per_edit`` edits; split into that many pieces and one, at least one piece of a match is untouched. All
pieces of the items are found at once (Aho-Corasick), and around every hit Myers' bit-parallel algorithm computes the
smallest edit distance of the item to whole words of the text there: a match begins where a word begins and ends where one
ends, so a short item is not found inside longer words.

Documents are never shuffled: items go to them, in blocks of at most ``BLOCK_CHARS`` characters of text (a single
longer item is a block of its own), one pass over the documents for each block.

Cases: null or wordless items match nothing, null or empty texts hold nothing; repeated rows and items are found each;
null ids are kept; items shorter than an edit's share of characters must be found exactly; without items every document
stays, and without documents nothing is found; extra columns are ignored or passed through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHARS_PER_EDIT = 20
BLOCK_CHARS = 4_000_000
WORD = re.compile(r"\w+")


def normalise(text: str | None) -> str:
    return " ".join(WORD.findall(text)).lower() if text else ""


def split(item: str, parts: int) -> list[tuple[int, str]]:
    """``parts`` pieces of nearly equal length with their offsets."""
    cut = np.linspace(0, len(item), parts + 1).astype(int).tolist()
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of the pattern to a part of the text, and the first end of such a part."""
    m = len(pattern)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        equal = where.get(c, 0)
        x = equal | down
        h = (((equal & up) + up) ^ up) | equal
        plus = down | ~(h | up) & mask
        minus = up & h
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & mask, (minus << 1) & mask
        up, down = (minus | ~(x | plus)) & mask, plus & x
        if score < best:
            best, end = score, j
    return best, end


def anchored(pattern: str, text: str) -> list[int]:
    """Edit distances of the pattern to the text's beginnings of 0, 1, 2, ... characters (Myers, start held)."""
    m = len(pattern)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = mask, 0, m
    scores = [m]
    for c in text:
        equal = where.get(c, 0)
        x = equal | down
        h = (((equal & up) + up) ^ up) | equal
        plus = down | ~(h | up) & mask
        minus = up & h
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1 | 1) & mask, (minus << 1) & mask
        up, down = (minus | ~(x | plus)) & mask, plus & x
        scores.append(score)
    return scores


def whole_words(item: str, budget: int, text: str, near: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the closest run of whole words that begins within ``budget`` of ``near``, if close enough."""
    best = None
    for a in range(max(0, near - budget), min(len(text), near + budget + 1)):
        if a and text[a - 1] != " ":
            continue
        scores = anchored(item, text[a: a + len(item) + budget])
        for n in range(max(1, len(item) - budget), len(scores)):
            if scores[n] <= budget and (a + n == len(text) or text[a + n] == " ") and (best is None or scores[n] < best[0]):
                best = scores[n], a, a + n
    return best


class Matcher:
    def __init__(self, items: list[tuple[object, str]], chars_per_edit: int):
        self.items = [(key, text) for key, text in items if text]
        self.budget = [len(text) // chars_per_edit for _, text in self.items]
        self.pieces: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(self.items):
            for offset, piece in split(text, self.budget[number] + 1):
                self.pieces.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if self.pieces:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, distance, start, end) of the matches in normalised text; those of an item do not overlap."""
        if not self.pieces or not text:
            return []
        places: dict[int, set[int]] = {}
        for last, (length, owners) in self.automaton.iter(text):
            for number, offset in owners:
                places.setdefault(number, set()).add(last + 1 - length - offset)
        found = []
        for number, starts in places.items():
            item, k = self.items[number][1], self.budget[number]
            done = -1  # end of the last match, and of what the last window covered
            covered = None
            for start in sorted(starts):
                if start + len(item) - k <= done or (covered is not None and start <= covered):
                    continue
                low, high = max(0, start - k), min(len(text), start + len(item) + k)
                covered = start
                if myers(item, text[low:high])[0] <= k and (best := whole_words(item, k, text, start)):
                    found.append((number, *best))
                    done = best[2]
        return found


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """The items, normalised, in blocks of bounded size; one block at a time is on the driver."""
    block, size = [], 0
    for row in items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).toLocalIterator():
        text = normalise(row["text"])
        if block and size + len(text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row["id"], text))
        size += len(text)
    yield block


def _spans(text: str, normal: str, found: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """The matches' places in the text as it was: from the first to the last word they touch."""
    words = [m.span() for m in WORD.finditer(text)]
    return [(words[normal.count(" ", 0, start)][0], words[normal.count(" ", 0, max(start, end - 1))][1])
            for _, _, start, end in found]


def matches(spark: SparkSession, docs: DataFrame, items: DataFrame, chars_per_edit: int = CHARS_PER_EDIT,
            id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, item_id, distance, start_char, end_char (span in the document's own text)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    result = None
    for block in _blocks(items.withColumn("_item", F.col(item_col).cast("long")), "_item", item_text_col):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            matcher = Matcher(shared.value, chars_per_edit)
            for b in batches:
                out = []
                for doc_id, text in zip(b["doc_id"].astype("Int64"), b["text"], strict=True):
                    normal = normalise(text)
                    found = matcher.find(normal)
                    if found:
                        for (number, distance, _, _), (a, z) in zip(found, _spans(text, normal, found), strict=True):
                            out.append((doc_id, matcher.items[number][0], distance, a, z))
                if out:
                    yield pd.DataFrame(out, columns=["doc_id", "item_id", "distance", "start_char", "end_char"]).astype(
                        {"doc_id": "Int64", "item_id": "Int64"})

        part = rows.mapInPandas(run, "doc_id long, item_id long, distance int, start_char long, end_char long")
        result = part if result is None else result.unionByName(part)
    return result


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, chars_per_edit: int = CHARS_PER_EDIT,
          text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents in which no item is found, all columns as they are."""
    for block in _blocks(items, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(block)

        @F.pandas_udf("boolean")
        def holds(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            matcher = Matcher(shared.value, chars_per_edit)  # noqa: B023 - pickled at once
            for batch in texts:
                yield pd.Series([bool(matcher.find(normalise(t))) for t in batch], dtype=bool)

        docs = docs.where(~holds(F.col(text_col)))
    return docs

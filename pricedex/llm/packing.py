"""Best-fit packing of token sequences: patterns of a few lengths, fitted to the length histogram.

A document's ids (its end mark included) are one piece, or, if longer than a sequence, cut so that all pieces but the
first are full. The histogram of piece lengths (at most ``size`` rows) comes to the driver. Patterns of up to three
lengths that fill a sequence are fitted to it by non-negative least squares, their repeat counts rounded down, and what
is left is packed best-fit decreasing, on counts rather than pieces. The plan says for every length which ranks go
where; pieces are ranked in Spark (within bounded buckets, then by the buckets' counts) and placed by a lookup in the
plan, whose size depends on the sequence size, not on the data.

Cases: null text counts as empty and yields its end mark; an empty table packs to nothing; null or repeated ids are
pieces like any other; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricedex.llm.common import materialise, shuffle_partitions
from pricedex.llm.tokens import Encoder

SEQUENCE = 1024
END = 2
BUCKET_ROWS = 100_000  # pieces ranked together
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end: int = END, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32 and, if asked for, ids: little-endian 32-bit)."""
    closing = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(tokenizer)
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at: at + 500]
                rows = []
                for doc_id, raw in zip(part["doc_id"].astype("Int64"), encoder.encode(list(part["text"])), strict=True):
                    raw += closing
                    n = len(raw) // 4
                    cut, number = (n - 1) % size + 1, 0
                    start = 0
                    while start < n:
                        ids = raw[4 * start: 4 * cut]
                        rows.append((doc_id, number, start, cut - start, zlib.crc32(ids), *([ids] if with_ids else [])))
                        start, cut, number = cut, cut + size, number + 1
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32",
                                                  *(["ids"] if with_ids else [])])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(run, _PIECE + (", ids binary" if with_ids else ""))


def patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All multisets of one to three of the lengths that fill a sequence exactly, as rows padded with 0."""
    have = np.zeros(size + 1, bool)
    have[lengths] = True
    rows = [np.array([[size, 0, 0]])] if have[size] else []
    a = lengths[(lengths * 2 >= size) & (lengths < size)]
    pair = a[have[size - a]]
    rows.append(np.stack([pair, size - pair, np.zeros_like(pair)], axis=1))
    for a in lengths[(lengths * 3 >= size) & (lengths < size - 1)]:
        b = lengths[(lengths <= a) & (2 * lengths >= size - a) & (lengths < size - a)]
        b = b[have[size - a - b]]
        rows.append(np.stack([np.full_like(b, a), b, size - a - b], axis=1))
    return np.concatenate(rows)


def fit_repeats(found: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares: repeats of the patterns whose lengths' sums come nearest to the counts."""
    if not len(found):
        return np.zeros(0)
    size = len(counts)
    weight = 1 / np.maximum(counts, 1.0)
    weight[0] = 0

    def lengths_of(x: np.ndarray) -> np.ndarray:
        out = np.zeros(size)
        for k in range(3):
            out += np.bincount(found[:, k], x, minlength=size)
        out[0] = 0
        return out

    use = lengths_of(np.ones(len(found)))
    # a step per pattern that majorises the quadratic: its lengths' weights times the patterns that share them
    curve = (weight * use * 3)[found].sum(axis=1)
    x = (counts / np.maximum(use, 1))[found]
    x = np.where(found > 0, x, np.inf).min(axis=1)
    y, momentum = x.copy(), 1.0
    for _ in range(rounds):
        error = weight * (lengths_of(y) - counts)
        new = np.maximum(0, y - error[found].sum(axis=1) / curve)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x


def plan(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins as (lengths with their multiplicity, repeats) that use every piece of the histogram exactly once."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] += n
    bins: list[tuple[list[tuple[int, int]], int]] = []
    found = patterns(np.flatnonzero(left), size)
    repeats = np.floor(fit_repeats(found, left.astype(float)) + 1e-6).astype(np.int64)
    for k in np.argsort(-repeats, kind="stable"):
        if not repeats[k]:
            break
        lengths, times = np.unique(found[k][found[k] > 0], return_counts=True)
        n = int(min(repeats[k], (left[lengths] // times).min()))
        if n:
            left[lengths] -= n * times
            bins.append(([(int(a), int(t)) for a, t in zip(lengths, times, strict=True)], n))
    # the rest best-fit decreasing: bins of one remaining room and content are one entry
    open_bins: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            room = next((r for r in range(length, size) if open_bins.get(r)), None)
            if room is None:
                fit = size // length
                whole, rest = divmod(n, fit)
                for times, many in ((fit, whole), (rest, 1)):
                    if times and many:
                        open_bins.setdefault(size - times * length, []).append(([(length, times)], many))
                break
            content, many = open_bins[room].pop()
            take = min(n, many)
            if take < many:
                open_bins[room].append((content, many - take))
            open_bins.setdefault(room - length, []).append(([*content, (length, 1)], take))
            n -= take
    return bins + [b for entries in open_bins.values() for b in entries]


def intervals(bins: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, offset, repeats), by length and rank."""
    rows, used, sequence = [], {}, 0
    for content, many in bins:
        offset = 0
        for length, times in content:
            first = used.get(length, 0)
            rows.append((length, first, sequence, offset, many))
            used[length] = first + times * many
            offset += times * length
        sequence += many
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end: int = END,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with sequence_id and offset, gapless from 0 in every sequence; ``with_ids`` keeps the token ids."""
    rows = materialise(pieces(docs, tokenizer, size, end, with_ids, id_col, text_col), "pieces")
    histogram = {int(r.length): r["count"] for r in rows.groupBy("length").count().collect()}
    table = intervals(plan(histogram, size))
    buckets = max(shuffle_partitions(spark), -(-sum(histogram.values()) // BUCKET_ROWS))
    keyed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (keyed.groupBy("length", "bucket").count()
              .withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (keyed.withColumn("inside", inside).join(counts, ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("inside") - 1).drop("before", "inside", "bucket"))
    key = (table[:, 0] << 50) + table[:, 1]  # the plan's size depends on the sequence size alone

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            length, rank = b["length"].to_numpy(np.int64), b["rank"].to_numpy(np.int64)
            row = table[np.searchsorted(key, (length << 50) + rank, "right") - 1]
            nth, turn = np.divmod(rank - row[:, 1], row[:, 4])
            out = b.drop(columns="rank")
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out.assign(sequence_id=row[:, 2] + turn, offset=row[:, 3] + nth * length)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return ranked.select(*columns, "rank").mapInPandas(
        place, _PIECE + (", ids binary" if with_ids else "") + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """Packed sequences (sequence_id, length, ids: little-endian 32-bit) of ``pack(..., with_ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # a sequence holds at most ``size`` tokens
    joined = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))

"""Exact dedup by a minimal perfect hash over the distinct digests of a history.

``build_index`` turns a history into shards. A shard holds a minimal perfect hash (levels of bit arrays; a key's rank
among the set bits is its slot) and, by slot, the full digest, the winner's locator and the number of rows seen.
``resolve`` looks the distinct digests of a batch up in the index; a hit counts only if the slot's full digest equals
the key byte by byte, since the hash also gives a slot to most keys outside it. Hits are repeats of the history; the
others group among themselves.

Cases: null text counts as empty; of equal texts the row with the largest id stays; ids may be null (smallest) or
repeated (exactly one of the repeated rows stays); an empty history or batch is allowed; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.llm.common import materialise, shuffle_partitions

SHARD_KEYS = 50_000  # distinct digests a shard holds on average: its rows of about 60 bytes fit any task
GAMMA = 1.5  # bits of a level per remaining key
MAX_LEVELS = 60

_INDEX = "shard int, n int, levels binary, bits binary, digests binary, ids binary, null_ids binary, uids binary, counts binary"
_RESOLVED = "digest binary, keep_id long, keep_uid long, group_size long, known boolean"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, uid, digest), written once; ``uid`` tells repeated rows apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)).alias("digest"))
    return materialise(rows.withColumn("uid", F.monotonically_increasing_id()), "digests")


def distinct_digests(rows: DataFrame) -> DataFrame:
    """Per digest the winner's locator and the number of rows; combined in every task before the shuffle."""
    return (rows.groupBy("digest")
            .agg(F.max(F.struct(F.col("doc_id"), F.col("uid"))).alias("w"), F.count("*").alias("n_rows"))
            .select("digest", F.col("w.doc_id").alias("keep_id"), F.col("w.uid").alias("keep_uid"), "n_rows"))


def _shard(n: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int")


def _halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = keys.view("<u8")
    return words[:, 0].copy(), words[:, 1] | np.uint64(1)


def _place(h: np.ndarray, step: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h + np.uint64(level + 1) * step
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Minimal perfect hash of distinct 32-byte keys (n, 32 uint8): level sizes, all levels' bits, each key's slot."""
    h, step = _halves(keys)
    left = np.arange(len(keys))
    sizes, bits, at, where = [], [], 0, np.zeros(len(keys), np.int64)
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("digests that agree in 128 bits")
        size = max(8, int(GAMMA * len(left)))
        place = _place(h[left], step[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        hit = alone[place]
        where[left[hit]] = at + place[hit]
        bits.append(alone)
        sizes.append(size)
        at += size
        left = left[~hit]
    flags = np.concatenate(bits) if bits else np.zeros(0, bool)
    rank = np.cumsum(flags) - flags
    return sizes, flags, rank[where] if len(keys) else where


def lookup_hash(keys: np.ndarray, sizes: list[int], flags: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 where no level has its bit. Keys outside the hash may get any slot."""
    h, step = _halves(keys)
    rank = np.cumsum(flags) - flags
    slot, left, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        place = at + _place(h[left], step[left], level, size)
        hit = flags[place]
        slot[left[hit]] = rank[place[hit]]
        left = left[~hit]
        at += size
    return slot


def _keys(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def _ids(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    null = column.isna().to_numpy()
    return column.fillna(0).to_numpy(np.int64), null


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = _keys(pdf["digest"])
    sizes, flags, slot = build_hash(keys)
    order = np.argsort(slot)
    ids, null = _ids(pdf["keep_id"])
    return pd.DataFrame([{
        "shard": int(pdf["shard"].iloc[0]), "n": len(pdf), "levels": np.array(sizes, "<i8").tobytes(),
        "bits": np.packbits(flags).tobytes(), "digests": keys[order].tobytes(), "ids": ids[order].tobytes(),
        "null_ids": np.packbits(null[order]).tobytes(), "uids": pdf["keep_uid"].to_numpy(np.int64)[order].tobytes(),
        "counts": pdf["n_rows"].to_numpy(np.int64)[order].tobytes()}])


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """Index rows, one per shard, of a history given as ``digests`` rows. Digests spread evenly, copies count once."""
    keyed = distinct_digests(history).withColumn("shard", _shard(shards))
    return keyed.groupBy("shard").applyInPandas(_build_shard, _INDEX)


def _resolve_shard(index: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    """Winner and size per digest of the shard: first those of the history, then the batch's own."""
    if len(index):
        row = index.iloc[0]
        n = int(row["n"])
        sizes = np.frombuffer(row["levels"], "<i8").tolist()
        flags = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
        slots = np.frombuffer(row["digests"], np.uint8).reshape(n, 32)
        ids, uids = np.frombuffer(row["ids"], np.int64).copy(), np.frombuffer(row["uids"], np.int64).copy()
        null = np.unpackbits(np.frombuffer(row["null_ids"], np.uint8), count=n).astype(bool)
        counts = np.frombuffer(row["counts"], np.int64).copy()
    else:
        n, sizes, flags, slots = 0, [], np.zeros(0, bool), np.zeros((0, 32), np.uint8)
        ids = uids = counts = np.zeros(0, np.int64)
        null = np.zeros(0, bool)
    keys = _keys(batch["digest"]) if len(batch) else np.zeros((0, 32), np.uint8)
    b_ids, b_null = _ids(batch["keep_id"])
    b_uids, b_counts = batch["keep_uid"].to_numpy(np.int64), batch["n_rows"].to_numpy(np.int64)
    slot = lookup_hash(keys, sizes, flags)
    member = slot >= 0
    member[member] = (slots[slot[member]] == keys[member]).all(axis=1)  # the full digests decide
    at = slot[member]
    m_null, m_ids, m_uids = b_null[member], b_ids[member], b_uids[member]
    higher = np.where(null[at] | m_null, null[at] & (~m_null | (m_uids > uids[at])),
                      (m_ids > ids[at]) | ((m_ids == ids[at]) & (m_uids > uids[at])))
    counts[at] += b_counts[member]
    ids[at[higher]], uids[at[higher]], null[at[higher]] = m_ids[higher], m_uids[higher], m_null[higher]
    rest = ~member
    all_null = np.concatenate([null, b_null[rest]])
    all_ids = pd.Series(np.concatenate([ids, b_ids[rest]]), dtype="Int64").mask(all_null)
    return pd.DataFrame({
        "digest": [x.tobytes() for x in slots] + [x.tobytes() for x in keys[rest]], "keep_id": all_ids,
        "keep_uid": np.concatenate([uids, b_uids[rest]]), "group_size": np.concatenate([counts, b_counts[rest]]),
        "known": np.concatenate([np.ones(n, bool), np.zeros(int(rest.sum()), bool)])})


def resolve(index: DataFrame, batch: DataFrame, shards: int) -> DataFrame:
    """Per distinct digest of history and batch: (digest, keep_id, keep_uid, group_size, known to the history)."""
    keyed = distinct_digests(batch).withColumn("shard", _shard(shards))
    return index.groupBy("shard").cogroup(keyed.groupBy("shard")).applyInPandas(_resolve_shard, _RESOLVED)


def exact_dedup(spark: SparkSession, docs: DataFrame, history_below: int | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, known (its text is in the history).

    Rows with an id below ``history_below`` are the history (default: the middle of the id range), the others the
    batch that is looked up. The rows are joined to their digest's winner, so a hot text is left to the skew join.
    """
    rows = digests(docs, id_col, text_col)
    if history_below is None:
        low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
        history_below = 0 if low is None else (low + high + 1) // 2
    old = F.coalesce(F.col("doc_id") < F.lit(history_below), F.lit(False))
    shards = max(shuffle_partitions(spark), -(-rows.count() // SHARD_KEYS))
    index = materialise(build_index(rows.where(old), shards), "digest-index")
    winners = resolve(index, rows.where(~old), shards)
    return (rows.join(winners, "digest")
            .select("doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), "known"))

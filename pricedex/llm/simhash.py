"""SimHash near-dedup: 64-bit fingerprints linked at a few differing bits, found with vantage-point trees.

A pair within ``max_bits`` differs in at most ``max_bits // bands`` bits of one of the ``bands`` equal bands. Each
band's space of values is partitioned by a vantage-point tree: a node splits its values at the median Hamming distance
from a vantage point, a leaf is a shard. A fingerprint lives in one shard per band and visits the shards that its ball
overlaps; branches are pruned by the triangle inequality (a child whose distances from the vantage point lie further
from the query's than the radius cannot hold a match). Inside a shard, rows sorted by distance from a vantage point are
compared only within ``max_bits`` of each other's distance, and every candidate by its full 64 bits. The trees depend
on the number of bits and shards alone, never on data, and have at most 2^16 leaves.

A leaf that the bounds leave is visited only if the ball has a value in it: the balls are small enough to list, once, when
the tree is built, which spares visits and loses none. Equal fingerprints are one node from the start (a hot text is one
fingerprint). A shard with very many distinct fingerprints or visitors is cut into tiles that different tasks compare. Every task reports a spanning forest of its links, which
has the same components; these are found by ``common.connected_components``.

Cases: null text counts as empty; a text without words has fingerprint zero and links like any other; null ids get a
fingerprint and a component (null only if nothing in it has an id); an empty table gives no rows; repeated rows and extra
columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.llm.common import _forest, as_row, connected_components, materialise, row_fields

BITS = 64
SHARD_ROWS = 512  # distinct fingerprints that live in a shard on average
TILE_ROWS = 16_384  # a shard with more is compared in tiles
MAX_DEPTH = 16


def fingerprint(text: str | None, words: int, seed: int = 42) -> int:
    """SimHash over the word shingles of the text: a bit is set if over half the shingles' hashes have it."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1:].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(tokens) - words + 1)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at: at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def text_key(text_col: str = "text") -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text",
                 keyed: bool = False) -> DataFrame:
    """Rows (doc_id, fingerprint as a signed long) of all documents, ``keyed`` with the text's digest (text_key)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values = np.array([fingerprint(t, shingle_words) for t in b["text"]], np.uint64).view(np.int64)
            yield b.drop(columns="text").assign(doc_id=b["doc_id"].astype("Int64"), fp=values)

    key = [text_key(text_col).alias("text_key")] if keyed else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *key)
    return rows.mapInPandas(run, "doc_id long, " + "text_key binary, " * keyed + "fp long")


class VantageTree:
    """Vantage-point tree over all values of ``bits`` bits: ``home`` is each value's leaf; ``overlaps`` the later leaves."""

    def __init__(self, bits: int, radius: int, depth: int):
        values = np.arange(1 << bits, dtype=np.uint32)
        self.leaves = 1 << depth
        node = np.zeros(len(values), np.int64)  # of this level, in which each value lives
        who, where = values, node  # (value, node) that a search of the value's ball still reaches
        rng = np.random.default_rng(64)
        for _ in range(depth):
            count = int(node.max()) + 1
            order = np.argsort(node, kind="stable")
            first = np.searchsorted(node[order], np.arange(count))
            size = np.diff(np.append(first, len(order)))
            vantage = values[order[np.minimum(first + (rng.random(count) * size).astype(np.int64), len(order) - 1)]]
            far = np.bitwise_count(values ^ vantage[node]).astype(np.int64)
            # the nearer half of the node goes left, ties by value: thresholds are kept as the halves' distance ranges
            order = np.lexsort((values, far, node))
            right = np.zeros(len(values), bool)
            right[order] = np.arange(len(order)) - first[node[order]] >= (size[node[order]] + 1) // 2
            child = 2 * node + right
            low, high = np.full(2 * count, 1 << 30), np.full(2 * count, -1)
            np.minimum.at(low, child, far)
            np.maximum.at(high, child, far)
            reach = np.bitwise_count(who ^ vantage[where]).astype(np.int64)
            parts = []
            for side in (0, 1):
                c = 2 * where + side
                ok = (reach >= low[c] - radius) & (reach <= high[c] + radius)  # triangle inequality
                parts.append((who[ok], c[ok]))
            who, where = (np.concatenate(x) for x in zip(*parts, strict=True))
            node = child
        self.home = node.astype(np.int32)
        later = where > self.home[who]  # a pair meets in the later of its two homes
        who, where = who[later], where[later]
        holds = np.zeros(len(who), bool)  # a reached leaf is visited only if the ball has a value in it
        for mask in _masks(bits, radius):
            holds |= self.home[who ^ mask] == where
        who, where = who[holds], where[holds]
        order = np.argsort(who, kind="stable")
        self.overlap_leaf = where[order].astype(np.int32)
        self.overlap_from = np.searchsorted(who[order], np.arange(len(values) + 1)).astype(np.int32)

    def visits(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every later leaf that the ball of values[row] overlaps."""
        start, count = self.overlap_from[values], np.diff(self.overlap_from)[values]
        row = np.repeat(np.arange(len(values)), count)
        within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        return row, self.overlap_leaf[start[row] + within]


def _masks(bits: int, radius: int) -> list[np.uint32]:
    masks, ring = [np.uint32(0)], {0}
    for _ in range(radius):
        ring = {m | (1 << b) for m in ring for b in range(bits) if not m >> b & 1}
        masks += [np.uint32(m) for m in sorted(ring)]
    return masks


def _bands(fp: np.ndarray, bands: int) -> list[np.ndarray]:
    width = BITS // bands
    return [(fp >> np.uint64(width * b)) & np.uint64((1 << width) - 1) for b in range(bands)]


def _deal(fp: np.ndarray, tree: VantageTree, bands: int, hot: dict[tuple[int, int], tuple[int, int]]) -> Iterator[tuple]:
    """(band, leaf, tile_a, tile_b, kind, fingerprints): kind 0 and 1 are a tile's two chunks of the shard, 2 visitors.

    ``hot`` has the number of chunks of the fingerprints at home in a large shard and of its visitors. A tile is two chunks
    at home, or one (tile_a) and one of visitors (tile_b below zero).
    """
    for band, values in enumerate(_bands(fp, bands)):
        values = values.astype(np.int64)
        row, leaf = tree.visits(values)
        for kind, rows, leaves in ((0, np.arange(len(fp)), tree.home[values].astype(np.int64)), (2, row, leaf)):
            if not len(rows):
                continue
            order = np.argsort(leaves, kind="stable")
            at, start = np.unique(leaves[order], return_index=True)
            for one, part in zip(at.tolist(), np.split(fp[rows[order]], start[1:]), strict=True):
                if (band, one) not in hot:
                    yield band, one, 0, 0, kind, part
                    continue
                tiles, guests = hot[band, one]
                chunk = _chunk(part, tiles if kind == 0 else guests)
                for i in np.unique(chunk).tolist():
                    mine = part[chunk == i]
                    if kind == 2:
                        for t in range(tiles):
                            yield band, one, t, -1 - i, 2, mine
                    else:
                        for t in range(tiles):
                            yield band, one, min(i, t), max(i, t), int(t < i), mine
                        for g in range(guests):
                            yield band, one, i, -1 - g, 0, mine


def _chunk(fp: np.ndarray, tiles: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((fp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(tiles)


def _near(a: np.ndarray, b: np.ndarray, max_bits: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a x b (of a < a if same) within ``max_bits``, in blocks of bounded size."""
    if not len(a) or not len(b):
        return
    vantage = b[0]  # any point: the bound below holds for all
    far_a, far_b = (np.bitwise_count(x ^ vantage).astype(np.int16) for x in (a, b))
    by_a, by_b = np.argsort(far_a, kind="stable"), np.argsort(far_b, kind="stable")
    a, b, far_a, far_b = a[by_a], b[by_b], far_a[by_a], far_b[by_b]
    step = max(1, (1 << 20) // len(b))
    for at in range(0, len(a), step):
        block = a[at: at + step]
        lo = np.searchsorted(far_b, far_a[at] - max_bits, "left")
        hi = np.searchsorted(far_b, far_a[min(at + step, len(a)) - 1] + max_bits, "right")
        i, j = np.nonzero(np.bitwise_count(block[:, None] ^ b[None, lo:hi]) <= max_bits)
        u, v = block[i], b[lo + j]
        if same:
            once = u < v
            u, v = u[once], v[once]
        if len(u):
            yield u, v


def _compare(max_bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = [np.frombuffer(b"".join(pdf["fps"][pdf["kind"] == k]), np.uint64) for k in (0, 1, 2)]
        home, other, visitors = sides
        a, b = int(pdf["tile_a"].iloc[0]), int(pdf["tile_b"].iloc[0])
        found = [(visitors, home, False)] if b < 0 else [(home, home, True), (visitors, home, False)] if a == b else [
            (home, other, False)]
        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a, b, same in found:
            for x, y in _near(a, b, max_bits, same):
                u, v = np.concatenate([u, x.view(np.int64)]), np.concatenate([v, y.view(np.int64)])
                if len(u) > 1 << 18:
                    u, v = _forest(u, v)
        if len(u):
            u, v = _forest(u, v)
        return pd.DataFrame({"u": u, "v": v})

    return run


def near_links(distinct: DataFrame, max_bits: int, bands: int = 4) -> DataFrame:
    """Links (u, v) between the distinct fingerprints (column fp) that give the components of all pairs within max_bits."""
    width, radius = BITS // bands, max_bits // bands
    if width > MAX_DEPTH:
        raise ValueError("bands of more than 16 bits")
    rows = distinct.count()
    depth = int(min(width, max(0, np.ceil(np.log2(max(1, rows) / SHARD_ROWS)))))
    tree = VantageTree(width, radius, depth)
    home = tree.home

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, guests = (np.zeros((bands, tree.leaves), np.int64) for _ in range(2))
        for b in batches:
            for band, values in enumerate(_bands(b["fp"].to_numpy(np.int64).view(np.uint64), bands)):
                values = values.astype(np.int64)
                total[band] += np.bincount(home[values], minlength=tree.leaves)
                guests[band] += np.bincount(tree.visits(values)[1], minlength=tree.leaves)
        band, leaf = np.nonzero(total + guests)
        yield pd.DataFrame({"band": band, "leaf": leaf, "n": total[band, leaf], "guests": guests[band, leaf]})

    # at most bands x 2^16 shards exist; only those too large for one task come to the driver, as counts
    large = (distinct.select("fp").mapInPandas(count, "band int, leaf int, n long, guests long").groupBy("band", "leaf")
             .agg(F.sum("n").alias("n"), F.sum("guests").alias("guests"))
             .where((F.col("n") > TILE_ROWS) | (F.col("guests") > TILE_ROWS)).collect())
    hot = {(r.band, r.leaf): (max(1, -(-r.n // TILE_ROWS)), max(1, -(-r.guests // TILE_ROWS))) for r in large}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = list(_deal(b["fp"].to_numpy(np.int64).view(np.uint64), tree, bands, hot))
            if rows:
                out = pd.DataFrame(rows, columns=["band", "leaf", "tile_a", "tile_b", "kind", "fps"])
                out["fps"] = [x.tobytes() for x in out["fps"]]
                yield out

    dealt = distinct.select("fp").mapInPandas(deal, "band int, leaf int, tile_a int, tile_b int, kind int, fps binary")
    return dealt.groupBy("band", "leaf", "tile_a", "tile_b").applyInPandas(_compare(max_bits), "u long, v long")


def _named(rows: DataFrame, max_bits: int, low: Column) -> DataFrame:
    """Distinct fingerprints with their component: fp, low (of the fingerprint's rows), component."""
    distinct = materialise(rows.groupBy("fp").agg(low.alias("low")), "distinct-fingerprints")
    linked = connected_components(near_links(distinct, max_bits))
    return distinct.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))


def components(spark: SparkSession, docs: DataFrame, shingle_words: int = 4, max_bits: int = 4,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (smallest id reachable, itself included)."""
    rows = materialise(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    named = _named(rows, max_bits, F.min("doc_id"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    by_fp = named.join(lowest, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(column) -> F.Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(spark: SparkSession, docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents (columns doc_id, text and any others) less near-copies: one row of each component stays.

    It is the row with the smallest id (rows without an id come last), then with the smallest digest of the text, so an
    id that stands on texts of several components may stay once in each. Rows equal in id and text count once.
    """
    rows = materialise(fingerprints(docs, shingle_words, keyed=True), "fingerprints")
    alike = rows.groupBy("fp", "doc_id", "text_key").agg(F.count("*").alias("times"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "times")
    stay = materialise(_named(alike, max_bits, F.min(row)).groupBy("component").agg(F.min("low").alias("row"))
                       .select(F.col("row.doc_id").alias("_id"), F.col("row.text_key").alias("_key"),
                               F.col("row.times").alias("_times")), "kept-rows")
    keyed = docs.select(as_row(docs).alias("row"), F.col("doc_id").cast("long").alias("id"), text_key().alias("key"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    kept = keyed.join(stay.where("_times = 1"), same, "left_semi")
    repeated = stay.where("_times > 1")
    if not repeated.isEmpty():
        kept = kept.unionByName(keyed.join(repeated, same, "left_semi").dropDuplicates(["id", "key"]))
    return kept.select(*row_fields(docs, "row"))

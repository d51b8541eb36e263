"""Line dedup with a log-template tree: lines whose template recurs across documents are dropped.

Tree: a line's first level is its number of tokens, the next ``DEPTH`` levels its leading tokens (a token with a digit
is a variable field and stands as ``<*>``). Two lines of a leaf that agree on the share ``similarity`` of their positions are
linked, every such pair; lines linked to each other, directly or through others, are one template whose differing positions
are variable fields. This is the definition at every size; how pairs are found depends on the leaf:

A small leaf is compared whole, many leaves to a task. In a large one the positions after the leading ones are cut into one
block more than may differ, so linked lines agree on a whole block; which positions go together follows from how often their
tokens are equal in this leaf, so that a block of constant positions, which all lines share, arises only if nothing else is
left. The lines that share a block are first compared with one of them. Those that are then of several components are
compared pair by pair: in one task or, when they are many, in tiles that different tasks take. Pairs of one component are not
looked at again, and a task reports a spanning forest of its links.

A template recurs if documents with at least ``min_docs`` different texts have it. It stays in the text with the smallest
id that has it and is dropped everywhere else, so nothing is lost from the corpus; equal texts are treated alike (copies
of whole documents are not this operator's concern).

Cases: null or empty texts have no lines and stay as they are; blank lines are always kept; a line without more tokens than
the leading ones is a template of its own; a document may lose all its lines and keeps an empty text; null ids count as
larger than all; repeated rows are equal texts; an empty table stays empty; extra columns of any name pass through.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.llm.common import _forest, as_row, connected_components, materialise, row_fields

DEPTH = 4
FILTER_BITS = 1 << 26  # of the bitmap that keeps most lines from being shuffled: 8 MB, whatever the input
MIN_DOCS = 2
SIMILARITY = 0.8
FEW_LINES = 16  # a leaf of as many lines is compared whole, however long they are
SMALL_LINES, SMALL_TOKENS = 2048, 1 << 18  # so is one of as many lines and tokens
TILE_LINES, TILE_TOKENS = 16_384, 1 << 21  # more lines that share a block are compared in tiles
GROUP = ["leaf", "block", "key", "tile_a", "tile_b"]  # what a task compares at a time
VARIABLE = "<*>"
_DIGIT = re.compile(rb"[0-9]")


def tokens(line: bytes) -> list[bytes]:
    """Tokens between ASCII white space; those with a digit stand as the variable field."""
    found = line.split()
    if _DIGIT.search(line):
        return [VARIABLE.encode() if _DIGIT.search(t) else t for t in found]
    return found


def needed(n: int, similarity: float) -> int:
    """How many of n positions must agree."""
    return math.ceil(similarity * n - 1e-9)


def block_bounds(n: int, similarity: float) -> list[tuple[int, int]]:
    """The blocks of positions of a line of n tokens: lines of a leaf that agree on enough positions share one whole."""
    rest, differ = n - DEPTH, n - needed(n, similarity)
    if differ >= rest:  # any two lines of the leaf agree on enough
        return [(n, n)]
    cuts = [DEPTH + i * rest // (differ + 1) for i in range(differ + 2)]
    return list(pairwise(cuts))


class _Lines:
    """Columns of the lines of some texts: number, tokens, hash of the leaf, hash of the line, and the line itself."""

    def __init__(self, texts: pd.Series, bodies: bool = False):
        self.row, self.number, self.n_tokens, leaf, line = [], [], [], [], []
        self.body: list[bytes] = []
        digest = xxhash.xxh64_intdigest
        for row, text in enumerate(texts):
            for number, raw in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
                found = tokens(raw)
                n = len(found)
                if n:
                    body = b" ".join(found)
                    self.row.append(row)
                    self.number.append(number)
                    self.n_tokens.append(n)
                    leaf.append(digest(b"%d %b" % (n, b" ".join(found[:DEPTH]))))
                    line.append(digest(body))
                    if bodies:
                        self.body.append(body)
        self.leaf, self.line = (np.array(x, np.uint64).view(np.int64) for x in (leaf, line))


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found = _Lines(b["text"])
        if found.row:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64").iloc[found.row].array,
                                "text_key": b["text_key"].to_numpy()[found.row], "line_no": found.number,
                                "n_tokens": found.n_tokens, "leaf": found.leaf, "line": found.line})


def _texts(bitmap):
    """(leaf, line, body) of the lines whose leaf is in the bitmap; others may be, as leaves share its bits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for b in batches:
            found = _Lines(b["text"], bodies=True)
            at = (found.leaf % FILTER_BITS).astype(np.int64)
            keep = np.flatnonzero(bits[at >> 3] >> (at & 7) & 1)
            if len(keep):
                rows = pd.DataFrame({"leaf": found.leaf[keep], "line": found.line[keep], "body": [found.body[i] for i in keep]})
                rows = rows.drop_duplicates(["leaf", "line"])
                yield rows.assign(body=[x.decode("utf-8", "surrogatepass") for x in rows["body"]])
    return run


def _bitmap(leaves: DataFrame) -> bytes:
    """One bit for each leaf's hash modulo the number of bits: built by Spark in pieces of 4 KB, of which the driver gets at
    most ``FILTER_BITS`` bits."""
    bit = F.pmod("leaf", F.lit(FILTER_BITS).cast("long")) + 1  # the functions count from one
    parts = leaves.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("position")).groupBy(
        "bucket").agg(F.bitmap_construct_agg("position").alias("bits")).collect()
    out, size = bytearray(FILTER_BITS // 8), 4096
    for r in parts:
        out[size * (r.bucket - 1): size * r.bucket] = r.bits
    return bytes(out)


def _order(weights: list[float], bounds: list[tuple[int, int]]) -> list[int]:
    """Positions of a line, permuted so that the blocks cut at ``bounds`` are about equal in weight: the heaviest position
    goes to the block with the least weight that has a place left."""
    slots = [list(range(x, y)) for x, y in bounds]
    total = [(0.0, i) for i, free in enumerate(slots) if free]
    out = list(range(len(weights)))
    for position in sorted(range(DEPTH, len(weights)), key=lambda p: -weights[p]) if total else []:
        weight, i = heapq.heappop(total)
        out[slots[i].pop()] = position
        if slots[i]:
            heapq.heappush(total, (weight + weights[position], i))
    return out


def _orders(bodies: DataFrame, similarity: float) -> DataFrame:
    """(leaf, order): the positions of the leaf's lines as the blocks take them. A position weighs more the fewer pairs of
    lines have the same token there."""
    at = bodies.select("leaf", F.posexplode(F.split("body", " ")).alias("position", "token"))
    same = at.groupBy("leaf", "position", "token").agg(F.count("*").cast("double").alias("n")).groupBy("leaf", "position").agg(
        (2 * F.log(F.sum("n")) - F.log(F.sum(F.col("n") * F.col("n")))).alias("weight"))
    weights = same.groupBy("leaf").agg(  # bounded by a line's tokens
        F.transform(F.array_sort(F.collect_list(F.struct("position", "weight"))), lambda x: x["weight"]).alias("weights"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"leaf": b["leaf"], "order": [_order(w.tolist(), block_bounds(len(w), similarity)) for w in b["weights"]]})

    return weights.mapInPandas(run, "leaf long, order array<int>")


def _blocks(similarity: float):
    """(leaf, line, block, key) for every block of every line; keys of different tokens may be equal, at the cost of a look."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds: dict[int, list[tuple[int, int]]] = {}
        digest = xxhash.xxh64_intdigest
        for b in batches:
            row, block, key = array("q"), array("i"), array("Q")
            for i, (body, order) in enumerate(zip(b.column("body").to_pylist(), b.column("order").to_pylist(), strict=True)):
                words = body.split(" ")
                words = [words[p] for p in order]
                n = len(words)
                if n not in bounds:
                    bounds[n] = block_bounds(n, similarity)
                row.extend([i] * len(bounds[n]))
                block.extend(range(len(bounds[n])))
                key.extend([digest(" ".join(words[x:y]).encode("utf-8", "surrogatepass")) for x, y in bounds[n]])
            at = pa.array(np.frombuffer(row, np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("leaf").take(at), b.column("line").take(at), pa.array(np.frombuffer(block, np.int32)),
                 pa.array(np.frombuffer(key, np.uint64).view(np.int64))], ["leaf", "line", "block", "key"])
    return run


def _agreeing(similarity: float):
    """The pairs (line, leader) whose bodies agree on enough positions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for mine, other in zip(b.column("body").to_pylist(), b.column("leader_body").to_pylist(), strict=True):
                words = mine.split(" ")
                keep.append(sum(map(eq, words, other.split(" "))) >= needed(len(words), similarity))
            yield pa.RecordBatch.from_arrays([b.column("line"), b.column("leader")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def _near(codes: np.ndarray, label: np.ndarray, side: np.ndarray, differ: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of labels that join the lines (columns of ``codes``) of which at most ``differ`` positions (rows) are unlike.

    Lines of side 0 are compared with those of side 1 or, if there are none, with each other, unless their labels are joined
    already; in blocks of bounded size.
    """
    names, label = np.unique(label, return_inverse=True)
    root = np.arange(len(names))
    codes = np.ascontiguousarray(codes[(codes != codes[:, :1]).any(axis=1)])
    if len(codes) <= differ:  # any two agree on enough
        root[:] = 0
    elif len(label) > 2:
        mine, other = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        other = other if len(other) else mine
        step = max(1, (1 << 20) // len(other))
        for at in range(0, len(mine), step):
            rows, now = mine[at: at + step], root[label]
            if (now == now[0]).all():
                break
            unlike = np.zeros((len(rows), len(other)), np.int32)
            for position in codes:
                unlike += position[rows, None] != position[None, other]
            i, j = np.nonzero((unlike <= differ) & (now[rows, None] != now[None, other]))
            if len(i):
                node, low = _forest(now[rows[i]], now[other[j]])
                to = np.arange(len(names))
                to[node] = low
                root = to[root]
    far = root != np.arange(len(names))
    return names[far], names[root[far]]


def _compare(similarity: float):
    """Links (u, v) between the labels of the lines of each group; the rows of a group come one after the other."""
    def links(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        ids: dict[str, int] = {}
        codes = np.array([[ids.setdefault(t, len(ids)) for t in body.split(" ")] for r in rows for body in r[0]], np.int32).T
        label, side = (np.concatenate([r[k] for r in rows]) for k in (1, 2))
        return _near(codes, label, side, len(codes) - needed(len(codes), similarity))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, of = [], None  # the group that may go on in the next batch
        for b in batches:
            if not len(b):
                continue
            key = b[GROUP].to_numpy(np.int64)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(b)]
            body, label, side = b["body"].tolist(), b["label"].to_numpy(np.int64), b["side"].to_numpy()
            found = []
            for x, y in pairwise(cuts):
                if held and not np.array_equal(of, key[x]):
                    found.append(links(held))
                    held = []
                held.append((body[x:y], label[x:y], side[x:y]))
                of = key[x]
            if found:
                u, v = (np.concatenate(z) for z in zip(*found, strict=True))
                yield pd.DataFrame({"u": u, "v": v})
        if held:
            u, v = links(held)
            yield pd.DataFrame({"u": u, "v": v})
    return run


def _dealt(bodies: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """For the lines of large leaves: links (u, v) with the first line that has the same block, and the groups of lines that
    share a block and that these links leave in several components, as rows for ``_compare`` labelled with the component."""
    ordered = bodies.join(_orders(bodies, similarity), "leaf")
    blocks = materialise(ordered.mapInArrow(_blocks(similarity), "leaf long, line long, block int, key long"), "line-blocks")
    shared = ["leaf", "block", "key"]
    leaders = blocks.groupBy(*shared).agg(F.min("line").alias("leader"), F.count("*").alias("n")).where("n > 1")
    pairs = blocks.join(leaders.drop("n"), shared).where("leader < line").select("leaf", "line", "leader").distinct()
    named = bodies.select("leaf", F.col("line").alias("leader"), F.col("body").alias("leader_body"))
    pairs = pairs.join(bodies, ["leaf", "line"]).join(named, ["leaf", "leader"])
    stars = materialise(pairs.select("line", "leader", "body", "leader_body").mapInArrow(_agreeing(similarity), "u long, v long"), "leaders")
    joined = connected_components(stars).select(F.col("node").alias("line"), F.col("component").alias("label"))
    labelled = blocks.join(joined, "line", "left").withColumn("label", F.coalesce("label", "line"))
    apart = labelled.groupBy(*shared).agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    apart = apart.where("low < high").drop("low", "high")
    size = F.greatest(F.lit(FEW_LINES), F.least(F.lit(TILE_LINES), F.floor(F.lit(TILE_TOKENS) / F.col("n_tokens"))))
    tiles = F.ceil(F.col("n") / size)
    rows = labelled.join(apart, shared).join(bodies, ["leaf", "line"]).withColumn("tiles", tiles)
    rows = rows.withColumn("mine", F.expr("pmod(line, tiles)")).withColumn("tile", F.explode(F.expr("sequence(0L, tiles - 1)")))
    return stars, rows.select(
        "leaf", F.col("block").cast("long").alias("block"), "key", F.least("mine", "tile").alias("tile_a"),
        F.greatest("mine", "tile").alias("tile_b"), (F.col("tile") < F.col("mine")).cast("int").alias("side"), "label", "body")


def _templates(rows: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """(line, template) for the lines that are linked with others: a template goes by the hash of its first line.

    Only leaves with several different lines are looked at. They are a table; a bitmap of bounded size of their hashes keeps
    most other lines from being shuffled to it.
    """
    total = F.col("leaf_lines") * F.col("n_tokens")
    large = (F.col("leaf_lines") > FEW_LINES) & ((F.col("leaf_lines") > SMALL_LINES) | (total > SMALL_TOKENS))
    leaves = lines.where(F.col("n_tokens") > DEPTH).groupBy("leaf").agg(F.count("*").alias("leaf_lines"), F.max("n_tokens").alias("n_tokens"))
    leaves = materialise(leaves.where("leaf_lines > 1").select("leaf", "n_tokens", large.alias("large")), "leaves")
    bitmap = rows.sparkSession.sparkContext.broadcast(_bitmap(leaves))
    bodies = materialise(rows.select("text").mapInPandas(_texts(bitmap), "leaf long, line long, body string").join(leaves, "leaf")
                         .dropDuplicates(["leaf", "line"]), "line-bodies")
    whole = [F.lit(0).cast("long").alias(c) for c in GROUP[1:]]
    groups = bodies.where(~F.col("large")).select("leaf", *whole, F.lit(0).alias("side"), F.col("line").alias("label"), "body")
    stars = None
    if not leaves.where("large").isEmpty():
        stars, dealt = _dealt(bodies.where("large").drop("large"), similarity)
        groups = groups.unionByName(dealt)
    links = groups.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInPandas(_compare(similarity), "u long, v long")
    links = links.unionByName(stars) if stars else links
    return connected_components(links).select(F.col("node").alias("line"), F.col("component").alias("template"))


def dropped_lines(docs: DataFrame, similarity: float = SIMILARITY, min_docs: int = MIN_DOCS) -> DataFrame:
    """Occurrences of recurring templates outside the text that keeps them: doc_id, text_key, line_no, leaf, template, n_docs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    index = materialise(rows.mapInPandas(
        _index, "doc_id long, text_key long, line_no int, n_tokens int, leaf long, line long"), "lines")
    per_text = index.groupBy("leaf", "line", "n_tokens", "text_key").agg(F.min("doc_id").alias("low"))
    lines = materialise(per_text.groupBy("leaf", "line", "n_tokens").agg(F.count("*").alias("texts")), "distinct-lines")
    named = (lines.join(_templates(rows, lines, similarity), "line", "left")
             .withColumn("template", F.coalesce("template", "line")))
    # the lines' texts bound the template's: a text may have several lines of one template
    possible = named.groupBy("leaf", "template").agg(F.sum("texts").alias("most")).where(F.col("most") >= min_docs)
    candidates = materialise(named.select("leaf", "line", "template").join(possible.drop("most"), ["leaf", "template"]), "candidates")
    seen = materialise(index.join(candidates, ["leaf", "line"]), "seen-lines")
    by_text = seen.groupBy("leaf", "template", "text_key").agg(F.min("doc_id").alias("low"))
    order = F.struct(F.col("low").isNull(), F.col("low"), F.col("text_key"))
    recurring = (by_text.groupBy("leaf", "template")
                 .agg(F.count("*").alias("n_docs"), F.min_by("text_key", order).alias("keeper"))
                 .where(F.col("n_docs") >= min_docs))
    return (seen.join(recurring, ["leaf", "template"]).where("text_key <> keeper")
            .select("doc_id", "text_key", "line_no", "leaf", "template", "n_docs"))


def drop_lines(spark: SparkSession, docs: DataFrame, text_col: str = "text", removed_col: str | None = None,
               length_col: str | None = None, **options) -> DataFrame:
    """``docs`` with recurring lines cut from the text; all rows and columns stay.

    ``removed_col`` (a new name) adds the number of lines cut; ``length_col`` names a column that holds the text's length and is set
    anew where lines are cut. Documents and cuts meet by id and text, so the rows of an id with
    different texts keep apart.
    """
    found = dropped_lines(docs.select("doc_id", F.col(text_col).alias("text")), **options)
    cuts = found.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("cut")).select(
        F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_key"), "cut")  # bounded by the document's lines
    keyed = docs.select(as_row(docs).alias("row"), F.col("doc_id").cast("long").alias("id"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    joined = keyed.join(cuts, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("key") == F.col("cut_key")), "left")
    text = F.col("row").getField(text_col)
    rest = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(F.col("cut"), i)), "\n")
    changed = {text_col: F.when(F.col("cut").isNull(), text).otherwise(rest)}
    if length_col:
        length = F.length(rest).cast(docs.schema[length_col].dataType)
        changed[length_col] = F.when(F.col("cut").isNull(), F.col("row").getField(length_col)).otherwise(length)
    columns = row_fields(docs, "row", changed)
    if removed_col:
        columns.append(F.coalesce(F.size("cut"), F.lit(0)).alias(removed_col))
    return joined.select(*columns)

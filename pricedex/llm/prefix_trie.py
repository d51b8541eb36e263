"""Prefix trie of conversations: ROLLUP over positional turn-id columns aggregates all prefixes of a block together.

Turns get their positions by a range sort over (conversation, turn), numbered where they lie; a conversation that spans
several ranges gets the earlier ranges' counts added, so one with very many turns is no single task's. Positions are cut
into blocks of ``block_turns`` columns, one row per conversation and block. A block's nodes are one
``GROUP BY node, ROLLUP (t1, ..., tB)``: the grouping id tells how deep a row's prefix goes. ``node`` is the node of the
block before in which the conversation lies, named by its smallest member: two nodes of one depth share no member, so
(depth, smallest member) is a node's exact identity and paths are never written out. Blocks follow one another until no
node with two members goes on; a conversation that shares no further turn with another is a chain of nodes and leaves the
rounds at once, so the number of rounds is the longest shared prefix over ``block_turns``.

Sums over subtrees come from a second ROLLUP over the blocks' nodes, from the last block to the first; a block hands the
sums of its roots to the nodes that they stand for. The members that end in a node are hashed in ascending order: a range
sort deals a node's members to several tasks, which write them as strings, and one stream per node joins only those.

A turn's identity is the first 128 bits of the SHA-256 of role and text (the role's length before both), so no text is
shuffled. Groups are aggregated before their shuffles; a first turn that a third of all conversations begin with is one
row of every task.

Cases: null role or text counts as empty; turns in order, null first, those of one turn number by their identity (repeated
rows are turns of their own); rows without conversation id belong to no conversation and are left out; an empty table has
no nodes, not even a root; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricedex.llm.common import materialise, shuffle_partitions

BLOCK_TURNS = 8
WORD = r"[^\x20\x09-\x0D]+"

NODE_SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
               "saved_tokens long, ends_sha256 string")
NODE_COLUMNS = [f.split()[0] for f in NODE_SCHEMA.split(", ")][:-1]


def n_words(text: Column) -> Column:
    """Number of runs of other characters than ASCII white space."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def turn_identity(role: Column, text: Column) -> Column:
    joined = F.concat(F.octet_length(role).cast("string"), F.lit(" "), role, text)
    return F.unhex(F.substring(F.sha2(joined.cast("binary"), 256), 1, 32))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and each turn's place among its conversation's turns in the partition (rows come sorted)."""
    part = TaskContext.get().partitionId()
    last, seen = None, 0
    for b in batches:
        conv = b.column("conv_id").to_numpy()
        if not len(conv):
            continue
        starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
        if last == conv[0]:
            first = len(conv) if len(starts) == 1 else starts[1]
            place[:first] += seen
        last, seen = int(conv[-1]), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("conv_id", "id", "words")), pa.array(np.full(len(conv), part, np.int32)), pa.array(place)],
            ["conv_id", "id", "words", "part", "place"])


def positioned_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, position from 0, id, words): the conversations' turns in order, as a table."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_identity(role, text).alias("id"), n_words(text).alias("words"))
    n = shuffle_partitions(conversations.sparkSession)
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "id"]
    dealt = turns.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    numbered = materialise(dealt.select("conv_id", "id", "words").mapInArrow(
        _number, "conv_id long, id binary, words long, part int, place long"), "turns")
    # only a partition's first and last conversation can lie in another one too: two rows a partition at most
    edge = numbered.groupBy("part").agg(F.array_distinct(F.array(F.min("conv_id"), F.max("conv_id"))).alias("edge"))
    cut = edge.select(F.explode("edge").alias("conv_id")).groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1")
    sizes = numbered.join(F.broadcast(cut.select("conv_id")), "conv_id").groupBy("conv_id", "part").agg(
        F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return materialise(numbered.join(F.broadcast(before), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("position"), "id", "words"), "positions")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that have turns."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))


def _path(columns: list[str], levels: Column | int) -> Column:
    """The first ``levels`` turn ids in one binary value; they are equally long, so no two paths look alike."""
    return F.concat(*[F.when(F.lit(i) < levels, F.coalesce(F.col(c)["id"], F.lit(b""))).otherwise(F.lit(b""))
                      for i, c in enumerate(columns)])


def _rollup(rows: DataFrame, columns: list[str], sums: str) -> DataFrame:
    """All prefixes of a block at once: one row per (node, t1, ..., t<level>), the node itself as level 0."""
    listed = ", ".join(columns)
    found = rows.sparkSession.sql(
        f"SELECT node, {listed}, grouping_id() AS gid, {sums} FROM {{rows}} GROUP BY node, ROLLUP ({listed})", rows=rows)
    level = F.lit(len(columns)) - F.bit_count("gid")  # the grouping id has a bit for each column rolled up
    last = F.element_at(F.array(*columns), F.greatest(level, F.lit(1)))
    # a path that ends before the level is no prefix of that length
    return found.withColumn("level", level.cast("int")).withColumn("last", last).where(
        (F.col("level") == 0) | F.col("last").isNotNull()).drop("gid")


def _block_nodes(here: DataFrame, columns: list[str], first: int) -> DataFrame:
    """Nodes of one block with their parents: node, t1..tB, level, depth, conv_id, n_convs, own_saved, path, parent."""
    found = _rollup(here, columns, "min(conv_id) AS conv_id, count(*) AS n_convs").where("level > 0")
    own = (F.col("n_convs") - 1) * F.col("last")["words"]
    found = materialise(found.select(
        "node", *columns, "level", (F.lit(first) + F.col("level")).cast("long").alias("depth"), "conv_id", "n_convs",
        own.alias("own_saved"), _path(columns, F.col("level")).alias("path"),
        _path(columns, F.col("level") - 1).alias("parent_path")), "trie-block")
    parents = found.select("node", F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv_id"))
    return found.join(parents, ["node", "parent_path"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "node"))


def _subtrees(nodes: DataFrame, below: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """A block's finished nodes, and what hangs below each node that the block grows from (node, n_children, n_leaves,
    saved). ``below`` is that table of the next block."""
    children = nodes.where("level > 1").groupBy("node", F.col("parent_path").alias("path")).agg(F.count("*").alias("inside"))
    under = below.select(F.col("node").alias("conv_id"), F.lit(len(columns)).alias("level"), F.col("n_children").alias("outside"),
                         F.col("n_leaves").alias("leaves"), "saved")
    known = nodes.join(children, ["node", "path"], "left").join(under, ["conv_id", "level"], "left")
    count = F.coalesce("inside", "outside", F.lit(0).cast("long"))
    known = materialise(known.withColumn("n_children", count).withColumn(
        "leaves", F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.coalesce("leaves", F.lit(0).cast("long")))
    ).withColumn("saved", F.col("own_saved") + F.coalesce("saved", F.lit(0).cast("long"))).drop("inside", "outside"), "trie-known")
    sums = _rollup(known, columns, "sum(leaves) AS n_leaves, sum(saved) AS saved_tokens, count_if(level = 1) AS n_first")
    sums = materialise(sums.withColumn("path", _path(columns, F.col("level"))).drop(*columns), "trie-sums")
    finished = known.join(sums.where("level > 0").select("node", "path", "n_leaves", "saved_tokens"), ["node", "path"])
    upper = sums.where("level = 0").select("node", F.col("n_first").alias("n_children"), "n_leaves",
                                           F.col("saved_tokens").alias("saved"))
    return finished.select(*NODE_COLUMNS), upper


def trie(turns: DataFrame, members: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Nodes of the trie of the conversations ``members`` (conv_id, n_turns) with the turns (conv_id, position, id, words).

    Columns as in NODE_SCHEMA; positions run from 0 without gaps; members without turns end in the root.
    """
    spark, b = turns.sparkSession, block_turns
    columns = [f"t{i + 1}" for i in range(b)]
    members = materialise(members, "members")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).first()
    if not root.n_convs:
        return spark.createDataFrame([], NODE_SCHEMA)
    turn = F.struct("id", "words")
    rows = materialise(
        turns.groupBy("conv_id", F.floor(F.col("position") / b).alias("block")).agg(
            *[F.max(F.when(F.col("position") % b == i, turn)).alias(c) for i, c in enumerate(columns)])
        .join(members, "conv_id"), "turn-blocks")
    blocks, ends = [], [members.where("n_turns = 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(root.conv_id).alias("node"), "conv_id")]
    alone = []  # (conv_id, n_turns, start): conversations that share nothing from the depth ``start`` on
    place = members.where("n_turns > 0").select("conv_id", F.lit(root.conv_id).alias("node"))
    while not place.isEmpty():
        first = len(blocks) * b
        here = rows.where(F.col("block") == len(blocks)).join(place, "conv_id")
        nodes = materialise(_block_nodes(here, columns, first), "trie-nodes")
        own = here.select("conv_id", "n_turns", "node", _path(columns, F.lit(b)).alias("path")).join(
            nodes.select("node", "path", F.col("conv_id").alias("own"), "n_convs", "depth"), ["node", "path"])
        own = materialise(own.select("conv_id", "n_turns", "own", "n_convs", "depth"), "places")
        blocks.append(nodes)
        ends.append(own.where("n_turns = depth").select("depth", F.col("own").alias("node"), "conv_id"))
        going = own.where("n_turns > depth")
        alone.append(going.where("n_convs = 1").select("conv_id", "n_turns", F.col("depth").alias("start")))
        place = going.where("n_convs > 1").select("conv_id", F.col("own").alias("node"))
    parts = []
    below = spark.createDataFrame([], "node long, n_children long, n_leaves long, saved long")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    for nodes, single in zip(reversed(blocks), reversed(alone), strict=True):
        chained = single.select(F.col("conv_id").alias("node"), one.alias("n_children"), one.alias("n_leaves"), none.alias("saved"))
        finished, below = _subtrees(nodes, below.unionByName(chained), columns)
        parts.append(finished)
    if alone:
        chains = reduce(DataFrame.unionByName, alone)
        ends.append(chains.select(F.col("n_turns").alias("depth"), F.col("conv_id").alias("node"), "conv_id"))
        depth = F.explode(F.sequence(F.col("block") * b + 1, F.least(F.col("block") * b + b, F.col("n_turns"))))
        chain = rows.select("conv_id", "block").join(chains, "conv_id").where(F.col("block") * b >= F.col("start"))
        parts.append(chain.select("conv_id", "n_turns", depth.alias("depth")).select(
            "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
            F.when(F.col("depth") < F.col("n_turns"), one).otherwise(none).alias("n_children"), one.alias("n_leaves"),
            none.alias("saved_tokens")))
    top = spark.range(1).select(F.lit(root.conv_id).alias("conv_id")).join(
        below.withColumnRenamed("node", "conv_id"), "conv_id", "left")
    parts.append(top.select(
        "conv_id", none.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(root.n_convs).alias("n_convs"),
        F.coalesce("n_children", none).alias("n_children"), F.coalesce("n_leaves", one).alias("n_leaves"),
        F.coalesce("saved", none).alias("saved_tokens")))
    hashed = end_hashes(reduce(DataFrame.unionByName, ends))
    nodes = reduce(DataFrame.unionByName, parts)
    return nodes.join(hashed.withColumnRenamed("node", "conv_id"), ["depth", "conv_id"], "left").select(
        *NODE_COLUMNS, F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of each run of one node's rows in a batch as one string."""
    for b in batches:
        depth, node, conv = (b.column(c).to_numpy() for c in ("depth", "node", "conv_id"))
        if not len(conv):
            continue
        new = (depth[1:] != depth[:-1]) | (node[1:] != node[:-1])
        starts = np.flatnonzero(np.append(True, new))
        ids = list(map(str, conv.tolist()))
        stops = [*starts[1:].tolist(), len(ids)]
        texts = [",".join(ids[i:j]) for i, j in zip(starts.tolist(), stops, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x[starts]) for x in (depth, node, conv)] + [pa.array(texts, pa.string())],
                                         ["depth", "node", "first", "ids"])


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its strings, which come in order; only the digest's state is held."""
    key, state = None, None

    def row(key, state):
        return pa.RecordBatch.from_pylist([{"depth": key[0], "node": key[1], "ends_sha256": state.hexdigest()}])

    for b in batches:
        done = []
        for depth, node, ids in zip(*(b.column(c).to_pylist() for c in ("depth", "node", "ids")), strict=True):
            if (depth, node) == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append(row(key, state))
                key, state = (depth, node), hashlib.sha256()
            state.update(ids.encode())
        yield from done
    if key is not None:
        yield row(key, state)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256) of the rows (depth, node, conv_id): hash of each node's ids, ascending, comma-joined."""
    n = shuffle_partitions(ends.sparkSession)
    dealt = ends.repartitionByRange(n, "depth", "node", "conv_id").sortWithinPartitions("depth", "node", "conv_id")
    pieces = dealt.mapInArrow(_join_ids, "depth long, node long, first long, ids string")
    return pieces.repartition(n, "depth", "node").sortWithinPartitions("depth", "node", "first").mapInArrow(
        _hash_runs, "depth long, node long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The trie of conversations as they are (conv_id, turn, role, text)."""
    turns = positioned_turns(conversations)
    return trie(turns, lengths(turns), block_turns)


def with_shared_openings(turns: DataFrame, family: int = 20, longest: int = 3) -> tuple[DataFrame, DataFrame]:
    """(turns, members) of conversations rebuilt so that prefixes are shared: conversation c begins with the first h turns
    of c - c % family (all it has, none if it does not exist), h = crc32(c) % (longest + 1), then its own after its first h.
    """
    known = lengths(turns)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    base = known.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    plan = known.select("conv_id", F.col("n_turns").alias("own_turns"), h.alias("h"),
                        (F.col("conv_id") - F.col("conv_id") % family).alias("base")).join(base, "base", "left")
    taken = F.least("h", F.coalesce("base_turns", F.lit(0).cast("long")))
    plan = materialise(plan.withColumn("taken", taken), "shared-openings")
    own = turns.join(plan.select("conv_id", "h", "taken"), "conv_id").where("position >= h").select(
        "conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "id", "words")
    opening = turns.where(F.col("position") < longest).withColumnRenamed("conv_id", "base")
    borrowed = opening.join(plan.select("base", "conv_id", "h"), "base").where("position < h").select(
        "conv_id", "position", "id", "words")
    members = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("own_turns") - F.col("h"), F.lit(0).cast("long")))
                          .alias("n_turns"))
    return own.unionByName(borrowed), members

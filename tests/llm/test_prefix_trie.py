"""Conversation prefix trie against a trie built turn by turn in Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pricedex.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, node string"  # the last two clash with names inside
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(5)


def identity(role, text):
    return hashlib.sha256(f"{len(role.encode())} {role}{text}".encode()).hexdigest()[:32]


def conversations_of(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, identity(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        todo = [path]
        while todo:
            p = todo.pop()
            yield p
            todo += children[p]

    out = {}
    for path, who in members.items():
        ends = sorted(c for c in who if len(convs[c]) == len(path))
        sub = list(below(path))
        out[len(path), min(who)] = (
            min(members[path[:-1]]) if path else None, len(who), len(children[path]), sum(not children[p] for p in sub),
            sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in sub if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def rows_of(found):
    rows = [tuple(r) for r in found.select("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                           "saved_tokens", "ends_sha256").collect()]
    out = {r[:2]: r[2:] for r in rows}
    assert len(out) == len(rows)
    return out


def awkward_rows():
    rng = random.Random(5)
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hello there", "a b\tc", "", None, "é à"])))
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(40) for t in range(5)]  # a conversation that many have
    rows += [(5000, t, "user", f"long {t}") for t in range(700)]  # a third of all rows
    rows += [(5001, t, "user", f"long {t}") for t in range(12)]
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (8, 0, "user", "tie"), (8, 0, "assistant", "tie")]
    rows += [(None, 0, "user", "nobody"), (-3, 0, "user", "x" * 50_000), (-3, 1, "user", "same 0")]
    return rows


@pytest.mark.parametrize("block", [1, 3, 8])
def test_trie_of_awkward_conversations(spark, block):
    rows = awkward_rows() if block > 1 else [r for r in awkward_rows() if r[0] not in (5000, 5001) and (r[0] or 0) < 1005 and (r[1] or 0) < 3]
    assert rows_of(prefix_trie.prefix_trie(frame(spark, rows), block)) == brute(conversations_of(rows))


def test_shared_openings_and_conversations_without_turns(spark):
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(0, 90) for t in range(c % 4 + 1) if c not in (20, 60)]
    turns = prefix_trie.positioned_turns(frame(spark, rows))
    expected = brute(rebuilt(conversations_of(rows)))
    assert any(not t for t in rebuilt(conversations_of(rows)).values())
    assert rows_of(prefix_trie.trie(*prefix_trie.with_shared_openings(turns), block_turns=2)) == expected


def test_positions_across_partitions(spark):
    rows = [(1, t, "user", str(t)) for t in range(2000)] + [(0, 0, "user", "a"), (2, 0, "user", "b")]
    found = prefix_trie.positioned_turns(frame(spark, rows).select("conv_id", "turn", "role", "text"))
    positions = [r.position for r in found.where("conv_id = 1").orderBy("position").collect()]
    assert positions == list(range(2000))
    assert found.groupBy("conv_id").count().count() == 3


def test_many_members_that_end_in_one_node(spark):
    ends = spark.range(50_000).select(F.lit(2).cast("long").alias("depth"), F.lit(0).cast("long").alias("node"),
                                      F.col("id").alias("conv_id"))
    found = prefix_trie.end_hashes(ends.repartition(7)).collect()
    assert [r.ends_sha256 for r in found] == [hashlib.sha256(",".join(map(str, range(50_000))).encode()).hexdigest()]


def test_no_conversations(spark):
    found = prefix_trie.prefix_trie(frame(spark, [(None, 0, "user", "x")]))
    assert found.collect() == [] and found.columns == [f.split()[0] for f in prefix_trie.NODE_SCHEMA.split(", ")]
    assert prefix_trie.prefix_trie(frame(spark, []).select("conv_id", "turn", "role", "text")).collect() == []

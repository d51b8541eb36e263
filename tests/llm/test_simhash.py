import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from pricedex.llm import simhash as S
from pricedex.llm.common import connected_components


def slow_fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, bits):
    label = {i: i for i in range(len(ids))}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            a, b = find(i), find(j)
            label[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return {root: min((x for x in g if x is not None), default=None) for root, g in groups.items()}, find


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a b c", "A b\x0bC\x0cd", "Ünï cödé É x y z", "p q r s t u",
                                  "the cat sat on the mat the cat sat on the mat"])
def test_fingerprint(text):
    assert S.fingerprint(text, 4) == slow_fingerprint(text, 4)


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, n // 4, np.uint64)
    out = []
    for k in range(n):
        x = int(base[rng.integers(len(base))])
        for b in rng.choice(64, rng.integers(0, 7), replace=False):
            x ^= 1 << int(b)
        out.append(x)
    return out


@pytest.mark.parametrize("bits,rows,tile", [(4, 512, 16_384), (4, 4, 16_384), (3, 8, 20), (7, 16, 50), (0, 8, 16_384)])
def test_links_give_all_components(spark, monkeypatch, bits, rows, tile):
    monkeypatch.setattr(S, "SHARD_ROWS", rows)
    monkeypatch.setattr(S, "TILE_ROWS", tile)
    fps = sorted(set(clustered(600, bits)))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = S.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), bits)
    found = {r.node: r.component for r in connected_components(links).collect()}
    _, find = brute_components(signed, fps, bits)
    mine, theirs = {}, {}
    for i, x in enumerate(signed):
        mine.setdefault(found.get(x, x), set()).add(x)
        theirs.setdefault(find(i), set()).add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


@pytest.mark.parametrize("radius,depth", [(0, 5), (1, 6), (2, 4), (1, 10)])
def test_tree_loses_no_pair(radius, depth):
    tree = S.VantageTree(10, radius, depth)
    visits = {}
    row, leaf = tree.visits(np.arange(1024))
    for r, x in zip(row.tolist(), leaf.tolist()):
        visits.setdefault(r, set()).add(x)
    assert np.bincount(tree.home, minlength=1 << depth).max() <= 2 * 1024 / (1 << depth)
    for a in range(1024):
        for mask in S._masks(10, radius):
            b = a ^ int(mask)
            low, high = sorted((a, b), key=lambda x: tree.home[x])
            assert tree.home[a] == tree.home[b] or int(tree.home[high]) in visits.get(low, ())


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}}


NASTY = [(5, "same words in both of these texts"), (2, "Same WORDS in both\tof these texts"), (9, None), (8, ""), (7, " \n"),
         (None, "no id at all here"), (None, "no id at all here"), (4, "one of a kind " * 30), (4, "one of a kind " * 30),
         (6, "x " * 30_000)]


def test_components_on_nasty_rows(spark):
    docs = spark.createDataFrame([(a, b, "c", 1) for a, b in NASTY], "doc_id long, text string, component string, low int")
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in S.components(spark, docs).collect()), key=str)
    fps = [slow_fingerprint(t, 4) for _, t in NASTY]
    low, find = brute_components([i for i, _ in NASTY], fps, 4)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    assert got == sorted(((d, signed[i], low[find(i)]) for i, (d, _) in enumerate(NASTY)), key=str)


def test_keep_one_keeps_one_of_each_group(spark):
    docs = spark.createDataFrame([(a, b, "c", 1) for a, b in NASTY], "doc_id long, text string, component string, low int")
    got = S.keep_one(spark, docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted([2, 7, 4, 6, None], key=str)


def test_keep_one_by_row_and_not_by_id(spark):
    rows = [(1, "one text of a few words " * 9), (None, "One text of a few words " * 9), (None, "no id and no copy of it anywhere"),
            (5, "a clean text about the weather"), (5, "quite another one about trains and stations"),
            (6, "Quite another one about trains and stations"), (5, "a clean text about the weather")]
    got = S.keep_one(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([rows[0], rows[2], rows[3], rows[4]], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.components(spark, docs).count() == 0 and S.keep_one(spark, docs).count() == 0


def test_query_against_brute_force(spark):
    from pricedex.llm.queries import QUERIES, read_table

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash_near_dedup"](spark, sf).collect()}
    rows = read_table(spark, sf, "documents", "doc_id", "text").collect()
    fps = [slow_fingerprint(r.text, 4) for r in rows]
    low, find = brute_components([r.doc_id for r in rows], fps, 4)
    assert got == {r.doc_id: (f"{fps[i]:016x}", low[find(i)]) for i, r in enumerate(rows)}


def test_visitors_of_a_small_leaf_are_dealt_to_several_tasks(spark, monkeypatch):
    """Many fingerprints that share one band value visit a leaf of few: no group gets them all, and no link is lost."""
    monkeypatch.setattr(S, "TILE_ROWS", 64)
    monkeypatch.setattr(S, "SHARD_ROWS", 4)
    rng = random.Random(12)
    hot = [0x1234 | rng.getrandbits(48) << 16 for _ in range(1200)]
    near = [f ^ 1 << rng.randrange(16) for f in hot[::40]] + [f ^ 0b1011 << 20 for f in hot[::60]]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in hot + near})
    distinct = spark.createDataFrame([(v,) for v in values], "fp long").repartition(4)
    tree = S.VantageTree(16, 1, 9)
    fps = np.array(values, np.int64).view(np.uint64)
    leaf = int(tree.home[0x1234])
    guests = sum(len(part) for band, one, _, _, kind, part in S._deal(fps, tree, 4, {}) if kind == 2 and band == 0)
    assert guests > 640 and leaf >= 0
    hot_leaves = {(0, one): (2, 5) for one in range(tree.leaves)}
    largest = max(len(part) for band, one, a, b, kind, part in S._deal(fps, tree, 4, hot_leaves) if kind == 2 and band == 0)
    assert largest < guests / 2
    links = S.near_links(distinct, 4).collect()
    label = {v: v for v in values}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for r in links:
        label[find(r.u)] = find(r.v)
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                assert find(a) == find(b)
    assert all(((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 4 for r in links) or len(links) < len(values)

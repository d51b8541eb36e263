import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from pricedex.llm import line_dedup as D


def tokens(line):
    return [t.decode() for t in D.tokens(line.encode())]


def hashed(line):
    value = xxhash.xxh64_intdigest(line.encode())
    return value - (1 << 64) if value >> 63 else value


def templates(found):
    """Line -> the first line of its template, for the lines of one leaf, by the definition: every pair is compared."""
    found = sorted(found, key=hashed)
    ids, by_length, up = {}, defaultdict(list), list(range(len(found)))
    for i, line in enumerate(found):
        by_length[line.count(" ") + 1].append(i)

    def root(i):
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for n, at in by_length.items():
        columns = np.array([[ids.setdefault(t, len(ids)) for t in found[i].split(" ")] for i in at], np.int32).T.copy()
        for i in range(len(at) if n > D.DEPTH else 0):
            agree = sum((c[i + 1:] == c[i]).astype(np.int32) for c in columns)
            for j in np.flatnonzero(agree >= D.SIMILARITY * n - 1e-9).tolist():
                a, b = sorted((root(at[i]), root(at[i + 1 + j])))
                up[b] = a
    return {line: found[root(i)] for i, line in enumerate(found)}


def brute(rows):
    """The documents' texts after line dedup, by plain loops over the definition."""
    lines = defaultdict(set)  # leaf -> distinct lines
    for _, text in rows:
        for line in (text or "").split("\n"):
            if t := tokens(line):
                lines[len(t), tuple(t[:D.DEPTH])].add(" ".join(t))
    template = {(leaf, line): (leaf, first) for leaf, found in lines.items() for line, first in templates(found).items()}

    def of(line):
        t = tokens(line)
        return template[(len(t), tuple(t[:D.DEPTH])), " ".join(t)] if t else None

    texts = defaultdict(dict)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if (t := of(line)) is not None:
                key = (doc_id is None, doc_id or 0)
                texts[t][text] = min(texts[t].get(text, key), key)
    keepers = {t: min(found.items(), key=lambda kv: kv[1])[0] for t, found in texts.items()}
    out = []
    for doc_id, text in rows:
        kept, cut = [], 0
        for line in (text or "").split("\n"):
            t = of(line)
            if t and len(texts[t]) >= D.MIN_DOCS and keepers[t] != text:
                cut += 1
            else:
                kept.append(line)
        out.append((doc_id, text if not cut else "\n".join(kept), cut))
    return sorted(out, key=str)


LONG = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
ROWS = [(i, f"Own line of document {'abcdefghijkl'[i]} {'mnopqrstuvwx'[i]}\nPosted by the user {i} on a Monday\nshort one\n\n"
            f"all rights reserved by the company named here") for i in range(12)]
ROWS += [(20, "start of a text\n" + LONG), (21, LONG + "\nend of another text"), (22, "only in two texts you see"),
         (23, "x\nonly in two texts you see"), (24, None), (25, ""), (25, ""), (None, "all rights reserved by the company named here"),
         (26, "copied text with several words in it\nand a second line of it"), (27, "copied text with several words in it\nand a second line of it"),
         (28, "copied text with several words in it\nand a second line of it"), (30, "the rain in spain falls mainly on plains today"),
         (31, "the rain in spain falls mainly on hills today\nz"), (32, "the rain in spain falls mainly on roofs today\ny"),
         (33, "word " * 50_000), (3, ROWS[3][1])]


def run(spark, rows):
    docs = spark.createDataFrame([(a, b, 1, "t", len(b or "")) for a, b in rows],
                                 "doc_id long, text string, leaf int, template string, n_chars long")
    got = D.drop_lines(spark, docs, removed_col="cut", length_col="n_chars")
    assert got.columns == [*docs.columns, "cut"]
    rows = got.collect()
    assert all(r.n_chars == len(r.text or "") for r in rows)
    return sorted(((r.doc_id, r.text, r.cut) for r in rows), key=str)


def test_against_brute_force(spark):
    got = run(spark, ROWS)
    assert got == brute(ROWS)
    by = {r[0]: r for r in got}
    assert by[0][2] == 0 and by[1][2] == 3  # the first text keeps the lines, the others lose them, short ones too
    assert by[21][1] == "end of another text" and by[20][2] == 0
    assert by[22][2] == 0 and by[23][1] == "x" and by[26][2] == by[28][2] == 0  # copies of one text are no template
    assert by[24][1] is None and by[33][2] == 0


def test_variable_fields_become_templates():
    lines = ["Posted by anna on a Monday", "Posted by bert on a Monday", "Posted by anna in my house"]
    found = templates(lines)
    assert found[lines[0]] == found[lines[1]] != found[lines[2]]
    assert tokens("call 555 now a1") == ["call", "<*>", "now", "<*>"]


@pytest.mark.parametrize("n", [1, 4, 5, 6, 9, 10, 25, 60, 500])
def test_lines_that_agree_enough_share_a_block(n):
    bounds, rng = D.block_bounds(n, 0.8), random.Random(n)
    differ = n - D.needed(n, 0.8)
    assert D.needed(n, 0.8) >= 0.8 * n - 1e-6 > D.needed(n, 0.8) - 1
    for _ in range(50):
        off = set(rng.sample(range(D.DEPTH, n), min(differ, n - D.DEPTH))) if n > D.DEPTH else set()
        assert any(not off & set(range(a, b)) for a, b in bounds)
    assert bounds[-1][1] == n and all(a <= b for a, b in bounds)


def test_a_leaf_of_many_lines_that_do_not_merge(spark):
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrstvz"]
    filed = sorted({f"Filed under the category {rng.choice(words)} {rng.choice(words)} and {rng.choice(words)} here" for _ in range(30_000)})
    rows = [(i, f"{line}\nown words of {i}") for i, line in enumerate(filed)] + [(99_999, filed[5]), (99_998, filed[7] + " ")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert 0 < sum(r[2] > 0 for r in got)


def test_lines_that_agree_but_not_with_the_first_of_their_block(spark):
    pair = [f"sold in the town {who} green and blue here" for who in ("ann", "bob")]
    first = next(x for x in (f"sold in the town w{chr(97 + i % 26)} x{chr(97 + i // 26)} and blue here" for i in range(676))
                 if hashed(x) < min(map(hashed, pair)))
    chain = sorted((f"kept by the sea {a} {b} and {c} here" for a, b, c in ["one two red".split(), "one two tan".split(), "six two tan".split()]),
                   key=hashed)
    rows = [(1, first), (2, pair[0]), (3, pair[1] + "\nown"), (4, chain[0]), (5, chain[1]), (6, chain[2])]
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[0]: r[2] for r in got} == {1: 0, 2: 0, 3: 1, 4: 0, 5: 1, 6: 1}


def test_large_leaves_in_blocks_and_tiles(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "bdfgklmn" for b in "aeiou"]

    def line(n, vary):
        return " ".join(["in", "all", "of", "it", *(rng.choice(words) if i in vary else f"c{'xyz'[i % 3]}" for i in range(4, n))])

    lines = {line(n, set(vary)) for n, vary in [(6, [4, 5]), (9, [4, 5]), (9, [4, 6, 8]), (12, range(5, 11)), (26, range(4, 13))] for _ in range(150)}
    lines = sorted(lines | {line(5, {4}) for _ in range(30)})
    rows = list(enumerate(lines))
    want = brute(rows)
    assert 100 < sum(r[2] for r in want) < len(rows)
    for few, small, tile in [(16, 2048, 1 << 14), (2, 20, 1 << 14), (2, 20, 7)]:
        monkeypatch.setattr(D, "FEW_LINES", few)
        monkeypatch.setattr(D, "SMALL_LINES", small)
        monkeypatch.setattr(D, "TILE_LINES", tile)
        assert run(spark, rows) == want


def test_blocks_of_about_equal_weight():
    bounds = D.block_bounds(100, 0.8)
    for heavy in ({*range(4, 34)}, {*range(10, 100, 4)}, set()):
        order = D._order([float(p in heavy) for p in range(100)], bounds)
        assert sorted(order) == list(range(100)) and order[: D.DEPTH] == list(range(D.DEPTH))
        assert not heavy or min(len(heavy & set(order[a:b])) for a, b in bounds) >= 1
    assert D._order([0.0] * 5, D.block_bounds(5, 0.8)) == list(range(5))


def test_empty_table(spark):
    assert D.drop_lines(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark):
    from pricedex.llm.queries import QUERIES, read_table

    sf = "/root/testdata/sf0.001"
    got = sorted(((r.doc_id, r.text, r.lines_cut) for r in QUERIES["op8_line_dedup"](spark, sf).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in read_table(spark, sf, "documents").collect()])

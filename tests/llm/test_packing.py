import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from pricedex.llm import packing as P
from pricedex.llm.queries import tokenizer_path
from pricedex.llm.tokens import Encoder


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids + [2]


TEXTS = ["", "a", " ", "\n", "One two, three.\nFour  five", " lead", "trail ", "tab\there", "don't we'll I'm 'tis", "x\n\ny", "a \nb", "a\n b",
         "Zürich öäü ß éàç 日本語 テスト 💥👩‍👩‍👧", "1234 56,78 $9.99 (x) [y] {z}", "<|endoftext|> in text", "nbsp here", " sep",
         "\x00nul \x1c fs", "é combining", "UPPER lower MiXed", "word " * 3000, "supercalifragilistic" * 40, "a|b <c> <|d"]


def test_encoder_equals_the_tokenizer(plain):
    rng = random.Random(1)
    parts = ["the", "cat", "'s", "don't", "ü", "日本", "42", "...", "!?", " ", "\n", "  ", "\t", "-", "_x", "💥", " ", "é", "\r\n"]
    texts = TEXTS + ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    got = Encoder(tokenizer_path()).encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("seed,size", [(0, 16), (1, 64), (2, 1024), (3, 1024)])
def test_plan_uses_every_piece_once_and_fills_bins(seed, size):
    rng = np.random.default_rng(seed)
    n = 30_000 if seed == 3 else 2000
    lengths = np.minimum(size, 1 + rng.gamma(2, size / 5, n).astype(int))
    histogram = Counter(lengths.tolist())
    bins = P.plan(dict(histogram), size)
    used = Counter()
    for content, many in bins:
        assert many > 0 and 0 < sum(a * t for a, t in content) <= size
        for a, t in content:
            used[a] += t * many
    assert used == histogram
    least = -(-int(lengths.sum()) // size)
    assert sum(m for _, m in bins) <= least * 1.02 + 2 + (lengths * 2 > size).sum() * (size == 16)


def test_plan_of_odd_histograms():
    assert P.plan({}, 8) == [] and len(P.intervals([])) == 0
    assert sum(m for _, m in P.plan({1: 17}, 8)) == 3
    assert sum(m for _, m in P.plan({8: 5, 5: 3, 3: 3}, 8)) == 8


def check(rows, docs, plain, size):
    want = {}
    for doc_id, text in docs:
        want.setdefault(doc_id, []).append(ids_of(plain, text))
    spaces = {}
    for r in rows:
        assert 1 <= r.length <= size
        spaces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in spaces.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= size
    pieces = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    expected = Counter()
    for doc_id, all_ids in want.items():
        for ids in all_ids:
            first = (len(ids) - 1) % size + 1
            cuts = [0, *range(first, len(ids) + 1, size)]
            for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
                expected[doc_id, k, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())] += 1
    assert pieces == expected
    return len(spaces), sum(r.length for r in rows)


@pytest.mark.parametrize("size,bucket", [(1024, 100_000), (32, 5)])
def test_pack(spark, plain, monkeypatch, size, bucket):
    monkeypatch.setattr(P, "BUCKET_ROWS", bucket)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (7, "repeated id"), (7, "repeated id"), (50, None)]
    docs += [(100 + i, "same text in many rows") for i in range(200)]
    frame = spark.createDataFrame([(a, b, 1, 2) for a, b in docs], "doc_id long, text string, length int, offset int")
    rows = P.pack(spark, frame, tokenizer_path(), size).collect()
    n, total = check(rows, docs, plain, size)
    assert n <= -(-total // size) * 1.1 + 1


def test_sequences_hold_the_ids(spark, plain):
    docs = [(1, "one two three"), (2, "four"), (3, "five six " * 900), (4, None)]
    packed = P.pack(spark, spark.createDataFrame(docs, "doc_id long, text string"), tokenizer_path(), with_ids=True)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in P.sequences(packed).collect()}
    text = dict(docs)
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == ids_of(plain, text[r.doc_id])[r.start:r.start + r.length]


def test_empty_table(spark):
    assert P.pack(spark, spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0


def test_query(spark, plain):
    from pricedex.llm.queries import QUERIES, read_table

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in read_table(spark, sf, "documents").collect()]
    n, total = check(QUERIES["op10_best_fit_packing"](spark, sf).collect(), docs, plain, 1024)
    assert n <= -(-total // 1024) * 1.02 + 1

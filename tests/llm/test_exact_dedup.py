import hashlib
from collections import defaultdict

import numpy as np
import pytest

from pricedex.llm import exact_dedup as X


def brute(rows):
    """(doc_id, keep_id, size, sha) per row, and the number of kept rows per text."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=str), len(groups)


@pytest.mark.parametrize("below", [None, -5, 4, 10_000])
def test_matches_brute_force_for_any_history(spark, below):
    rows = [(i, f"text {i % 7}") for i in range(40)] + [(100, ""), (101, None), (None, ""), (None, "alone"), (3, "text 3"),
                                                       (3, "text 3"), (50, "Ünï 💥"), (51, "x" * 300_000)]
    docs = spark.createDataFrame([(a, b, "s", 1) for a, b in rows], "doc_id long, text string, digest string, uid int")
    got = X.exact_dedup(spark, docs, history_below=below).collect()
    want, groups = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == groups  # one row of each text, repeated rows included


def test_empty_table(spark):
    assert X.exact_dedup(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 256, (n, 32), np.uint8)
    sizes, flags, slot = X.build_hash(keys)
    assert sorted(slot.tolist()) == list(range(n))
    assert (X.lookup_hash(keys, sizes, flags) == slot).all()


def test_lookup_of_strangers_needs_the_digest_check():
    rng = np.random.default_rng(1)
    keys, strangers = rng.integers(0, 256, (500, 32), np.uint8), rng.integers(0, 256, (500, 32), np.uint8)
    sizes, flags, _ = X.build_hash(keys)
    assert (X.lookup_hash(strangers, sizes, flags) >= 0).any()

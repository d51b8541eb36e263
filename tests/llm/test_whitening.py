"""Embedding whitening against exact integer sums and numpy's decomposition of the centred rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from pricedex.llm import whitening
from pricedex.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x string"


def run(spark, rows, **options):
    return whitening.whiten(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3), **options).collect()


def brute(rows, components=4):
    usable = [(i, [math.floor(256.0 * float(np.float32(c))) for c in v]) for i, v in rows
              if v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in usable})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    whole = [s // n for s in sums]
    centred = np.array([[a - w for a, w in zip(x, whole)] for x in distinct], float) - [(s % n) / n for s in sums]
    _, sv, vt = np.linalg.svd(centred, full_matrices=False)
    keep = min(components, int((sv > sv[0] * 1e-12).sum())) if sv.size and sv[0] > 0 else 0
    out = {}
    for i, x in usable:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        c = np.array([a - w for a, w in zip(x, whole)], float) - [(s % n) / n for s in sums]
        for k in range(keep):
            out.setdefault((i, k + 1), []).append((n, deviation, float(c @ vt[k] / (sv[k] / math.sqrt(n))),
                                                   float(sv[k] ** 2 / (sv ** 2).sum())))
    return out


def check(found, expected, tolerance=1e-9):
    assert len(found) == sum(map(len, expected.values()))
    sign = {}
    for r in found:
        n, deviation, whitened, explained = expected[r.vec_id, r.component][0]
        assert (r.n, int(r.deviation)) == (n, deviation)
        assert abs(r.explained / explained - 1) < 1e-6 and r.identity_error < 1e-8
        if abs(whitened) > 1e-6:
            s = sign.setdefault(r.component, np.sign(whitened * r.whitened))
            assert abs(s * r.whitened - whitened) < tolerance * max(1, abs(whitened))


def test_random_vectors_with_repeats_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # a vector that most rows have
    rows += [(None, rows[5][1])]
    bad = [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6),
           (2004, []), (2005, [1.0, 2.0])]
    check(run(spark, rows + bad), brute(rows))


@pytest.mark.parametrize("kind", ["offset", "scales", "nearly dependent", "dependent", "flat", "line", "two rows"])
def test_awkward_spectra(spark, kind):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(120, 5)) * 40
    if kind == "offset":
        a = a / 40 + 30_000
    elif kind == "scales":
        a = a * [1e6, 1e3, 1, 0.05, 0.02]
    elif kind == "nearly dependent":
        a[:, 1:] = a[:, :1] * 5000 + rng.normal(size=(120, 4)) * 0.05
    elif kind == "dependent":
        a[:, 2:] = np.round(a[:, :1]) * [1, 2, 3]
        a[:, 1] = np.round(a[:, 0])
    elif kind == "flat":
        a[:, 3] = 7
    elif kind == "line":
        a = np.round(a[:, :1]) * [1, -2, 4, 8, 16]
    else:
        a = a[:2]
    rows = [(i, v) for i, v in enumerate(a.astype(np.float32).tolist())]
    expected = brute(rows)
    check(run(spark, rows), expected, 1e-7)
    if kind == "line":
        assert max(k for _, k in expected) == 1


def test_no_variance_and_no_rows(spark):
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert run(spark, []) == [] == run(spark, [(1, None)])


def test_deviation_beyond_a_long_is_exact(spark):
    rows = [(i, [float(2 ** 40 * (i + 1)), float(i * i)]) for i in range(50)]
    found = run(spark, rows)
    for r in found:
        assert int(r.deviation) == brute(rows)[r.vec_id, r.component][0][1]


def test_query_on_the_given_table(spark):
    sf_small = "/root/testdata/sf0.001"
    found = QUERIES["op11_embedding_whitening"](spark, sf_small)
    assert dict(found.dtypes)["deviation"] == "bigint"
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    check(found.collect(), brute([(r.vec_id, r.embedding) for r in table]), 1e-8)

"""Queries without a SQL oracle, checked against a brute-force pandas computation on the same rows (sf0.001);
and a hot key holding a third of all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricedex.operators import forecast as FC
from pricedex.operators import normalise as N
from pricedex.plans import registry_forecast as RF


@pytest.fixture(scope="module")
def forecast_rows(spark):
    return RF._fc_all(spark, SF_SMALL)


def test_metrics_match_bruteforce(spark, forecast_rows):
    ev = forecast_rows.where(F.col("kind") == "eval").toPandas()
    got = FC.metrics(forecast_rows).toPandas().set_index(["area", "category", "model"])
    assert len(got) == ev.groupby(["area", "category", "model"]).ngroups > 0
    for (area, cat, model), g in ev.groupby(["area", "category", "model"]):
        err = g["y"].to_numpy() - g["yhat"].to_numpy()
        denom = np.where(g["y"].to_numpy() != 0, g["y"].to_numpy(), 1.0)
        r = got.loc[(area, cat, model)]
        assert r["mae"] == pytest.approx(np.mean(np.abs(err)), abs=1e-4)
        assert r["rmse"] == pytest.approx(np.sqrt(np.mean(err ** 2)), abs=1e-4)
        assert r["mape_pct"] == pytest.approx(np.mean(np.abs(err / denom)) * 100, abs=1e-2)
        assert r["n_eval"] == len(g)


def test_benchmark_ranks_match_bruteforce(spark, forecast_rows):
    b = FC.benchmark(forecast_rows).toPandas()
    for _, g in b.groupby(["source", "area", "category"]):
        expected = g.sort_values(["mae", "model"])["model"].tolist()
        assert g.sort_values("rank")["model"].tolist() == expected


def test_quality_summary_matches_bruteforce(spark, forecast_rows):
    m = FC.metrics(forecast_rows.where(F.col("model") == "additive"))
    pdf = m.toPandas()
    s = FC.quality_summary(m).first()
    assert s.median_mae == pytest.approx(float(np.median(pdf["mae"])))
    assert s.best_mae == pdf["mae"].min() and s.worst_mae == pdf["mae"].max() and s.n_series == len(pdf)


def test_first_wins_with_a_hot_key(spark):
    rng = np.random.default_rng(7)
    n = 3000
    keys = np.where(np.arange(n) % 3 == 0, "hot", np.array([f"k{i % 97}" for i in range(n)]))
    pdf = pd.DataFrame({"k": keys, "v": rng.integers(0, 10_000, n), "w": rng.integers(0, 5, n)})
    df = spark.createDataFrame(pdf).repartition(8)
    got = {r.k: (r.v, r.w) for r in N.first_wins(df, ["k"], ["v", "w"]).collect()}
    expected = pdf.sort_values(["v", "w"]).groupby("k").first()
    assert got == {k: (int(r.v), int(r.w)) for k, r in expected.iterrows()}

"""Forecasting: known answers on synthetic series and invariants (lower <= yhat <= upper, trend + yearly = yhat,
RMSE >= MAE)."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricedex.operators import forecast as FC
from pricedex.operators import impact as IM
from pricedex.operators import additive, least_squares, monthly

from brute_forecast import Additive, Arima212, HoltWinters


def months(n, start=(2019, 1)):
    y, m = start
    out = []
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def synthetic(n=72, slope=0.3, amp=2.0, level=100.0, noise=0.0, seed=0):
    rng = np.random.default_rng(seed)
    ds = months(n)
    y = [level + slope * i + amp * math.sin(2 * math.pi * (d.month - 1) / 12) + noise * rng.standard_normal()
         for i, d in enumerate(ds)]
    return ds, y


def series_df(spark, groups):
    rows = []
    for (area, cat), (ds, y) in groups.items():
        rows += [("S", area, cat, d, float(v)) for d, v in zip(ds, y)]
    return spark.createDataFrame(rows, "source string, area string, category string, ds date, y double")


def noisy_groups(n=14, seed=3):
    """Series of several lengths, some with gaps, rounded to four decimals."""
    rng = np.random.default_rng(seed)
    out = {}
    for g in range(n):
        ds, y = synthetic(30 + 5 * g, slope=0.1 * g - 0.4, amp=g, noise=0.2 * (g + 1), seed=g, level=50.0 + 10 * g)
        keep = [i for i in range(len(ds)) if i in (0, len(ds) - 1) or rng.random() > 0.1 * (g % 3)]
        out[f"A{g}", "c"] = [ds[i] for i in keep], [round(y[i], 4) for i in keep]
    return out


def fitted_rows(spark, groups, model, cutoff="2021-06-01"):
    out = {}
    for r in FC.forecast(series_df(spark, groups), cutoff=cutoff, horizon=12, models=(model,)).collect():
        out.setdefault((r.area, r.category, r.kind), []).append(r)
    return {k: sorted(v, key=lambda r: r.ds) for k, v in out.items()}


def brute_rows(groups, cls, cutoff="2021-06-01"):
    """(area, category, kind, model fitted on what that kind may see)."""
    cut = dt.date.fromisoformat(cutoff)
    for (area, cat), (ds, y) in groups.items():
        for kind, last in (("eval", cut), ("future", None), ("fitted", None)):
            seen = [(d, v) for d, v in zip(ds, y) if last is None or d < last]
            yield area, cat, kind, cls().fit(np.array([d for d, _ in seen], "datetime64[D]"), np.array([v for _, v in seen]))


def days(rows):
    return np.array([r.ds for r in rows], "datetime64[D]")


def test_additive_equals_a_library_solver(spark):
    groups = noisy_groups()
    found = fitted_rows(spark, groups, "additive")
    for area, cat, kind, model in brute_rows(groups, Additive):
        rows = found.get((area, cat, kind), [])
        assert rows or kind == "eval"
        if rows:
            trend, yearly = model.predict(days(rows))
            assert np.allclose([r.yhat for r in rows], trend + yearly, rtol=0, atol=2e-4)
            if kind != "eval":
                assert np.allclose([r.trend for r in rows], trend, rtol=0, atol=2e-4)


def test_holt_winters_equals_a_loop(spark):
    groups = noisy_groups()
    found = fitted_rows(spark, groups, "holt_winters")
    for area, cat, kind, model in brute_rows(groups, HoltWinters):
        rows = found.get((area, cat, kind), [])
        if rows and kind != "fitted":
            assert np.allclose([r.yhat for r in rows], model.predict(days(rows)), rtol=0, atol=2e-3)
            assert np.allclose([r.yhat_upper - r.yhat for r in rows], model.band(days(rows)), rtol=0, atol=2e-3)


def test_arima_equals_library_least_squares_where_invertible(spark):
    groups = noisy_groups()
    series = series_df(spark, groups)
    obs, _ = FC.observations(series, "2021-06-01")
    kinds = {(r.area, r.fit): r for r in FC.monthly_fits(obs, "arima_2_1_2").collect()}
    found = fitted_rows(spark, groups, "arima_2_1_2")
    seen = set()
    for area, cat, kind, model in brute_rows(groups, Arima212):
        rows = found.get((area, cat, kind), [])
        if not rows or kind == "fitted":
            continue
        fit = kinds[area, "eval" if kind == "eval" else "prod"]
        seen.add(fit.kind)
        if model.coef is None:
            assert fit.kind == "drift"
            assert np.allclose([r.yhat for r in rows], model.predict(days(rows)), atol=1e-3)
            continue
        _, p1, p2, t1, t2 = model.coef
        invertible = all(abs(z) > 1 for z in np.roots([t2, t1, 1.0]))
        assert (fit.kind == "ar") <= (not invertible) and (fit.kind == "arima") <= invertible
        if fit.kind == "arima":
            assert all(abs(z) > 1 for z in np.roots([-p2, -p1, 1.0]))
            assert np.allclose(fit.coef[1:], model.coef[1:], atol=1e-3)
            assert np.allclose([r.yhat for r in rows], model.predict(days(rows)), atol=2e-2)
    assert seen >= {"arima"}


def test_arima_falls_back(spark):
    rng = np.random.default_rng(0)
    explosive = [100.0]
    for _ in range(40):
        explosive.append(round(explosive[-1] * 1.2, 4))
    spikes = [100 + (50.0 if i % 7 == 0 else 0.0) + float(rng.normal()) for i in range(60)]
    groups = {("flat", "c"): (months(40), [100.0] * 40), ("short", "c"): (months(10), [float(i) for i in range(10)]),
              ("explosive", "c"): (months(41), explosive), ("spikes", "c"): (months(60), [round(v, 4) for v in spikes])}
    obs, _ = FC.observations(series_df(spark, groups), "2030-01-01")
    kinds = {r.area: r for r in FC.monthly_fits(obs, "arima_2_1_2").collect()}
    assert kinds["short"].kind == "drift" and kinds["short"].coef is None and kinds["short"].drift == 10_000.0
    assert kinds["explosive"].kind == "drift"
    found = fitted_rows(spark, groups, "arima_2_1_2", "2030-01-01")
    assert [round(r.yhat, 6) for r in found["short", "c", "future"]] == [float(i) for i in range(10, 22)]
    assert all(r.yhat == 100.0 for r in found["flat", "c", "future"])
    assert all(abs(r.yhat) < 1e4 for r in found["spikes", "c", "future"])
    assert all(math.isfinite(r.yhat) for v in found.values() for r in v)


def test_monthly_grid_fills_gaps_on_the_line(spark):
    ds = [dt.date(2020, 1, 1), dt.date(2020, 1, 15), dt.date(2020, 4, 1), dt.date(2020, 6, 1)]
    rows = spark.createDataFrame([("k", d, q) for d, q in zip(ds, [5, 10, 3, 4])], "k string, ds date, q long")
    r = monthly.monthly(rows, ["k"]).first()
    assert list(r.qs) == [10, 8, 5, 3, 4, 4] and r.n == 6 and r.last == 2020 * 12 + 5  # 7.67, 5.33; 3.5 away from zero


def test_least_squares_equals_numpy(spark):
    rng = np.random.default_rng(1)
    rows, expected = [], {}
    for g in range(5):
        p = 2 + g
        x, y = rng.integers(-50, 50, (40, p)), rng.integers(-999, 999, 40)
        rows += [(g, [int(v) for v in [*a, b]]) for a, b in zip(x, y)]
        expected[g] = np.linalg.solve(x.T @ x / 100.0 + 0.5 * np.eye(p), x.T @ y / 30.0)
    table = spark.createDataFrame(rows, "series long, z array<long>").repartition(4)
    settings = spark.createDataFrame([(g, [10.0] * (2 + g) + [3.0], [0.5] * (2 + g)) for g in range(5)],
                                     "series long, scale array<double>, ridge array<double>")
    for r in least_squares.solve(table, settings, ["series"]).collect():
        assert np.allclose(r.beta, expected[r.series], rtol=1e-9)


def test_interval_covers_what_it_says_and_is_reproducible(spark):
    groups = {(f"A{i}", "c"): synthetic(72, slope=0.2, noise=1.0, seed=100 + i) for i in range(40)}
    found = fitted_rows(spark, groups, "additive", cutoff="2024-01-01")
    held_out = [r for (_, _, kind), rows in found.items() if kind == "eval" for r in rows]
    inside = sum(r.yhat_lower <= r.y <= r.yhat_upper for r in held_out) / len(held_out)
    assert len(held_out) == 40 * 12 and 0.7 < inside < 0.93, inside
    again = fitted_rows(spark, groups, "additive", cutoff="2024-01-01")
    assert again == found
    future = found["A0", "c", "future"]
    assert future[-1].yhat_upper - future[-1].yhat_lower > 2 * additive.Z80 * 0.5


@pytest.mark.parametrize("name", FC.MODELS)
def test_models_recover_trend_and_season(spark, name):
    ds, y = synthetic()
    rows = fitted_rows(spark, {("A", "c"): (ds, [round(v, 4) for v in y])}, name, "2024-01-01")["A", "c", "eval"]
    assert np.mean([abs(r.yhat - r.y) for r in rows]) < 1.0


def test_metrics_known_values(spark):
    rows = [("S", "a", "c", "additive", "eval", dt.date(2024, i + 1, 1), float(v), float(v), 0.0, 0.0, None, None, 4)
            for i, v in enumerate([100, 101, 102, 103])]
    rows += [("S", "b", "c", "additive", "eval", dt.date(2024, 1, 1), 100.0, 102.0, 0.0, 0.0, None, None, 2),
             ("S", "b", "c", "additive", "eval", dt.date(2024, 2, 1), 100.0, 98.0, 0.0, 0.0, None, None, 2)]
    fc = spark.createDataFrame(rows, FC.FORECAST_SCHEMA)
    m = {r.area: r for r in FC.metrics(fc).collect()}
    assert (m["a"].mae, m["a"].rmse, m["a"].mape_pct) == (0.0, 0.0, 0.0)
    assert m["b"].mae == pytest.approx(2.0) and m["b"].mape_pct == pytest.approx(2.0)
    assert m["b"].rmse >= m["b"].mae and m["b"].n_eval == 2


def test_forecast_job_invariants(spark):
    groups = {("A", "c1"): synthetic(72, seed=1, noise=0.3), ("B", "c2"): synthetic(72, slope=-0.2, seed=2, noise=0.3),
              ("C", "c3"): (months(40), [100.0] * 40)}
    s = series_df(spark, groups)
    fc = FC.forecast(s, cutoff="2024-01-01", horizon=12, models=("additive", "holt_winters", "arima_2_1_2"))
    rows = fc.collect()
    assert {r.kind for r in rows} == {"eval", "fitted", "future"}
    for r in rows:
        assert r.yhat_lower <= r.yhat <= r.yhat_upper
        if r.kind in ("fitted", "future") and r.model == "additive":
            assert r.trend + r.yearly == pytest.approx(r.yhat, abs=1e-9)
    fut = [r for r in rows if r.kind == "future" and r.model == "additive"]
    assert len(fut) == 3 * 12
    last = {("A", "c1"): dt.date(2024, 12, 1), ("C", "c3"): dt.date(2022, 4, 1)}
    for k, d in last.items():
        got = sorted(r.ds for r in fut if (r.area, r.category) == k)
        assert got[0] == (dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1))
    m = FC.metrics(fc).collect()
    assert all(r.rmse >= r.mae for r in m)
    assert {r.n_train for r in m if r.area == "A"} == {60}
    constant = [r for r in m if r.area == "C"]
    assert not constant  # no eval rows: the constant series ends before the cutoff
    b = FC.benchmark(fc).where(F.col("area") == "A").orderBy("rank").collect()
    assert [r["rank"] for r in b] == [1, 2, 3] and b[0].mae <= b[1].mae <= b[2].mae


def test_horizon_validation(spark):
    s = series_df(spark, {("A", "c"): synthetic(24)})
    with pytest.raises(ValueError):
        FC.future_frame(s, 0)
    with pytest.raises(ValueError):
        FC.future_frame(s, 37)
    assert FC.future_frame(s, 36).count() == 36


def test_category_resolution(spark):
    cats = spark.createDataFrame([("00 - Ensemble",), ("01 - Alimentation",), ("02 - Boissons",)], "category string")
    names = ["00 - Ensemble", "01", "0", "zz"]
    got = {r["query"]: (r.status, r.category) for r in FC.resolve_categories(cats, names).collect()}
    assert got == {"00 - Ensemble": ("exact", "00 - Ensemble"), "01": ("prefix", "01 - Alimentation"),
                   "0": ("ambiguous", None), "zz": ("not_found", None)}


def test_budget_simulation(spark):
    s = series_df(spark, {("A", "c"): (months(3), [100.0, 100.0, 100.0])})
    fc = spark.createDataFrame(
        [("S", "A", "c", "additive", "future", dt.date(2019, 4 + i, 1), None, 100.0 + 2.5 * (i + 1), 99.0 + 2.5 * i,
          106.0 + 2.5 * i, None, None, 3) for i in range(3)], FC.FORECAST_SCHEMA)
    r = IM.budget_simulation(s, fc, amount=1000.0, horizon=2).collect()[0]
    assert r.future_budget == 1050.0 and r.delta == 50.0
    assert r.monthly_impact == 50.0 and r.cumulative_impact == 100.0
    assert r.future_budget_min <= r.future_budget <= r.future_budget_max
    # half-even rounding, as Python's round()
    r2 = IM.budget_simulation(s, fc, amount=100.0, horizon=1).collect()[0]
    assert r2.future_budget == 102.0  # 102.5 -> 102


def test_worst_series_tie_goes_to_the_smallest_key(spark):
    m = spark.createDataFrame([("A", "c", 2.0, 1.0), ("A", "b", 2.0, 1.0), ("A", "a", 1.0, 1.0)],
                              "area string, category string, mae double, mape_pct double")
    r = FC.quality_summary(m).first()
    assert r.worst_series == "A / b" and r.best_series == "A / a"


def test_seasonal_naive_is_honest(spark):
    ds, y = synthetic(72)
    fc = FC.seasonal_naive(series_df(spark, {("A", "c"): (ds, y), ("B", "short"): (ds[:5], y[:5])}), cutoff="2023-07-01")
    rows = {(r.area, r.ds): r for r in fc.collect()}
    value = dict(zip(ds, y))
    assert {(k[1].month, r.kind) for k, r in rows.items() if k[0] == "B"} == {(m, "future") for m in range(1, 6)}
    rows = {k: r for k, r in rows.items() if k[0] == "A"}
    for (_, d), r in rows.items():
        assert r.yhat == pytest.approx(value[d.replace(year=d.year - 1)]) and r.yhat_lower <= r.yhat <= r.yhat_upper
        assert r.kind == ("future" if d > ds[-1] else "eval") and r.n_train == 54
    assert max(d for _, d in rows if rows["A", d].kind == "eval") == dt.date(2024, 6, 1)  # later ones would see held-out months

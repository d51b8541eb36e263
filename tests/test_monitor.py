"""Monitoring: histogram quantiles, alert runs, absences, and stream = batch."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pricedex.streaming import monitor as M
from pricedex.streaming import runner as RN

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def log_df(spark, rows):
    return spark.createDataFrame(rows, RN.REQUEST_LOG_SCHEMA)


def test_histogram_quantile_interpolates(spark):
    bounds = [0.1, 0.5, 1.0]
    df = spark.createDataFrame([(2, 6, 10, 10), (0, 0, 0, 4)], "c0 long, c1 long, c2 long, n long")
    cols = [F.col("c0"), F.col("c1"), F.col("c2")]
    got = [r[0] for r in df.select(M.histogram_quantile(0.5, cols, F.col("n"), bounds)).collect()]
    # rank 5 falls in (0.1, 0.5]: 0.1 + 0.4 * (5 - 2) / (6 - 2); second row: all above the last bound
    assert abs(got[0] - (0.1 + 0.4 * 3 / 4)) < 1e-12 and got[1] == 1.0


def test_error_classes_and_labels(spark):
    rows = [(T0, "GET", "/api/inflation/top", 500, 0.2, None), (T0, "GET", "/api/predict/01", 404, 0.2, "01"),
            (T0, "GET", "/health", 404, 0.1, None), (T0, "GET", "/api/x", 422, 0.1, None),
            (T0, "GET", "/api/x", 403, 0.1, None), (T0, "GET", "/api/x", 200, 0.1, None)]
    out = M.enrich(log_df(spark, rows)).select("endpoint", "error_type", "api").collect()
    assert [r.error_type for r in out] == ["server_error", "not_found", None, "validation", "unauthorized", None]
    assert out[0].endpoint == "/api/inflation/{sub}" and out[1].endpoint == "/api/predict/{categorie}"
    assert out[1].api == "model" and out[0].api == "data"


def test_alert_held_for_and_absence(spark):
    rows = []
    for minute in range(0, 10):  # errors every minute for 10 minutes, then nothing for 20 minutes, then one request
        rows.append((T0 + dt.timedelta(minutes=minute), "GET", "/api/x", 500, 0.1, None))
    rows.append((T0 + dt.timedelta(minutes=30), "GET", "/api/x", 200, 0.1, None))
    log = log_df(spark, rows)
    runs = M.held_for(M.error_ratio(log), minutes=3).collect()
    assert len(runs) == 1 and runs[0].n_windows == 14  # windows starting at -4 .. 9 minutes
    gaps = M.absences(log, 5).collect()
    assert [(g.silent_minutes, g.silent_from) for g in gaps] == [(20, T0 + dt.timedelta(minutes=10))]


def _ordered_log(spark, tmp_path, rows, slices=3):
    """Land rows in time order (one write per slice) plus one heartbeat per service."""
    from pricedex.streaming.monitor import HEARTBEAT_METHOD

    path = str(tmp_path / "ordered")
    rows = sorted(rows)
    size = len(rows) // slices + 1
    for i in range(slices):
        log_df(spark, rows[i * size:(i + 1) * size]).coalesce(1).write.mode("append").parquet(path)
    end = rows[-1][0] + dt.timedelta(hours=1)
    log_df(spark, [(end, HEARTBEAT_METHOD, "/", 200, 0.0, None),
                   (end, HEARTBEAT_METHOD, "/api/predict", 200, 0.0, None)]).coalesce(1).write.mode(
        "append").parquet(path)
    return path


def _batch_of(spark, path):
    from pricedex.streaming.monitor import HEARTBEAT_METHOD
    return spark.read.schema(RN.REQUEST_LOG_SCHEMA).parquet(path).where(F.col("method") != HEARTBEAT_METHOD)


def test_stateful_stream_forms_equal_batch(spark, tmp_path):
    from pricedex.plans import registry_monitor as RM

    rows = []
    for minute in range(0, 240, 2):  # traffic every 2 minutes, errors between minute 60 and 80, silence 150-170
        if 150 <= minute < 170:
            continue
        status = 500 if 60 <= minute < 80 else 200
        path = "/api/inflation" if minute % 4 else "/api/predict/03"
        rows.append((T0 + dt.timedelta(minutes=minute, seconds=7), "GET", path, status, 0.2, None))
    path = _ordered_log(spark, tmp_path, rows)
    batch = _batch_of(spark, path)

    runs = RN.run_append_stream(spark, path, lambda log: RM._ntz(M.alert_runs(RM._event_time(log), 3), "first_start", "last_start", "fired_at"),
                                max_files=1)
    expected = M.held_for(M.error_ratio(batch), 3)
    assert sorted(runs.select(*expected.columns).collect()) == sorted(expected.collect())
    assert runs.count() >= 1

    stretches = RN.run_append_stream(
        spark, path, lambda log: RM._ntz(M.activity(RM._event_time(log), 5), "first_minute", "last_minute"), max_files=1)
    gaps = M.absences_between(stretches)
    expected_gaps = M.absences(batch, 5)
    assert sorted(gaps.select(*expected_gaps.columns).collect()) == sorted(expected_gaps.collect())
    assert any(g.silent_minutes >= 20 for g in gaps.collect())


def test_stream_equals_batch(spark, tmp_path):
    from pricedex.plans import registry_monitor as RM

    rows = [(T0 + dt.timedelta(seconds=37 * i), "GET", "/api/inflation" if i % 3 else "/api/predict/02",
             500 if i % 11 == 0 else 200, (i % 17) / 10.0, None) for i in range(600)]
    path = _ordered_log(spark, tmp_path, rows)
    for build in (M.error_ratio, M.request_rate):
        batch = build(_batch_of(spark, path))
        stream = RN.run_append_stream(spark, path, lambda log, b=build: RM._ntz(b(RM._event_time(log)), "window_start"),
                                      max_files=1)
        assert sorted(stream.select(*batch.columns).collect()) == sorted(batch.collect())


def test_unknown_paths_of_a_stream_are_one_label(spark):
    rows = [(T0, "GET", p, 200, 0.1, None) for p in ("/x/1", "/x/2", "/health", "/api/predict/01")]
    got = {r.endpoint: r.requests for r in M.request_counts(log_df(spark, rows), known_only=True).collect()}
    assert got == {"other": 2, "/health": 1, "/api/predict/{categorie}": 1}
    odd = [(T0, m, "/health", s, 0.1, None) for m, s in (("GET", 200), ("XYZ1", 200), ("XYZ2", 70000), ("GET", -1))]
    got = {(r.method, r.status_code): r.requests for r in M.request_counts(log_df(spark, odd), known_only=True).collect()}
    assert got == {("GET", "200"): 1, ("other", "200"): 1, ("other", "other"): 1, ("GET", "other"): 1}


def test_sliding_windows_expand_counts_not_requests(spark):
    """The window expansion stands above the per-minute aggregate, not above the scan."""
    for df in (M.error_ratio(log_df(spark, [(T0, "GET", "/api/x", 500, 0.1, None)])),
               M.latency_quantiles(log_df(spark, [(T0, "GET", "/api/x", 500, 0.1, None)]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Expand") < plan.index("functions=[partial_count")


def test_runs_and_absences_equal_a_walk_over_minutes(spark):
    """Sessions against loops over every minute, at the exact lengths where a run fires and an absence counts."""
    rng, rows = random.Random(2), []
    for minute in range(1500):
        if rng.random() < (0.9 if minute // 100 % 2 else 0.15):
            rows.append((T0 + dt.timedelta(minutes=minute, seconds=rng.randrange(60)), "GET", "/api/x",
                         500 if rng.random() < 0.1 else 200, 0.1, None))
    log = log_df(spark, rows)
    at = {}
    for r in rows:
        n = at.setdefault(int((r[0] - T0).total_seconds()) // 60, [0, 0])
        n[0] += 1
        n[1] += r[3] == 500
    runs, start = [], None
    for w in range(-5, 1502):
        n, e = (sum(at.get(m, [0, 0])[i] for m in range(w, w + 5)) for i in (0, 1))
        if n and (e / 300) / (n / 300 + 0.001) > 0.05:
            start = w if start is None else start
        elif start is not None:
            if w - 1 - start >= 3:
                runs.append((start, w - 1))
            start = None
    when = lambda m: T0 + dt.timedelta(minutes=m)
    got = sorted((r.first_start, r.last_start, r.n_windows) for r in M.alert_runs(log, 3).collect())
    assert got == [(when(a), when(b), b - a + 1) for a, b in runs] and len(got) > 5
    assert got == sorted((r.first_start, r.last_start, r.n_windows) for r in M.held_for(M.error_ratio(log), 3).collect())
    active = sorted(at)
    gaps = [(when(a + 1), when(b), b - a - 1) for a, b in zip(active, active[1:]) if b - a - 1 >= 5]
    assert sorted(tuple(r)[1:] for r in M.absences(log, 5).collect()) == gaps and {5} < {g[2] for g in gaps}


def test_stream_forms_have_no_python(spark, tmp_path):
    from pricedex.plans import registry_monitor as RM

    log = log_df(spark, [(T0, "GET", "/api/x", 500, 0.1, None)])
    for df in (M.alert_runs(RM._event_time(log)), M.activity(RM._event_time(log))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "InPandas" not in plan and "MapIn" not in plan and "session_window" in plan


def test_sketch_quantiles_stay_within_their_rank_error(spark):
    rng = random.Random(6)
    rows = [(T0 + dt.timedelta(seconds=rng.randrange(900)), "GET", "/api/inflation", 200, rng.expovariate(3.0), None)
            for _ in range(20_000)]
    log = log_df(spark, rows)
    found = M.sketch_quantiles(M.latency_sketches(log)).select("window_start", "p50", "p95", "p99")
    at = {r.window_start: r for r in found.collect()}
    assert len(at) == 19  # fifteen minutes and the four before that reach into them
    for start, r in at.items():
        values = sorted(v[4] for v in rows if start <= v[0] < start + dt.timedelta(minutes=5))
        for q, p in ((0.5, r.p50), (0.95, r.p95), (0.99, r.p99)):
            rank = sum(v <= p for v in values) / len(values)
            assert abs(rank - q) <= 0.0266 + 1 / len(values)
    off = M.rank_errors(log, found).collect()
    assert len(off) == 19 and all(max(r.p50_off, r.p95_off, r.p99_off) <= 0.0266 for r in off)

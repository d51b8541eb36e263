"""Request-log metrics (M01-M11). The aggregating operators accept a batch or a streaming DataFrame unchanged.

Input: request_log(ts timestamp, method, path, status int, latency_s double, category).
Every window aggregate carries only counts (combinable, fixed-size state per window and key); latency quantiles
are interpolated inside histogram buckets from those counts, as the reference's monitoring does, so no window ever
collects its latencies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricedex import reference_data as R
from pricedex.functions.columns import API_ENDPOINTS, endpoint_label, error_class

SERVER_ERROR = "server_error"
HEARTBEAT_METHOD = "HEARTBEAT"  # of rows that only say how far time has come
SERVICES = 2


def minute_index(c) -> Column:
    """Whole minutes since 1970-01-01 of a timestamp without time zone (independent of the session zone)."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 1440
            + F.hour(c) * 60 + F.minute(c))


def api_of(path) -> Column:
    """Which service observed the request: the model API serves /api/predict and /api/metrics, the data API the rest."""
    p = F.col(path) if isinstance(path, str) else path
    return F.when(p.startswith("/api/predict") | p.startswith("/api/metrics/"), F.lit("model")).otherwise(F.lit("data"))


def enrich(log: DataFrame) -> DataFrame:
    """M01 + M02: endpoint label, error type and service, as projections (streaming-safe)."""
    return log.withColumns({
        "endpoint": endpoint_label("path"), "error_type": error_class("status", "path"), "api": api_of("path"),
        "status_code": F.col("status").cast("string")})


#: Labels of paths that are no pattern; a stream counts every other one as ``other``, so that its state is bounded.
PLAIN_ENDPOINTS = ("/", "/health", "/metrics", "/docs", "/openapi.json")
METHODS = ("GET", "HEAD", "POST", "PUT", "PATCH", "DELETE", "OPTIONS")


def request_counts(log: DataFrame, known_only: bool = False) -> DataFrame:
    """M03. ``known_only`` (streams) keeps the labels to a fixed set: unknown paths, methods and codes count as ``other``."""
    e = enrich(log)
    if known_only:
        known = F.col("endpoint").isin(*API_ENDPOINTS, *PLAIN_ENDPOINTS)
        e = e.withColumns({
            "endpoint": F.when(known, F.col("endpoint")).otherwise("other"),
            "method": F.when(F.col("method").isin(*METHODS), F.col("method")).otherwise("other"),
            "status_code": F.when(F.col("status").between(100, 599), F.col("status_code")).otherwise("other")})
    return e.groupBy("method", "endpoint", "status_code").agg(F.count(F.lit(1)).alias("requests"))


def latency_observed(log: DataFrame) -> DataFrame:
    """Requests whose latency is observed: /api/ paths on the data API, '/predict' paths on the model API."""
    e = enrich(log)
    return e.where(((F.col("api") == "data") & F.col("path").startswith("/api/"))
                   | ((F.col("api") == "model") & F.col("path").contains("/predict")))


def _bucket_counts(bounds) -> list[Column]:
    return [F.count_if(F.col("latency_s") <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]


def latency_histogram(log: DataFrame) -> DataFrame:
    """Cumulative bucket counts per service (long form: le, count; '+Inf' = all), from one pass over the log.

    Counts of both services' bounds are taken together per service (two rows), then each keeps its own bounds."""
    every = sorted({*R.DATA_LATENCY_BOUNDS, *R.PREDICT_LATENCY_BOUNDS})
    agg = latency_observed(log).groupBy("api").agg(*_bucket_counts(every), F.count(F.lit(1)).alias("le_inf"))
    rows = []
    for api, bounds in (("data", R.DATA_LATENCY_BOUNDS), ("model", R.PREDICT_LATENCY_BOUNDS)):
        rows += [F.struct(F.lit(api).alias("of"), F.lit(repr(float(b))).alias("le"),
                          F.col(f"le_{every.index(b)}").alias("cumulative_count")) for b in bounds]
        rows.append(F.struct(F.lit(api).alias("of"), F.lit("+Inf").alias("le"), F.col("le_inf").alias("cumulative_count")))
    return agg.select("api", F.inline(F.array(*rows))).where("api = of").drop("of")


def per_minute(log: DataFrame, *keys: str, **counts: Column) -> DataFrame:
    """Counts per minute (window ``m``) and key: what the sliding windows are summed from, so that a request is not
    expanded into its windows before it is counted."""
    return log.groupBy(F.window("ts", "1 minute").alias("m"), *keys).agg(*[c.alias(n) for n, c in counts.items()])


def sliding(minutes: DataFrame, window: str, slide: str, keys: list[str], sums: list[str]) -> DataFrame:
    """Sums of per-minute counts over sliding windows (``w``) of whole minutes."""
    return minutes.groupBy(F.window(F.window_time("m"), window, slide).alias("w"), *keys).agg(
        *[F.sum(c).alias(c) for c in sums])


def histogram_quantile(q: float, counts: list[Column], total: Column, bounds) -> Column:
    """Quantile by linear interpolation inside the first bucket whose cumulative count reaches q * total; beyond
    the last finite bound, that bound. ``counts`` are cumulative, one per bound."""
    rank = F.lit(float(q)) * total
    chain = None
    for i, ub in enumerate(bounds):
        start = 0.0 if i == 0 else float(bounds[i - 1])
        prev = F.lit(0) if i == 0 else counts[i - 1]
        val = F.lit(start) + F.lit(float(ub) - start) * ((rank - prev) / (counts[i] - prev))
        cond = counts[i] >= rank
        chain = F.when(cond, val) if chain is None else chain.when(cond, val)
    return chain.otherwise(F.lit(float(bounds[-1])))


def latency_quantiles(log: DataFrame, window="5 minutes", slide="1 minute", api="data",
                      quantiles=(0.5, 0.95, 0.99), watermark: str | None = None) -> DataFrame:
    """p50/p95/p99 per sliding window from bucket counts, counted per minute first."""
    bounds = R.DATA_LATENCY_BOUNDS if api == "data" else R.PREDICT_LATENCY_BOUNDS
    df = latency_observed(log).where(F.col("api") == api)
    if watermark:
        df = df.withWatermark("ts", watermark)
    buckets = {f"le_{i}": F.count_if(F.col("latency_s") <= b) for i, b in enumerate(bounds)}
    agg = sliding(per_minute(df, **buckets, n=F.count(F.lit(1))), window, slide, [], [*buckets, "n"])
    counts = [F.col(f"le_{i}") for i in range(len(bounds))]
    return agg.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n",
        *[histogram_quantile(q, counts, F.col("n"), bounds).alias(f"p{int(round(q * 100))}") for q in quantiles])


def latency_sketches(log: DataFrame, api: str = "data", k: int = 200) -> DataFrame:
    """M05, sketch form: a mergeable quantile sketch per minute (window ``m``) of the observed latencies, its size bounded
    by ``k`` whatever the traffic, so that minutes can be kept and any windows of them answered later."""
    seen = latency_observed(log).where((F.col("api") == api) & F.col("latency_s").isNotNull())
    return seen.groupBy(F.window("ts", "1 minute").alias("m")).agg(
        F.kll_sketch_agg_double("latency_s", k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def sketch_quantiles(minutes: DataFrame, window="5 minutes", slide="1 minute", quantiles=(0.5, 0.95, 0.99)) -> DataFrame:
    """Quantiles per sliding window from the minutes' sketches, merged."""
    merged = minutes.groupBy(F.window(F.window_time("m"), window, slide).alias("w")).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))
    return merged.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"p{int(round(q * 100))}") for q in quantiles])


def rank_errors(log: DataFrame, found: DataFrame, api: str = "data", quantiles=(0.5, 0.95, 0.99)) -> DataFrame:
    """How far the share of a window's latencies up to (or below) each found quantile is from what it should be."""
    seen = latency_observed(log).where((F.col("api") == api) & F.col("latency_s").isNotNull())
    rows = seen.select(F.window("ts", "5 minutes", "1 minute")["start"].alias("window_start"), "latency_s").join(found, "window_start")
    names = {q: f"p{int(round(q * 100))}" for q in quantiles}
    shares = rows.groupBy("window_start").agg(F.count(F.lit(1)).alias("n"), *[
        agg for q, c in names.items() for agg in (F.count_if(F.col("latency_s") <= F.col(c)).alias(f"{c}_most"),
                                                  F.count_if(F.col("latency_s") < F.col(c)).alias(f"{c}_least"))])
    off = [F.greatest(F.lit(0.0), F.col(f"{c}_least") / F.col("n") - q, F.lit(q) - F.col(f"{c}_most") / F.col("n")).alias(f"{c}_off")
           for q, c in names.items()]
    return shares.select("window_start", "n", *off)


def request_rate(log: DataFrame, window="1 minute", watermark: str | None = None) -> DataFrame:
    """Requests per second per endpoint over tumbling windows."""
    e = enrich(log)
    if watermark:
        e = e.withWatermark("ts", watermark)
    seconds = {"1 minute": 60.0, "5 minutes": 300.0}[window]
    agg = e.groupBy(F.window("ts", window).alias("w"), "endpoint").agg(F.count(F.lit(1)).alias("requests"))
    return agg.select(F.col("w.start").alias("window_start"), "endpoint", "requests",
                      (F.col("requests") / F.lit(seconds)).alias("rate_per_s"))


def _error_windows(log: DataFrame, window: str, slide: str, threshold: float, watermark: str | None) -> DataFrame:
    """Per service and sliding window ``w``: requests, server errors, their ratio and whether it is above the threshold."""
    e = enrich(log)
    if watermark:
        e = e.withWatermark("ts", watermark)
    minutes = per_minute(e, "api", requests=F.count(F.lit(1)), server_errors=F.count_if(F.col("error_type") == SERVER_ERROR))
    agg = sliding(minutes, window, slide, ["api"], ["requests", "server_errors"])
    ratio = (F.col("server_errors") / F.lit(300.0)) / ((F.col("requests") / F.lit(300.0)) + F.lit(0.001))
    return agg.select("w", "api", "requests", "server_errors", ratio.alias("error_ratio"), (ratio > threshold).alias("alert"))


def error_ratio(log: DataFrame, window="5 minutes", slide="1 minute", threshold=0.05,
                watermark: str | None = None) -> DataFrame:
    """Server-error rate / (request rate + 0.001) per service and sliding window; alert above ``threshold``."""
    found = _error_windows(log, window, slide, threshold, watermark)
    return found.select(F.col("w.start").alias("window_start"), "api", "requests", "server_errors", "error_ratio", "alert")


def errors_by_type(log: DataFrame) -> DataFrame:
    """Error totals by type."""
    return enrich(log).where(F.col("error_type").isNotNull()).groupBy("api", "error_type").agg(
        F.count(F.lit(1)).alias("errors"))


def predictions_by_category(log: DataFrame) -> DataFrame:
    """Prediction requests by category."""
    return enrich(log).where(F.col("path").startswith("/api/predict/")).groupBy("category").agg(
        F.count(F.lit(1)).alias("predictions"))


def held_for(alerts: DataFrame, minutes: int = 3, key="api") -> DataFrame:
    """M10 (batch): alert windows (one per minute) grouped into runs of consecutive minutes; a run fires once it
    has held for ``minutes``. Islands = minute index minus row number; runs on the windowed result, whose size is
    bounded by the minutes of the period."""
    a = alerts.where(F.col("alert")).select(key, "window_start")
    idx = minute_index("window_start")
    rn = F.row_number().over(Window.partitionBy(key).orderBy("window_start"))
    runs = a.withColumn("grp", idx - rn).groupBy(key, "grp").agg(
        F.min("window_start").alias("first_start"), F.max("window_start").alias("last_start"),
        F.count(F.lit(1)).alias("n_windows"))
    held = (F.col("n_windows") - 1) >= minutes
    return runs.where(held).select(
        key, "first_start", "last_start", "n_windows",
        (F.col("first_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))).alias("fired_at"))


def alert_runs(log: DataFrame, minutes: int = 3, threshold: float = 0.05, watermark: str | None = None) -> DataFrame:
    """M10 (stream or batch, the rows of ``held_for``): a run of alerting windows, one a minute, is a session of them: the
    next is one minute later or the session ends. Its state is one row per open run and service; silence costs nothing."""
    alerting = _error_windows(log, "5 minutes", "1 minute", threshold, watermark).where("alert")
    runs = alerting.groupBy(F.session_window(F.window_time("w"), "90 seconds").alias("run"), "api").agg(
        F.min("w.start").alias("first_start"), F.max("w.start").alias("last_start"), F.count(F.lit(1)).alias("n_windows"))
    return runs.where(F.col("n_windows") - 1 >= minutes).select(
        "api", "first_start", "last_start", "n_windows",
        (F.col("first_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))).alias("fired_at"))


def activity(log: DataFrame, minutes: int = 5, watermark: str | None = None) -> DataFrame:
    """Per service the stretches (first and last active minute) without ``minutes`` silent whole minutes inside (stream or
    batch): sessions of its active minutes, which are counted first."""
    e = enrich(log)
    if watermark:
        e = e.withWatermark("ts", watermark)
    active = per_minute(e, "api", requests=F.count(F.lit(1)))
    stretch = F.session_window(F.window_time("m"), f"{60 * minutes + 30} seconds")  # whole minutes apart: the half decides
    return active.groupBy(stretch.alias("stretch"), "api").agg(
        F.min("m.start").alias("first_minute"), F.max("m.start").alias("last_minute")).drop("stretch")


def absences(log: DataFrame, minutes: int = 5) -> DataFrame:
    """Stretches of at least ``minutes`` whole minutes without any request, per service."""
    return absences_between(activity(log, minutes))


def absences_between(stretches: DataFrame) -> DataFrame:
    """M11 from a table of ``activity``, a stream's sink too: an absence is the gap between two stretches of a service."""
    prev = F.lag("last_minute").over(Window.partitionBy("api").orderBy("first_minute"))  # one row a stretch
    gaps = stretches.withColumn("prev", prev).where(F.col("prev").isNotNull())
    return gaps.select("api", (F.col("prev") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))).alias("silent_from"),
                       F.col("first_minute").alias("silent_until"),
                       (minute_index("first_minute") - minute_index("prev") - 1).alias("silent_minutes"))

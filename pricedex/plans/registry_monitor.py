"""Registered monitoring queries (M01-M11): batch forms over the request log, and the same operators run as
Structured Streaming queries (stream result = batch result, checked against the same SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricedex import reference_data as R
from pricedex.plans import oracle as O
from pricedex.plans.registry import W, register
from pricedex.sources import standins as S
from pricedex.streaming import monitor as M
from pricedex.streaming import runner as RN


def _log(spark, sf):
    return S.request_log(spark, sf)


M03_SQL = W("""
    select method, endpoint, status_code, count(*) as requests from enriched
    group by method, endpoint, status_code""", "enriched")


def _m04_sql() -> str:
    parts = []
    for api, bounds in (("data", R.DATA_LATENCY_BOUNDS), ("model", R.PREDICT_LATENCY_BOUNDS)):
        for b in bounds:
            parts.append(f"select '{api}' as api, '{float(b)!r}' as le, count(*) filter (where latency_s <= {O.dbl(b)})"
                         f" as cumulative_count from observed where api = '{api}'")
        parts.append(f"select '{api}', '+Inf', count(*) from observed where api = '{api}'")
    return W(" union all ".join(parts), "observed")


def _m05_sql(api="data", quantiles=(0.5, 0.95, 0.99)) -> str:
    bounds = R.DATA_LATENCY_BOUNDS if api == "data" else R.PREDICT_LATENCY_BOUNDS
    counts = [f"le_{i}" for i in range(len(bounds))]
    buckets = ", ".join(f"count(*) filter (where latency_s <= {O.dbl(b)}) as le_{i}" for i, b in enumerate(bounds))
    qs = ", ".join(f"{O.hist_quantile(q, counts, 'n', bounds)} as p{int(round(q * 100))}" for q in quantiles)
    return W(f"""
        select window_start, window_start + interval 5 minute as window_end, n, {qs}
        from (select date_trunc('minute', ts) - k * interval 1 minute as window_start, {buckets}, count(*) as n
              from observed cross join range(5) t(k) where api = '{api}' group by 1)""", "observed")


M05_SQL = _m05_sql()

M07_BODY = f"""
    select window_start, api, requests, server_errors,
           (server_errors / {O.dbl(300)}) / ((requests / {O.dbl(300)}) + {O.dbl(0.001)}) as error_ratio,
           (server_errors / {O.dbl(300)}) / ((requests / {O.dbl(300)}) + {O.dbl(0.001)}) > {O.dbl(0.05)} as alert
    from (select date_trunc('minute', ts) - k * interval 1 minute as window_start, api, count(*) as requests,
                 count(*) filter (where error_type = 'server_error') as server_errors
          from enriched cross join range(5) t(k) group by 1, 2)"""
M07_SQL = W(M07_BODY, "enriched")

register("m01_endpoint_labels", W("""
    select path, endpoint, api from (select distinct path, endpoint, api from enriched)""", "enriched"))(
    lambda spark, sf: M.enrich(_log(spark, sf)).select("path", "endpoint", "api").distinct())

register("m02_error_classes", W("""
    select status, path, error_type from (select distinct status, path, error_type from enriched)""", "enriched"))(
    lambda spark, sf: M.enrich(_log(spark, sf)).select("status", "path", "error_type").distinct())

register("m03_request_counts", M03_SQL)(lambda spark, sf: M.request_counts(_log(spark, sf)))
register("m04_latency_histogram", _m04_sql())(lambda spark, sf: M.latency_histogram(_log(spark, sf)))
register("m05_latency_quantiles", M05_SQL)(lambda spark, sf: M.latency_quantiles(_log(spark, sf)))
register("m05_predict_latency_quantiles", _m05_sql("model"))(
    lambda spark, sf: M.latency_quantiles(_log(spark, sf), api="model"))

#: Rank error that a sketch of the default size stays within (its normalised error for single ranks, both sides).
SKETCH_ERROR = 0.0266


@register("m05_sketch_quantiles", W(f"""
    select ts_w as window_start, count(*) as n, true as p50_within, true as p95_within, true as p99_within
    from (select unnest([date_trunc('minute', ts) - to_minutes(i) for i in range(0, 5)]) as ts_w
          from observed where api = 'data' and latency_s is not null) group by 1""", "observed"))
def _m05_sketch(spark, sf):
    """M05 from merged sketches of minutes: in every window each quantile's rank is within the sketch's bound."""
    log = _log(spark, sf)
    off = M.rank_errors(log, M.sketch_quantiles(M.latency_sketches(log)).select("window_start", "p50", "p95", "p99"))
    return off.select("window_start", "n", *[(F.col(f"{c}_off") <= SKETCH_ERROR).alias(f"{c}_within") for c in ("p50", "p95", "p99")])


M06_SQL = W(f"""
    select date_trunc('minute', ts) as window_start, endpoint, count(*) as requests,
           count(*) / {O.dbl(60)} as rate_per_s
    from enriched group by 1, 2""", "enriched")

register("m06_request_rate", M06_SQL)(lambda spark, sf: M.request_rate(_log(spark, sf)))

register("m06_request_rate_5m", W(f"""
    select time_bucket(interval 5 minute, ts) as window_start, endpoint, count(*) as requests,
           count(*) / {O.dbl(300)} as rate_per_s
    from enriched group by 1, 2""", "enriched"))(lambda spark, sf: M.request_rate(_log(spark, sf), "5 minutes"))

register("m07_error_ratio", M07_SQL)(lambda spark, sf: M.error_ratio(_log(spark, sf)))

register("m08_errors_by_type", W("""
    select api, error_type, count(*) as errors from enriched where error_type is not null
    group by api, error_type""", "enriched"))(lambda spark, sf: M.errors_by_type(_log(spark, sf)))

register("m08_predictions_by_category", W("""
    select category, count(*) as predictions from enriched where starts_with(path, '/api/predict/')
    group by category""", "enriched"))(lambda spark, sf: M.predictions_by_category(_log(spark, sf)))

M10_SQL = W(f"""
    select api, min(window_start) as first_start, max(window_start) as last_start, count(*) as n_windows,
           min(window_start) + interval 3 minute as fired_at
    from (select api, window_start,
                 datediff('minute', timestamp '1970-01-01', window_start)
                   - row_number() over (partition by api order by window_start) as grp
          from ({M07_BODY}) a where alert)
    group by api, grp having count(*) - 1 >= 3""", "enriched")

register("m10_alert_held_for", M10_SQL)(lambda spark, sf: M.held_for(M.error_ratio(_log(spark, sf)), 3))

M11_SQL = W("""
    select api, prev + interval 1 minute as silent_from, minute as silent_until,
           datediff('minute', prev, minute) - 1 as silent_minutes
    from (select api, minute, lag(minute) over (partition by api order by minute) as prev
          from (select distinct api, date_trunc('minute', ts) as minute from enriched))
    where prev is not null and datediff('minute', prev, minute) - 1 >= 5""", "enriched")

register("m11_absences", M11_SQL)(lambda spark, sf: M.absences(_log(spark, sf), 5))

# ---------------------------------------------------------------------------------------- streaming twins
def _event_time(log, watermark=RN.WATERMARK):
    """Event time as a zoned timestamp (watermarks need one), the watermark, then heartbeats dropped (they still
    advance the watermark: the condition names ``ts``, so that Spark does not filter before the watermark)."""
    return (log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
            .where(F.col("method") != F.when(F.col("ts").isNotNull(), M.HEARTBEAT_METHOD)))


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _stream_update(spark, sf, build, keys):
    return RN.run_update_stream(spark, RN.land_request_log_in_order(spark, sf), build, keys)


def _stream_append(spark, sf, build, state_partitions=None):
    """A stream keyed by service (and window) has as many state partitions as there are services: its counts are few."""
    return RN.run_append_stream(spark, RN.land_request_log_in_order(spark, sf), build, state_partitions=state_partitions)


def _without_heartbeats(log):
    return log.where(F.col("method") != M.HEARTBEAT_METHOD)


register("m03_stream_request_counts", M03_SQL)(lambda spark, sf: _stream_update(
    spark, sf, lambda log: M.request_counts(_without_heartbeats(log), known_only=True),
    ["method", "endpoint", "status_code"]))
register("m04_stream_latency_histogram", _m04_sql())(lambda spark, sf: _stream_update(
    spark, sf, lambda log: M.latency_histogram(_without_heartbeats(log)), ["api", "le"]))
register("m05_stream_latency_quantiles", M05_SQL)(lambda spark, sf: _stream_append(
    spark, sf, lambda log: _ntz(M.latency_quantiles(_event_time(log)), "window_start", "window_end"), M.SERVICES))
register("m06_stream_request_rate", M06_SQL)(lambda spark, sf: _stream_append(
    spark, sf, lambda log: _ntz(M.request_rate(_event_time(log)), "window_start")))
register("m07_stream_error_ratio", M07_SQL)(lambda spark, sf: _stream_append(
    spark, sf, lambda log: _ntz(M.error_ratio(_event_time(log)), "window_start"), M.SERVICES))
register("m10_stream_alert_held_for", M10_SQL)(lambda spark, sf: _stream_append(
    spark, sf, lambda log: _ntz(M.alert_runs(_event_time(log), 3), "first_start", "last_start", "fired_at"), M.SERVICES))
register("m11_stream_absences", M11_SQL)(lambda spark, sf: M.absences_between(_stream_append(
    spark, sf, lambda log: _ntz(M.activity(_event_time(log), 5), "first_minute", "last_minute"), M.SERVICES)))

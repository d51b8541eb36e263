"""Registered forecasting and impact queries.

The fitted models have SQL twins in ``plans.oracle_forecast``; the data steps also run on a seasonal-naive model.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricedex.operators import forecast as FC
from pricedex.operators import impact as IM
from pricedex.plans import oracle_forecast as Q
from pricedex.plans import tables as T
from pricedex.plans.registry import W, m2, register
from pricedex.sources.store import materialise

SRC = "INSEE"
CUTOFF = FC.DEFAULT_CUTOFF


def _series(spark, sf):
    return FC.modelling_series(T.unified(spark, sf), SRC)


def _fc_of(spark, sf, model, horizon=12):
    """The forecast output of one model, written once per application (the model store of the reference)."""
    key = (os.path.abspath(sf), SRC, CUTOFF, horizon, model)
    return materialise(spark, "forecast", key, lambda: FC.forecast(_series(spark, sf), CUTOFF, horizon, (model,)),
                       partition_by=["kind"], schema=FC.FORECAST_SCHEMA,
                       columns=[f.split()[0] for f in FC.FORECAST_SCHEMA.split(", ")])


def _fc(spark, sf):
    """The production model's rows (additive trend + season)."""
    return _fc_of(spark, sf, "additive")


def _fc_all(spark, sf):
    return reduce(DataFrame.unionByName, [_fc_of(spark, sf, m) for m in FC.MODELS])


def _fits(spark, sf, model):
    """The fitted models of one monthly family, written once per application."""
    key = (os.path.abspath(sf), SRC, CUTOFF, model)
    return materialise(spark, "fits", key, lambda: FC.monthly_fits(FC.observations(_series(spark, sf), CUTOFF)[0], model))


OF = Q.with_forecast


register("f01_modelling_series", W(f"""
    select source, area, category, obs_date as ds, cast(value as double) as y from unified
    where source = '{SRC}'""", "unified"))(lambda spark, sf: _series(spark, sf))

register("f02_temporal_split", W(f"""
    select source, area, category, count(*) filter (where obs_date < date '{CUTOFF}') as n_train,
           count(*) filter (where obs_date >= date '{CUTOFF}') as n_eval
    from unified where source = '{SRC}' group by source, area, category""", "unified"))(
    lambda spark, sf: FC.with_split(_series(spark, sf), CUTOFF).groupBy(*FC.SERIES_KEY).agg(
        F.count_if(F.col("fold") == "train").alias("n_train"), F.count_if(F.col("fold") == "eval").alias("n_eval")))

register("f05_future_frame", W(f"""
    select source, area, category,
           cast(unnest(generate_series(last_ds + interval 1 month, last_ds + interval 12 month, interval 1 month))
                as date) as ds
    from (select source, area, category, max(obs_date) as last_ds from unified where source = '{SRC}'
          group by source, area, category)""", "unified"))(
    lambda spark, sf: FC.future_frame(_series(spark, sf), 12))

register("f07_forecast_all", OF("""
    select source, area, category, ds as date_pred, round_even(yhat, 4) as yhat, round_even(yhat_lower, 4) as yhat_lower,
           round_even(yhat_upper, 4) as yhat_upper from fc where kind = 'future'""", "additive"))(
    lambda spark, sf: _fc(spark, sf).where(F.col("kind") == "future").select(
        *FC.SERIES_KEY, F.col("ds").alias("date_pred"), F.bround("yhat", 4).alias("yhat"),
        F.bround("yhat_lower", 4).alias("yhat_lower"), F.bround("yhat_upper", 4).alias("yhat_upper")))

register("f06_prediction_interval", OF("""
    select source, area, category, kind, ds, round_even(yhat - yhat_lower, 4) as below, round_even(yhat_upper - yhat, 4) as above
    from fc where kind <> 'fitted'""", "additive"))(
    lambda spark, sf: _fc(spark, sf).where(F.col("kind") != "fitted").select(
        *FC.SERIES_KEY, "kind", "ds", F.bround(F.col("yhat") - F.col("yhat_lower"), 4).alias("below"),
        F.bround(F.col("yhat_upper") - F.col("yhat"), 4).alias("above")))

register("f09_forecast_metrics", OF("select * from m", "additive"))(lambda spark, sf: FC.metrics(_fc(spark, sf)))

register("f12_model_benchmark", OF("""
    select *, cast(row_number() over (partition by source, area, category order by mae, model) as integer) as rank from m""",
    *FC.MODELS))(lambda spark, sf: FC.benchmark(_fc_all(spark, sf)))

register("f10_holt_winters_weights", OF("""
    select source, area, category, fit, n, round(alpha, 4) as alpha, round(beta, 4) as beta, round(gamma, 4) as gamma,
           round_even(sse, 4) as sse, round_even(sigma, 6) as sigma from smoothed""", "holt_winters"))(
    lambda spark, sf: _fits(spark, sf, "holt_winters").select(
        *FC.FIT_KEY, "n", *[F.round(c, 4).alias(c) for c in ("alpha", "beta", "gamma")], F.bround("sse", 4).alias("sse"),
        F.bround("sigma", 6).alias("sigma")))

register("f11_arima_coefficients", OF("""
    select source, area, category, fit, kind, unit, d1, round_even(coef[1], 6) as intercept, round_even(coef[2], 9) as ar1,
           round_even(coef[3], 9) as ar2, round_even(coef[4], 9) as ma1, round_even(coef[5], 9) as ma2,
           round_even(sigma, 4) as sigma from arima_fit""", "arima_2_1_2"))(
    lambda spark, sf: _fits(spark, sf, "arima_2_1_2").select(
        *FC.FIT_KEY, "kind", "unit", "d1", F.bround(F.col("coef")[0], 6).alias("intercept"),
        *[F.bround(F.col("coef")[i + 1], 9).alias(c) for i, c in enumerate(("ar1", "ar2", "ma1", "ma2"))],
        F.bround("sigma", 4).alias("sigma")))

for _name, _model in (("f10_holt_winters_forecast", "holt_winters"), ("f11_arima_forecast", "arima_2_1_2")):
    register(_name, OF("""
        select source, area, category, kind, ds, round_even(yhat, 4) as yhat, round_even(yhat_lower, 4) as yhat_lower,
               round_even(yhat_upper, 4) as yhat_upper, n_train from fc""", _model))(
        lambda spark, sf, model=_model: _fc_of(spark, sf, model).select(
            *FC.SERIES_KEY, "kind", "ds", *[F.bround(c, 4).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")], "n_train"))

register("f13_decomposition", OF("""
    select source, area, category, ds, y, round_even(yhat, 6) as yhat, round_even(trend, 6) as trend,
           round_even(yearly, 6) as yearly from fc where kind = 'fitted'""", "additive"))(
    lambda spark, sf: _fc(spark, sf).where(F.col("kind") == "fitted").select(
        *FC.SERIES_KEY, "ds", "y", *[F.bround(c, 6).alias(c) for c in ("yhat", "trend", "yearly")]))

_NAMES = ["00 - Ensemble", "03", "0", "zz"]


@register("f14_category_resolution", W(" union all ".join(f"""
    select '{n}' as query,
           case when max(case when category = '{n}' then 1 else 0 end) = 1 then 'exact'
                when count(*) filter (where starts_with(category, '{n}')) = 1 then 'prefix'
                when count(*) filter (where starts_with(category, '{n}')) > 1 then 'ambiguous'
                else 'not_found' end as status,
           case when max(case when category = '{n}' then 1 else 0 end) = 1 then '{n}'
                when count(*) filter (where starts_with(category, '{n}')) = 1
                  then max(category) filter (where starts_with(category, '{n}')) end as category,
           count(*) filter (where starts_with(category, '{n}')) as n_candidates
    from (select distinct category from unified where source = '{SRC}')""" for n in _NAMES), "unified"))
def _f14(spark, sf):
    cats = T.unified(spark, sf).where(F.col("source") == SRC).select("category")
    return FC.resolve_categories(cats, _NAMES)


register("f15_category_slugs", W(r"""
    select category, trim(regexp_replace(lower(category), '[^a-z0-9]+', '_', 'g'), '_') as slug
    from (select distinct category from unified)""", "unified"))(
    lambda spark, sf: FC.category_slugs(T.unified(spark, sf)))

register("f16_total_predicted_change", OF("""
    select source, area, category, round_even(arg_max(yhat, ds) - arg_min(yhat, ds), 4) as total_change, count(*) as horizon
    from fc where kind = 'future' group by all""", "additive"))(lambda spark, sf: FC.total_change(_fc(spark, sf)))

_BUDGET = """
    select h.source, h.area, h.category, current_date_ as current_date, ds as target_date, cur as current_index,
           yhat as predicted_index, round_even(850.0::double * (yhat / cur), 0) as future_budget,
           round_even(850.0::double * (yhat_lower / cur), 0) as future_budget_min,
           round_even(850.0::double * (yhat_upper / cur), 0) as future_budget_max,
           round_even(850.0::double * (yhat / cur), 0) - 850 as delta, (yhat - cur) / cur * 100 as change_pct,
           round_even(850.0::double * ((yhat - cur) / cur), 0) as monthly_impact,
           round_even(850.0::double * ((yhat - cur) / cur), 0) * 6 as cumulative_impact
    from (select *, row_number() over (partition by source, area, category order by ds) as step
          from {fc} where kind = 'future') h
    join (select source, area, category, arg_max(y, ds) as cur, max(ds) as current_date_ from s group by all) c
      on h.source = c.source and h.area = c.area and h.category = c.category
    where step = 6"""

register("f17_budget_simulation", OF(_BUDGET.format(fc="fc"), "additive"))(
    lambda spark, sf: IM.budget_simulation(_series(spark, sf), _fc(spark, sf), amount=850.0, horizon=6))

register("f19_inflation_in_euros", W(f"""
    select ref_year, cur_year, index_start, index_end, budget,
           cast(round_even(budget * (index_end / index_start), 0) as bigint) as budget_now,
           cast(round_even(budget * (index_end / index_start), 0) as bigint) - budget as monthly_increase,
           (cast(round_even(budget * (index_end / index_start), 0) as bigint) - budget) * 12 as annual_increase
    from (select min(year) filter (where year >= 1997) as ref_year, max(year) as cur_year,
                 arg_min(m, year) filter (where year >= 1997) as index_start, arg_max(m, year) as index_end
          from (select cast(extract(year from obs_date) as integer) as year, {m2('value')} as m
                from unified where source = 'INSEE' and category ilike '%00%' group by 1))
    cross join (select unnest([300, 500, 800, 1200, 2000]) as budget)
    where index_start is not null""", "unified"))(lambda spark, sf: IM.inflation_in_euros(T.unified(spark, sf)))


def _metrics(spark, sf):
    return FC.metrics(_fc(spark, sf))


register("f20_reliability_flags", OF("""
    select source, area, category, model, mae, case when mae <= 5 then 'ok' else 'unreliable' end as status,
           case when mae <= 1 then 'excellent' when mae <= 2 then 'good' when mae <= 5 then 'fair' else 'poor' end as band,
           mae > 5 as alert from m""", "additive"))(lambda spark, sf: FC.reliability(_metrics(spark, sf)))
register("f21_modelled_categories", W(f"""
    select distinct category from (
        select category, count(*) filter (where obs_date < date '{CUTOFF}') as n_train,
               count(*) filter (where obs_date >= date '{CUTOFF}') as n_eval
        from unified where source = '{SRC}' group by source, area, category)
    where n_train >= 2 and n_eval >= 1""", "unified"))(
    lambda spark, sf: FC.modelled_categories(_metrics(spark, sf)))
register("j08_actual_vs_predicted", OF("""
    select source, area, category, ds, y as actual, round_even(yhat, 6) as predicted, round_even(y - yhat, 6) as error
    from fc where kind = 'eval'""", "additive"))(
    lambda spark, sf: _fc(spark, sf).where(F.col("kind") == "eval").select(
        *FC.SERIES_KEY, "ds", F.col("y").alias("actual"), F.bround("yhat", 6).alias("predicted"),
        F.bround(F.col("y") - F.col("yhat"), 6).alias("error")))
register("j09_history_forecast_overlay", OF("""
    select source, area, category, ds, y, round_even(yhat, 6) as yhat, round_even(yhat_lower, 4) as yhat_lower,
           round_even(yhat_upper, 4) as yhat_upper, case when kind = 'future' then 'forecast' else 'history' end as kind
    from fc where kind <> 'eval'
    union all select source, area, category, ds, y, null, null, null, 'history' from sn where n < 2""", "additive"))(
    lambda spark, sf: FC.overlay(_series(spark, sf), _fc(spark, sf)).withColumns(
        {c: F.bround(c, d) for c, d in (("yhat", 6), ("yhat_lower", 4), ("yhat_upper", 4))}))
register("a21_forecast_quality_summary", OF("""
    select median(mae) as median_mae, median(mape_pct) as median_mape_pct,
           (select area || ' / ' || category from m order by mae, area || ' / ' || category limit 1) as best_series,
           min(mae) as best_mae,
           (select area || ' / ' || category from m order by mae desc, area || ' / ' || category limit 1) as worst_series,
           max(mae) as worst_mae, count(*) as n_series from m""", "additive"))(lambda spark, sf: FC.quality_summary(_metrics(spark, sf)))
register("a22_forecast_quality_mean", OF("""
    select area, category, mae, rmse, mape_pct from m
    union all select 'mean', 'mean', round_even(avg(mae), 6), round_even(avg(rmse), 6), round_even(avg(mape_pct), 6) from m""",
    "additive"))(lambda spark, sf: FC.quality_mean(_metrics(spark, sf)).withColumns(
        {c: F.bround(c, 6) for c in ("mae", "rmse", "mape_pct")}))
register("l07_metrics_by_mae", OF("select * from m order by mae, area, category", "additive"))(
    lambda spark, sf: _metrics(spark, sf).orderBy("mae", "area", "category"))
register("m09_mae_alert", OF("""
    select source, area, category, model, mae, 'unreliable' as status, 'poor' as band, true as alert from m where mae > 5""", "additive"))(
    lambda spark, sf: FC.reliability(_metrics(spark, sf)).where(F.col("alert")))


@register("s11_metrics_json_roundtrip", OF("""
    select area || ' / ' || category as category, mae, rmse, mape_pct, cast(n_train as bigint) as n_train, n_eval from m""", "additive"))
def _s11(spark, sf):
    """Per-series metrics persisted as JSON lines and loaded back (a table, not a driver dict)."""
    from pricedex.sources import files as FS
    from pricedex.sources.landing import fresh_path

    m = _metrics(spark, sf).select(F.concat_ws(" / ", "area", "category").alias("category"), "mae", "rmse",
                                    "mape_pct", "n_train", "n_eval")
    path = fresh_path(spark, "metrics_json")
    FS.write_metrics(m, path)
    return FS.read_metrics(spark, path)


# ---------------------------------------------------------------------------- the same data steps on a model SQL can compute
def _naive(spark, sf):
    return FC.seasonal_naive(_series(spark, sf), CUTOFF, 12)


NAIVE_CTES = f"""
    s as (select source, area, category, obs_date as ds, cast(value as double) as y from unified where source = '{SRC}'),
    l as (select source, area, category, max(ds) as last_ds from s group by all),
    frame as (select *, case when ds < date '{CUTOFF}' then 'train' else 'eval' end as fold from s
              union all
              select source, area, category,
                     cast(unnest(generate_series(last_ds + interval 1 month, last_ds + interval 12 month, interval 1 month)) as date),
                     null, 'future' from l),
    r as (select f.*, b.y as yhat, b.ds as from_ds from frame f
          left join s b on f.source = b.source and f.area = b.area and f.category = b.category
               and b.ds = cast(f.ds - interval 12 month as date)),
    b as (select source, area, category, max(abs(y - yhat)) filter (where fold = 'train') as eval_band,
                 max(abs(y - yhat)) as future_band, cast(count(*) filter (where fold = 'train') as integer) as n_train
          from r group by all),
    naive as (select r.source, r.area, r.category, 'seasonal_naive' as model, fold as kind, ds, y, yhat,
                     yhat - coalesce(case when fold = 'eval' then eval_band else future_band end, 0) as yhat_lower,
                     yhat + coalesce(case when fold = 'eval' then eval_band else future_band end, 0) as yhat_upper, n_train
              from r join b on r.source = b.source and r.area = b.area and r.category = b.category
              where yhat is not null and (fold = 'future' or (fold = 'eval' and from_ds < date '{CUTOFF}'))),
    m as (select source, area, category, model, round_even(avg(abs(y - yhat)), 4) as mae,
                 round_even(sqrt(avg((y - yhat) * (y - yhat))), 4) as rmse,
                 round_even(avg(abs((y - yhat) / case when y <> 0 then y else 1 end)) * 100, 2) as mape_pct,
                 max(n_train) as n_train, count(*) as n_eval
          from naive where kind = 'eval' group by source, area, category, model)"""


def _with_naive(body: str) -> str:
    return W("\x00", "unified").replace("\n\x00", "," + NAIVE_CTES + "\n" + body)


def _naive_metrics(spark, sf):
    return FC.metrics(_naive(spark, sf))


register("f07_naive_forecast", _with_naive("""
    select source, area, category, ds as date_pred, round_even(yhat, 4) as yhat, round_even(yhat_lower, 4) as yhat_lower,
           round_even(yhat_upper, 4) as yhat_upper from naive where kind = 'future'"""))(
    lambda spark, sf: _naive(spark, sf).where(F.col("kind") == "future").select(
        *FC.SERIES_KEY, F.col("ds").alias("date_pred"), F.bround("yhat", 4).alias("yhat"),
        F.bround("yhat_lower", 4).alias("yhat_lower"), F.bround("yhat_upper", 4).alias("yhat_upper")))
register("f09_naive_metrics", _with_naive("select * from m"))(_naive_metrics)
register("f12_naive_benchmark", _with_naive("""
    select *, cast(row_number() over (partition by source, area, category order by mae, model) as integer) as rank from m"""))(
    lambda spark, sf: FC.benchmark(_naive(spark, sf)))
register("f16_naive_total_change", _with_naive("""
    select source, area, category, round_even(arg_max(yhat, ds) - arg_min(yhat, ds), 4) as total_change, count(*) as horizon
    from naive where kind = 'future' group by all"""))(
    lambda spark, sf: FC.total_change(_naive(spark, sf), "seasonal_naive"))
register("f17_naive_budget", _with_naive(_BUDGET.format(fc="naive")))(
    lambda spark, sf: IM.budget_simulation(_series(spark, sf), _naive(spark, sf), 850.0, 6, "seasonal_naive"))
register("f20_naive_reliability", _with_naive("""
    select source, area, category, model, mae, case when mae <= 5 then 'ok' else 'unreliable' end as status,
           case when mae <= 1 then 'excellent' when mae <= 2 then 'good' when mae <= 5 then 'fair' else 'poor' end as band,
           mae > 5 as alert from m"""))(lambda spark, sf: FC.reliability(_naive_metrics(spark, sf)))
register("m09_naive_alert", _with_naive("select source, area, category, model, mae from m where mae > 5"))(
    lambda spark, sf: FC.reliability(_naive_metrics(spark, sf)).where(F.col("alert")).select(*FC.SERIES_KEY, "model", "mae"))
register("j08_naive_actual_vs_predicted", _with_naive("""
    select source, area, category, ds, y as actual, yhat as predicted, y - yhat as error from naive where kind = 'eval'"""))(
    lambda spark, sf: _naive(spark, sf).where(F.col("kind") == "eval").select(
        *FC.SERIES_KEY, "ds", F.col("y").alias("actual"), F.col("yhat").alias("predicted"),
        (F.col("y") - F.col("yhat")).alias("error")))
register("j09_naive_overlay", _with_naive("""
    select coalesce(s.source, f.source) as source, coalesce(s.area, f.area) as area, coalesce(s.category, f.category) as category,
           coalesce(s.ds, f.ds) as ds, s.y, f.yhat, f.yhat_lower, f.yhat_upper,
           case when s.ds is not null then 'history' else 'forecast' end as kind
    from s full join (select * from naive where kind = 'future') f
      on s.source = f.source and s.area = f.area and s.category = f.category and s.ds = f.ds"""))(
    lambda spark, sf: FC.overlay(_series(spark, sf), _naive(spark, sf), "seasonal_naive"))
register("a21_naive_quality_summary", _with_naive("""
    select median(mae) as median_mae, median(mape_pct) as median_mape_pct,
           (select area || ' / ' || category from m order by mae, area || ' / ' || category limit 1) as best_series,
           min(mae) as best_mae,
           (select area || ' / ' || category from m order by mae desc, area || ' / ' || category limit 1) as worst_series,
           max(mae) as worst_mae, count(*) as n_series from m"""))(
    lambda spark, sf: FC.quality_summary(_naive_metrics(spark, sf)))
register("a22_naive_quality_mean", _with_naive("""
    select area, category, mae, rmse, mape_pct from m
    union all select 'mean', 'mean', round_even(avg(mae), 6), round_even(avg(rmse), 6), round_even(avg(mape_pct), 6) from m"""))(
    lambda spark, sf: FC.quality_mean(_naive_metrics(spark, sf)).withColumns(
        {c: F.bround(c, 6) for c in ("mae", "rmse", "mape_pct")}))
register("l07_naive_metrics_by_mae", _with_naive("""
    select source, area, category, mae, row_number() over (order by mae, area, category) - 1 as position from m"""))(
    lambda spark, sf: _naive_metrics(spark, sf).orderBy("mae", "area", "category").coalesce(1).select(
        *FC.SERIES_KEY, "mae", F.monotonically_increasing_id().alias("position")))


@register("s11_naive_metrics_json", _with_naive("""
    select area || ' / ' || category as category, mae, rmse, mape_pct, cast(n_train as bigint) as n_train, n_eval from m"""))
def _s11_naive(spark, sf):
    from pricedex.sources import files as FS
    from pricedex.sources.landing import fresh_path

    path = fresh_path(spark, "metrics_json")
    FS.write_metrics(_naive_metrics(spark, sf).select(F.concat_ws(" / ", "area", "category").alias("category"), "mae", "rmse",
                                                      "mape_pct", "n_train", "n_eval"), path)
    return FS.read_metrics(spark, path)


def _invariants(name: str, kind: str, fold: str, holds) -> None:
    """Per-row checks of the fitted models: SQL has the rows that must be there, each with ``true``."""
    expected = {"eval": f"select source, area, category, ds from s where ds >= date '{CUTOFF}'",
                "fitted": "select source, area, category, ds from s",
                "future": "select source, area, category, ds from frame where fold = 'future'"}[kind]
    sql = _with_naive(f"""
        select e.*, true as holds from ({expected}) e
        join (select source, area, category, count(*) filter (where fold = 'train') as a, count(*) filter (where fold = 'eval') as b
              from frame group by all) n
          on e.source = n.source and e.area = n.area and e.category = n.category where {fold}""")
    register(name, sql)(lambda spark, sf: _fc(spark, sf).where(F.col("kind") == kind).select(
        *FC.SERIES_KEY, "ds", holds().alias("holds")))


def _band():
    return (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))


def _parts():
    return F.abs(F.col("trend") + F.col("yearly") - F.col("yhat")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs("yhat"))


_invariants("f03_eval_rows_hold", "eval", "a >= 2 and b >= 1", _band)
_invariants("f06_future_rows_hold", "future", "a + b >= 2", lambda: _band() & _parts())
_invariants("f13_fitted_parts_hold", "fitted", "a + b >= 2", _parts)

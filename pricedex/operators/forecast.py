"""Forecasting over all series at once.

Every step is declared in DataFrame operations: the modelling series (F01), the temporal split (F02), the future frame
(F05), the fits (``additive``, ``monthly``), the metrics (F09), the ranking (F12) and every join. What is gathered per
(source, area, category) series is bounded by its number of months, whatever the size of the input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricedex import reference_data as R
from pricedex.functions.columns import half_even, slug
from pricedex.operators import additive, monthly
from pricedex.sources.store import written

SERIES_KEY = ["source", "area", "category"]
DEFAULT_CUTOFF = "2000-09-01"

FORECAST_SCHEMA = ("source string, area string, category string, model string, kind string, ds date, y double, "
                   "yhat double, yhat_lower double, yhat_upper double, trend double, yearly double, n_train int")


def modelling_series(unified: DataFrame, source: str = "INSEE") -> DataFrame:
    """(source, area, category, ds, y) of one source, y as double."""
    return unified.where(F.col("source") == source).select(
        *SERIES_KEY, F.col("obs_date").alias("ds"), F.col("value").cast("double").alias("y"))


def with_split(series: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """fold = 'train' before the cutoff, 'eval' from it."""
    return series.withColumn("fold", F.when(F.col("ds") < F.lit(cutoff).cast("date"), F.lit("train"))
                             .otherwise(F.lit("eval")))


def future_frame(series: DataFrame, horizon: int = 12) -> DataFrame:
    """F05 + F08: the ``horizon`` month starts after each series' last date (horizon within 1..36)."""
    check_horizon(horizon)
    last = series.groupBy(*SERIES_KEY).agg(F.max("ds").alias("last_ds"))
    months = F.sequence(F.add_months("last_ds", 1), F.add_months("last_ds", horizon), F.expr("interval 1 month"))
    return last.select(*SERIES_KEY, F.explode(months).alias("ds"))


def check_horizon(horizon: int) -> None:
    if not 1 <= int(horizon) <= 36:
        raise ValueError("horizon must be between 1 and 36 months")


FIT_KEY = [*SERIES_KEY, "fit"]
MODELS = ("additive", "holt_winters", "arima_2_1_2")


def observations(series: DataFrame, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """What each fit learns from, and the rows it predicts.

    Fit ``eval`` sees the months before the cutoff and predicts those from it on (two months to learn from and one to
    predict at least); fit ``prod`` sees all months (at least two). Observations: FIT_KEY, ds, t (day number), q (value in
    units of the fourth decimal). Rows: FIT_KEY, kind, ds, y, n_train.
    """
    split = with_split(series, cutoff)
    train = F.col("fold") == "train"
    n = split.groupBy(*SERIES_KEY).agg(F.count_if(train).cast("int").alias("n_train"), F.count("*").alias("n"))
    rows = written(split.join(n, SERIES_KEY), "split-series")
    honest = (F.col("n_train") >= 2) & (F.col("n") > F.col("n_train"))
    both = (F.col("n") >= 2)
    fits = F.array_compact(F.array(F.when(train & honest, F.lit("eval")), F.when(both, F.lit("prod"))))
    q = F.round(F.col("y") * additive.UNITS).cast("long")
    obs = rows.withColumn("fit", F.explode(fits)).select(*FIT_KEY, "ds", F.unix_date("ds").alias("t"), q.alias("q"))
    kinds = F.array_compact(F.array(F.when(~train & honest, F.struct(F.lit("eval").alias("fit"), F.lit("eval").alias("kind"))),
                                    F.when(both, F.struct(F.lit("prod").alias("fit"), F.lit("fitted").alias("kind")))))
    targets = rows.withColumn("as", F.explode(kinds)).select(*SERIES_KEY, "as.fit", "as.kind", "ds", "y", "n_train")
    return written(obs, "fit-observations"), targets


def future_rows(rows: DataFrame, horizon: int) -> DataFrame:
    """The future frame in the columns of the predicted rows."""
    known = rows.where(F.col("kind") == "fitted")
    n = known.groupBy(*SERIES_KEY).agg(F.max("n_train").alias("n_train"))
    return future_frame(known, horizon).join(n, SERIES_KEY).select(
        *SERIES_KEY, F.lit("prod").alias("fit"), F.lit("future").alias("kind"), "ds", F.lit(None).cast("double").alias("y"), "n_train")


def _additive(obs: DataFrame, targets: DataFrame) -> DataFrame:
    fits = written(additive.fit(obs, FIT_KEY), "additive-fits")
    last = obs.groupBy(*FIT_KEY).agg(F.max("ds").alias("last_ds"))
    ahead = targets.join(last, FIT_KEY).withColumn("h", F.when(F.col("kind") != "fitted", F.greatest(
        monthly.month_number("ds") - monthly.month_number("last_ds"), F.lit(1))))
    furthest = ahead.groupBy(*FIT_KEY, "last_ds").agg(F.max("h").alias("furthest")).where("furthest > 0")
    steps = furthest.withColumn("h", F.explode(F.sequence(F.lit(1), F.col("furthest")))).select(
        *FIT_KEY, "h", F.unix_date(F.add_months("last_ds", F.col("h"))).alias("t"),
        F.unix_date(F.add_months("last_ds", F.col("h") - 1)).alias("t_before"))
    band = additive.sampled_band(steps, fits, FIT_KEY)
    within = F.lit(additive.Z80) * F.col("sigma") * (F.col("top") / F.lit(float(additive.UNITS)))
    found = additive.parts(ahead.withColumn("t", F.unix_date("ds")), fits, FIT_KEY).join(
        fits.select(*FIT_KEY, within.alias("within")), FIT_KEY).join(band, [*FIT_KEY, "h"], "left")
    yhat, shown = F.col("trend") + F.col("yearly"), F.col("kind") != "eval"
    return found.select(
        *SERIES_KEY, F.lit("additive").alias("model"), "kind", "ds", "y", yhat.alias("yhat"),
        (yhat + F.coalesce(F.col("low"), -F.col("within"))).alias("yhat_lower"),
        (yhat + F.coalesce(F.col("high"), F.col("within"))).alias("yhat_upper"),
        F.when(shown, F.col("trend")).alias("trend"), F.when(shown, F.col("yearly")).alias("yearly"), "n_train")


def _monthly(name: str, predicted: DataFrame) -> DataFrame:
    none = F.lit(None).cast("double")
    return predicted.select(
        *SERIES_KEY, F.lit(name).alias("model"), "kind", "ds", "y", "yhat", (F.col("yhat") - F.col("band")).alias("yhat_lower"),
        (F.col("yhat") + F.col("band")).alias("yhat_upper"), none.alias("trend"), none.alias("yearly"), "n_train")


def monthly_fits(obs: DataFrame, model: str) -> DataFrame:
    """the fitted models of the monthly families, one row per series and fit."""
    fit = {"holt_winters": monthly.holt_winters, "arima_2_1_2": monthly.arima}[model]
    return written(fit(written(monthly.monthly(obs, FIT_KEY), "monthly-series"), FIT_KEY), f"{model}-fits")


def forecast(series: DataFrame, cutoff: str = DEFAULT_CUTOFF, horizon: int = 12,
             models: tuple[str, ...] = ("additive",)) -> DataFrame:
    """every series fitted by every model; rows of kind 'eval' (hold-out predictions of
    the model fitted before the cutoff), 'fitted' (additive model on all history, with trend and yearly parts) and
    'future' (model of all history on the future frame)."""
    obs, rows = observations(series, cutoff)
    targets = written(rows.unionByName(future_rows(rows, horizon)), "predicted-rows")
    ahead = targets.where(F.col("kind") != "fitted")
    found = []
    for name in models:
        if name == "additive":
            found.append(_additive(obs, targets))
        else:
            predict = {"holt_winters": monthly.holt_winters_forecast, "arima_2_1_2": monthly.arima_forecast}[name]
            found.append(_monthly(name, predict(ahead, monthly_fits(obs, name), FIT_KEY)))
    return reduce(DataFrame.unionByName, found).select(*[f.split()[0] for f in FORECAST_SCHEMA.split(", ")])


def seasonal_naive(series: DataFrame, cutoff: str = DEFAULT_CUTOFF, horizon: int = 12) -> DataFrame:
    """The baseline every model has to beat, in the rows of ``forecast``: a month is predicted by the same month one
    year before. Held-out months see training months only; the band is the largest yearly change the series has had
    before the predicted period. DataFrame operations only."""
    split = with_split(series, cutoff)
    before = series.select(*SERIES_KEY, F.add_months("ds", 12).alias("ds"), F.col("y").alias("yhat"), F.col("ds").alias("_from"))
    future = future_frame(series, horizon).select(*SERIES_KEY, "ds", F.lit(None).cast("double").alias("y"),
                                                  F.lit("future").alias("fold"))
    rows = split.select(*SERIES_KEY, "ds", "y", "fold").unionByName(future).join(before, [*SERIES_KEY, "ds"], "left")
    step = F.abs(F.col("y") - F.col("yhat"))
    bands = rows.groupBy(*SERIES_KEY).agg(
        F.max(F.when(F.col("fold") == "train", step)).alias("_eval_band"), F.max(step).alias("_future_band"),
        F.count_if(F.col("fold") == "train").cast("int").alias("n_train"))
    honest = (F.col("fold") == "future") | ((F.col("fold") == "eval") & (F.col("_from") < F.lit(cutoff).cast("date")))
    band = F.coalesce(F.when(F.col("fold") == "eval", F.col("_eval_band")).otherwise(F.col("_future_band")), F.lit(0.0))
    none = F.lit(None).cast("double")
    return rows.where(honest & F.col("yhat").isNotNull()).join(bands, SERIES_KEY).select(
        *SERIES_KEY, F.lit("seasonal_naive").alias("model"), F.col("fold").alias("kind"), "ds", "y", "yhat",
        (F.col("yhat") - band).alias("yhat_lower"), (F.col("yhat") + band).alias("yhat_upper"),
        none.alias("trend"), none.alias("yearly"), "n_train")


def metrics(fc: DataFrame, by=("source", "area", "category", "model")) -> DataFrame:
    """F09 (+J08: actual and predicted are aligned by date on the same row): MAE, RMSE (4 dp), MAPE % (2 dp, zero
    guard), n_train, n_eval. Rounding is half-even, as in the reference."""
    e = fc.where(F.col("kind") == "eval").withColumn("err", F.col("y") - F.col("yhat"))
    denom = F.when(F.col("y") != 0, F.col("y")).otherwise(F.lit(1.0))
    return e.groupBy(*by).agg(
        half_even(F.avg(F.abs("err")), 4).alias("mae"),
        half_even(F.sqrt(F.avg(F.col("err") * F.col("err"))), 4).alias("rmse"),
        half_even(F.avg(F.abs(F.col("err") / denom)) * 100, 2).alias("mape_pct"),
        F.max("n_train").alias("n_train"), F.count(F.lit(1)).alias("n_eval"))


def benchmark(fc: DataFrame) -> DataFrame:
    """metrics per (series, model), models ranked by MAE within each series (ties: model name)."""
    m = metrics(fc)
    w = Window.partitionBy("source", "area", "category").orderBy("mae", "model")
    return m.withColumn("rank", F.row_number().over(w))


def quality_summary(m: DataFrame) -> DataFrame:
    """Median MAE and MAPE, best and worst series by MAE (ties: smallest key)."""
    key = F.concat_ws(" / ", "area", "category")
    return m.agg(
        F.percentile("mae", 0.5).alias("median_mae"), F.percentile("mape_pct", 0.5).alias("median_mape_pct"),
        F.min_by(key, F.struct("mae", key)).alias("best_series"), F.min("mae").alias("best_mae"),
        F.min_by(key, F.struct(-F.col("mae"), key)).alias("worst_series"),
        F.max("mae").alias("worst_mae"), F.count(F.lit(1)).alias("n_series"))


def quality_mean(m: DataFrame) -> DataFrame:
    """Detail rows plus one mean row (series key 'mean')."""
    mean = m.agg(F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"), F.avg("mape_pct").alias("mape_pct")).select(
        F.lit("mean").alias("area"), F.lit("mean").alias("category"), "mae", "rmse", "mape_pct")
    return m.select("area", "category", "mae", "rmse", "mape_pct").unionByName(mean)


def reliability(m: DataFrame, threshold: float = 5.0) -> DataFrame:
    """F20 (+M09): ok when MAE <= threshold, else unreliable; bands at 1 / 2 / 5; the alert flag of MAE > 5."""
    band = (F.when(F.col("mae") <= 1, F.lit("excellent")).when(F.col("mae") <= 2, F.lit("good"))
            .when(F.col("mae") <= 5, F.lit("fair")).otherwise(F.lit("poor")))
    return m.select("source", "area", "category", "model", "mae",
                    F.when(F.col("mae") <= threshold, F.lit("ok")).otherwise(F.lit("unreliable")).alias("status"),
                    band.alias("band"), (F.col("mae") > threshold).alias("alert"))


def total_change(fc: DataFrame, model: str = "additive") -> DataFrame:
    """F16: last minus first predicted value over the future horizon, 4 dp."""
    f = fc.where((F.col("kind") == "future") & (F.col("model") == model))
    return f.groupBy(*SERIES_KEY).agg(
        F.bround(F.max_by("yhat", "ds") - F.min_by("yhat", "ds"), 4).alias("total_change"),
        F.count(F.lit(1)).alias("horizon"))


def overlay(series: DataFrame, fc: DataFrame, model: str = "additive") -> DataFrame:
    """History, fitted and future on one time axis (full outer join on series and date), with a kind column
    split at each series' last known date."""
    f = fc.where((F.col("model") == model) & F.col("kind").isin("fitted", "future")).select(
        *SERIES_KEY, "ds", "yhat", "yhat_lower", "yhat_upper")
    last = series.groupBy(*SERIES_KEY).agg(F.max("ds").alias("_last"))
    j = series.select(*SERIES_KEY, "ds", "y").join(f, SERIES_KEY + ["ds"], "full_outer").join(last, SERIES_KEY, "left")
    known = F.coalesce(F.col("ds") <= F.col("_last"), F.lit(False))
    return j.withColumn("kind", F.when(known, F.lit("history")).otherwise(F.lit("forecast"))).drop("_last")


def resolve_categories(categories: DataFrame, names: list[str]) -> DataFrame:
    """per name an exact match first, else a unique prefix; none -> 'not_found', several -> 'ambiguous'. One scan."""
    c, query = F.col("category"), F.col("query")
    pairs = categories.select("category").distinct().select("category", F.explode(F.array(*map(F.lit, names))).alias("query"))
    exact, prefix = c == query, F.startswith(c, query)
    found = pairs.groupBy("query").agg(
        F.max(exact).alias("_exact"), F.count_if(prefix).alias("n_candidates"),
        F.max(F.when(prefix, c)).alias("_prefix"))
    asked = R.literal_table(categories.sparkSession, [(n,) for n in names], ["query"])
    n = F.coalesce(F.col("n_candidates"), F.lit(0))
    is_exact = F.coalesce(F.col("_exact"), F.lit(False))
    status = (F.when(is_exact, F.lit("exact")).when(n == 1, F.lit("prefix")).when(n > 1, F.lit("ambiguous"))
              .otherwise(F.lit("not_found")))
    category = F.when(is_exact, query).when(n == 1, F.col("_prefix"))
    return asked.join(found, "query", "left").select("query", status.alias("status"), category.alias("category"),
                                                     n.alias("n_candidates"))


def category_slugs(categories: DataFrame) -> DataFrame:
    """F15."""
    return categories.select("category").distinct().select("category", slug("category").alias("slug"))


def modelled_categories(m: DataFrame) -> DataFrame:
    """F21."""
    return m.select("category").distinct()

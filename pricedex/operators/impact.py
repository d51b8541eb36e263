"""Household-budget impact of index changes (F17-F19, J10). Python's round() is half-even: ``bround``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricedex import reference_data as R
from pricedex.functions.columns import half_up_mean, index_filters
from pricedex.operators.forecast import SERIES_KEY, check_horizon


def budget_simulation(series: DataFrame, fc: DataFrame, amount: float, horizon: int,
                      model: str = "additive") -> DataFrame:
    """F17 + F18 per series: budget in ``horizon`` months = amount x predicted / current (with the 80 % band),
    the change, the monthly impact rounded first and the cumulative impact over the horizon."""
    check_horizon(horizon)
    current = series.groupBy(*SERIES_KEY).agg(F.max_by("y", "ds").alias("current"),
                                              F.max("ds").alias("current_date"))
    fut = fc.where((F.col("kind") == "future") & (F.col("model") == model))
    step = F.row_number().over(Window.partitionBy(*SERIES_KEY).orderBy("ds"))  # <= 36 rows per series
    at_h = fut.withColumn("step", step).where(F.col("step") == horizon).select(
        *SERIES_KEY, F.col("ds").alias("target_date"), "yhat", "yhat_lower", "yhat_upper")
    j = current.join(at_h, SERIES_KEY)
    amt = F.lit(float(amount))
    future_budget = F.bround(amt * (F.col("yhat") / F.col("current")), 0)
    monthly = F.bround(amt * ((F.col("yhat") - F.col("current")) / F.col("current")), 0)
    return j.select(
        *SERIES_KEY, "current_date", "target_date", F.col("current").alias("current_index"),
        F.col("yhat").alias("predicted_index"),
        future_budget.alias("future_budget"),
        F.bround(amt * (F.col("yhat_lower") / F.col("current")), 0).alias("future_budget_min"),
        F.bround(amt * (F.col("yhat_upper") / F.col("current")), 0).alias("future_budget_max"),
        (future_budget - F.bround(amt, 0)).alias("delta"),
        ((F.col("yhat") - F.col("current")) / F.col("current") * 100).alias("change_pct"),
        monthly.alias("monthly_impact"), (monthly * horizon).alias("cumulative_impact"))


def inflation_in_euros(unified: DataFrame, source="INSEE", category="00", first_year: int = 1997,
                       budgets=None) -> DataFrame:
    """F19 (+A17, J10): yearly means of the overall index, from the first year >= ``first_year`` to the last year;
    each budget scaled by the ratio. The budgets are exploded from a literal array on the single ratio row (no join)."""
    budgets = budgets or R.BUDGETS
    df = unified.where(index_filters(source, category))
    yearly = df.groupBy(F.year("obs_date").alias("year")).agg(half_up_mean("value", 2).cast("double").alias("m"))
    span = yearly.agg(
        F.min_by("m", F.when(F.col("year") >= first_year, F.col("year"))).alias("start"),
        F.min(F.when(F.col("year") >= first_year, F.col("year"))).alias("ref_year"),
        F.max_by("m", "year").alias("end"), F.max("year").alias("cur_year"))
    ratio = F.col("end") / F.col("start")
    rows = span.where(F.col("start").isNotNull()).select(
        "ref_year", "cur_year", F.col("start").alias("index_start"), F.col("end").alias("index_end"),
        F.explode(F.array(*[F.lit(int(b)) for b in budgets])).alias("budget"), ratio.alias("_r"))
    now = F.bround(F.col("budget") * F.col("_r"), 0).cast("bigint")
    return rows.select("ref_year", "cur_year", "index_start", "index_end", "budget", now.alias("budget_now"),
                       (now - F.col("budget")).alias("monthly_increase"),
                       ((now - F.col("budget")) * 12).alias("annual_increase"))

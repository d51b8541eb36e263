"""Window and time-series operators (W01-W06) and same-date alignments.

Every window is partitioned by the series key (area, category[, source]); partitions hold one series of monthly
points, so their size is bounded by the number of months, whatever the size of the raw input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricedex.functions.columns import index_filters

SERIES = ["source", "area", "category"]


def _series_window(order="obs_date"):
    return Window.partitionBy(*SERIES).orderBy(order)


def moving_average(unified: DataFrame, source="INSEE", date_from=None, date_to=None, months=12) -> DataFrame:
    """Mean of the current and previous ``months - 1`` rows (partial at the start), rounded half-up to 2.

    Computed after the WHERE clause, as in SQL. Sum and count are exact (decimal), so the rounding is exact.
    """
    df = unified.where(index_filters(source, None, date_from, date_to))
    w = _series_window().rowsBetween(-(months - 1), 0)
    mean = F.round(F.sum("value").over(w) / F.count("value").over(w), 2)
    return df.select("obs_date", "area", "category", F.col("value").cast("double").alias("value"),
                     mean.cast("double").alias("moving_avg_12"))


def year_over_year(unified: DataFrame, source="EUROSTAT", category=None, lag_rows=12) -> DataFrame:
    """W02 + W06: value minus the value 12 rows earlier (rows without one are dropped) and its sign class."""
    df = unified.where(index_filters(source, category))
    yoy = F.col("value") - F.lag("value", lag_rows).over(_series_window())
    out = df.select("obs_date", "area", "category", yoy.alias("yoy")).where(F.col("yoy").isNotNull())
    return out.select("obs_date", "area", "category", F.col("yoy").cast("double").alias("yoy"),
                      F.when(F.col("yoy") < 0, F.lit("down")).otherwise(F.lit("up")).alias("direction"))


def year_over_year_calendar(unified: DataFrame, source="EUROSTAT", category=None) -> DataFrame:
    """W02, calendar-true variant: the value of the same month one year earlier (equi-join on the shifted date).

    Equal to the row-based form on gap-free series; correct when months are missing.
    """
    df = unified.where(index_filters(source, category)).select(*SERIES, "obs_date", "value")
    prev = df.select(*SERIES, F.add_months("obs_date", 12).alias("obs_date"), F.col("value").alias("prev"))
    j = df.join(prev, SERIES + ["obs_date"])
    yoy = F.col("value") - F.col("prev")
    return j.select("obs_date", "area", "category", yoy.cast("double").alias("yoy"),
                    F.when(yoy < 0, F.lit("down")).otherwise(F.lit("up")).alias("direction"))


def month_over_month(unified: DataFrame, source="EUROSTAT", category=None) -> DataFrame:
    """(v / previous v - 1) * 100 in double precision."""
    df = unified.where(index_filters(source, category))
    v = F.col("value").cast("double")
    prev = F.lag(v, 1).over(_series_window())
    pct = (v / prev - 1) * 100
    return df.select("obs_date", "area", "category", pct.alias("mom_pct")).where(F.col("mom_pct").isNotNull())


def category_vs_overall(unified: DataFrame, code: str, source="EUROSTAT", overall_code="00") -> DataFrame:
    """One category beside the overall index on the same dates (conditional aggregation, one shuffle)."""
    c2 = F.substring("category", 1, 2)
    df = unified.where((F.col("source") == source) & c2.isin(code, overall_code))
    return df.groupBy("area", "obs_date").agg(
        F.max(F.when(c2 == code, F.col("value"))).cast("double").alias("category_value"),
        F.max(F.when(c2 == overall_code, F.col("value"))).cast("double").alias("overall_value"))


def source_gap(unified: DataFrame, left="INSEE", right="ECB") -> DataFrame:
    """Left join of two sources on (date, area, category) with the absolute gap."""
    a = unified.where(F.col("source") == left).select("obs_date", "area", "category", F.col("value").alias("a"))
    b = unified.where(F.col("source") == right).select("obs_date", "area", "category", F.col("value").alias("b"))
    j = a.join(b, ["obs_date", "area", "category"], "left")
    return j.select("obs_date", "area", "category", F.col("a").cast("double").alias("left_value"),
                    F.col("b").cast("double").alias("right_value"), F.abs(F.col("a") - F.col("b")).cast("double")
                    .alias("abs_gap"))

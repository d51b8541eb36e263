"""Analytical queries over the unified index table and the price table.

Every function is ``(df, **params) -> DataFrame``; they only compose DataFrame operations. Inputs are already
monthly aggregates (bounded by months × areas × categories × sources), so the few operations that need a single
ordering (global max, ranks on a top-N) run on aggregated results of bounded size, never on raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricedex.functions.columns import half_up_mean, ilike_contains, index_filters


def _dbl(c):
    return c.cast("double")


def _round2(c):
    return F.round(c, 2).cast("double")


# ---------------------------------------------------------------------------------------------- A01-A06
def yearly_mean(unified: DataFrame, source="EUROSTAT", date_from=None, date_to=None) -> DataFrame:
    """Mean level per calendar year and number of distinct categories."""
    df = unified.where(index_filters(source, None, date_from, date_to))
    return df.groupBy(F.year("obs_date").alias("year")).agg(
        _dbl(half_up_mean("value", 2)).alias("mean_level"),
        F.count_distinct("category").alias("n_categories"))


def peak_year(unified: DataFrame, source="EUROSTAT") -> DataFrame:
    """The year(s) whose maximum equals the overall maximum of the source (uncorrelated scalar subquery)."""
    df = unified.where(F.col("source") == source)
    overall = df.select(F.max("value")).scalar()
    return df.groupBy(F.year("obs_date").alias("year")).agg(F.max("value").alias("_mx")).where(
        F.col("_mx") == overall).select("year", _round2(F.col("_mx")).alias("max_level"))


def top_categories(unified: DataFrame, source="EUROSTAT", date_from=None, date_to=None, n=10,
                   with_rank=False) -> DataFrame:
    """Categories ranked by mean level (ties broken by category), first ``n``.

    A11 validates n in [1, 13] and adds the rank 1..n (W04) on the already-limited result.
    """
    df = unified.where(index_filters(source, None, date_from, date_to))
    agg = df.groupBy("category").agg(
        half_up_mean("value", 2).alias("_mean"), F.max("value").alias("_mx"), F.count(F.lit(1)).alias("n_obs"))
    top = agg.orderBy(F.desc("_mean"), F.asc("category")).limit(n)
    out = top.select("category", _dbl(F.col("_mean")).alias("mean_level"), _round2(F.col("_mx")).alias("peak"),
                     "n_obs")
    if with_rank:
        # the input of this window holds at most n (<= 13) rows
        out = out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_level"), F.asc("category"))))
    return out


def top_n_categories(unified: DataFrame, source="EUROSTAT", date_from=None, date_to=None, n=5) -> DataFrame:
    """The top-N endpoint; N must be within 1..13."""
    if not 1 <= int(n) <= 13:
        raise ValueError("n must be between 1 and 13")
    return top_categories(unified, source, date_from, date_to, n, with_rank=True)


def two_area_pivot(six_digit_raw: DataFrame, area_a: str, area_b: str, code="000000",
                   date_from="1996-01-01", date_to="2000-12-31") -> DataFrame:
    """One row per month, one column per area (explicit pivot values: no extra distinct job).

    Dates are compared as dates (the reference compares 'YYYY-MM' text with a full date and drops the first month).
    """
    from pricedex.functions.columns import period_to_date

    d = period_to_date("time_period")
    df = six_digit_raw.where(F.col("ref_area").isin(area_a, area_b) & (F.col("coicop") == code)
                             & d.between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))
    return df.groupBy(d.alias("obs_date")).agg(
        _dbl(F.max(F.when(F.col("ref_area") == area_a, F.col("obs_value")))).alias("value_a"),
        _dbl(F.max(F.when(F.col("ref_area") == area_b, F.col("obs_value")))).alias("value_b"))


def volatility(unified: DataFrame, source="EUROSTAT", date_from=None, date_to=None) -> DataFrame:
    """Mean, sample standard deviation, min, max per category."""
    df = unified.where(index_filters(source, None, date_from, date_to))
    return df.groupBy("category").agg(
        _dbl(half_up_mean("value", 2)).alias("mean_level"),
        F.round(F.stddev_samp(F.col("value").cast("double")), 2).alias("stddev"),
        _round2(F.min("value")).alias("min_level"),
        _round2(F.max("value")).alias("max_level"))


def months_above(unified: DataFrame, source="EUROSTAT", threshold=2300) -> DataFrame:
    """Per category, number of months whose mean (over areas) exceeds ``threshold``, and the peak monthly mean.

    ``mean > t`` is evaluated as ``sum > t * count`` so the test is exact.
    """
    df = unified.where(F.col("source") == source)
    monthly = df.groupBy("category", "obs_date").agg(
        half_up_mean("value", 2).alias("monthly_mean"),
        (F.sum("value") > F.lit(threshold) * F.count("value")).alias("above"))
    return monthly.groupBy("category").agg(
        F.count_if("above").alias("n_months_above"), _dbl(F.max("monthly_mean")).alias("peak_monthly_mean"))


# ---------------------------------------------------------------------------------------------- A07-A16
def coverage_by_source(unified: DataFrame) -> DataFrame:
    """A07."""
    return unified.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"),
        F.count_distinct("category").alias("n_categories"))


def coverage_by_source_base(unified: DataFrame) -> DataFrame:
    """A08."""
    return unified.groupBy("source", "base_ref").agg(
        F.count(F.lit(1)).alias("n_obs"), F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"),
        F.count_distinct("category").alias("n_categories"))


def load_audit(unified: DataFrame) -> DataFrame:
    """Rows and date span per source plus the grand total, in one pass (rollup)."""
    return unified.rollup("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"))


def monthly_trend(unified: DataFrame, source="EUROSTAT", category=None, date_from=None, date_to=None) -> DataFrame:
    """A10: mean level per month (4 decimals) and distinct categories."""
    df = unified.where(index_filters(source, category, date_from, date_to))
    return df.groupBy(F.col("obs_date").alias("month")).agg(
        _dbl(half_up_mean("value", 4)).alias("mean_level"), F.count_distinct("category").alias("n_categories"))


def source_comparison(unified: DataFrame, category: str, date_from=None, date_to=None) -> DataFrame:
    """One row per (source, base) for the categories matching a pattern."""
    df = unified.where(index_filters(None, category, date_from, date_to))
    return df.groupBy("source", "base_ref").agg(
        _dbl(half_up_mean("value", 2)).alias("mean_level"), _round2(F.min("value")).alias("min_level"),
        _round2(F.max("value")).alias("max_level"), F.count(F.lit(1)).alias("n_obs"),
        F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"))


def summary(unified: DataFrame, latest_source="INSEE", overall="ensemble", excluded="hors") -> DataFrame:
    """KPI rows — one per (source, base), a grand total, and the latest value of the overall index.

    Rows are told apart by ``kind`` ('source' | 'total' | 'latest'); one pass for the counts (grouping sets) and one
    combinable aggregate (max_by over a (date, area) key: latest date, then the greatest area) for the latest value.
    """
    counts = unified.groupingSets([[F.col("source"), F.col("base_ref")], []], "source", "base_ref").agg(
        F.count(F.lit(1)).alias("n_obs"), F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"),
        F.grouping_id().alias("_g"))
    counts = counts.select(
        F.when(F.col("_g") == 0, F.lit("source")).otherwise(F.lit("total")).alias("kind"),
        "source", "base_ref", "n_obs", "first_date", "last_date",
        F.lit(None).cast("double").alias("latest_value"))
    overall_rows = unified.where((F.col("source") == latest_source) & ilike_contains("category", overall)
                                 & ~ilike_contains("category", excluded))
    order = F.struct("obs_date", "area")
    latest = overall_rows.agg(
        F.max_by("value", order).alias("_v"), F.max("obs_date").alias("_d"), F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > 0).select(
        F.lit("latest").alias("kind"), F.lit(latest_source).alias("source"), F.lit(None).cast("string").alias("base_ref"),
        F.lit(None).cast("bigint").alias("n_obs"), F.lit(None).cast("date").alias("first_date"),
        F.col("_d").alias("last_date"), _dbl(F.col("_v")).alias("latest_value"))
    return counts.unionByName(latest)


def source_date_range(unified: DataFrame, source: str) -> DataFrame:
    """first/last date and years of one source; an unknown source gives zero rows ('not found')."""
    df = unified.where(F.col("source") == source.upper())
    return df.agg(F.min("obs_date").alias("date_min"), F.max("obs_date").alias("date_max")).where(
        F.col("date_min").isNotNull()).select(
        F.lit(source.upper()).alias("source"), "date_min", "date_max",
        F.year("date_min").alias("year_min"), F.year("date_max").alias("year_max"))


def price_stats(prices: DataFrame, category=None) -> DataFrame:
    """Per price category: mean (2 decimals), min, max, count of non-null prices."""
    df = prices.where(F.col("unit_price").isNotNull())
    if category:
        df = df.where(ilike_contains("category", category))
    return df.groupBy("category").agg(
        _dbl(half_up_mean("unit_price", 2)).alias("mean_price"), _dbl(F.min("unit_price")).alias("min_price"),
        _dbl(F.max("unit_price")).alias("max_price"), F.count(F.lit(1)).alias("n_products"))


def filtered_count(df: DataFrame, predicate) -> DataFrame:
    """Pagination total."""
    return df.where(predicate).agg(F.count(F.lit(1)).alias("total"))


# ---------------------------------------------------------------------------------------------- A17-A24
def yearly_kpis(unified: DataFrame, source="INSEE", category="00") -> DataFrame:
    """Calendar-year mean of one index and the change from the previous year present.

    The lag runs over the yearly result (one row per year), not over observations.
    """
    df = unified.where(index_filters(source, category))
    yearly = df.groupBy(F.year("obs_date").alias("year")).agg(half_up_mean("value", 2).alias("_m"))
    w = Window.orderBy("year")
    return yearly.select("year", _dbl(F.col("_m")).alias("mean_level"),
                         _dbl(F.col("_m") - F.lag("_m").over(w)).alias("delta"))


def descriptive_stats(unified: DataFrame, source="EUROSTAT", category=None) -> DataFrame:
    """Per series (area, category): min, max, mean, sample std, last - first, number of points."""
    df = unified.where(index_filters(source, category))
    return df.groupBy("area", "category").agg(
        _round2(F.min("value")).alias("min_level"), _round2(F.max("value")).alias("max_level"),
        _dbl(half_up_mean("value", 2)).alias("mean_level"),
        F.round(F.stddev_samp(F.col("value").cast("double")), 2).alias("stddev"),
        _dbl(F.max_by("value", "obs_date") - F.min_by("value", "obs_date")).alias("total_change"),
        F.count(F.lit(1)).alias("n_points"))


def series_span(unified: DataFrame, source: str, category: str, area: str) -> DataFrame:
    """Min, max and last - first of one series (zero rows when the series does not exist)."""
    df = unified.where(index_filters(source, category) & (F.col("area") == area))
    return df.agg(_dbl(F.min("value")).alias("min_level"), _dbl(F.max("value")).alias("max_level"),
                  _dbl(F.max_by("value", "obs_date") - F.min_by("value", "obs_date")).alias("total_change"),
                  F.count(F.lit(1)).alias("n_points")).where(F.col("n_points") > 0)


def category_kpis(unified: DataFrame, source="EUROSTAT", category=None) -> DataFrame:
    """Per series: latest value, total change, maximum and the first month reaching it, std."""
    df = unified.where(index_filters(source, category))
    first_max = F.struct((-F.col("value")).alias("nv"), F.col("obs_date").alias("d"))
    return df.groupBy("area", "category").agg(
        _dbl(F.max_by("value", "obs_date")).alias("latest_value"),
        _dbl(F.max_by("value", "obs_date") - F.min_by("value", "obs_date")).alias("total_change"),
        _dbl(F.max("value")).alias("max_level"),
        F.min_by("obs_date", first_max).alias("max_month"),
        F.round(F.stddev_samp(F.col("value").cast("double")), 2).alias("stddev"))


def seasonality_matrix(unified: DataFrame, source="EUROSTAT", category=None) -> DataFrame:
    """Mean level by month and year, in long form: every year that the data have."""
    df = unified.where(index_filters(source, category))
    return df.groupBy(F.month("obs_date").alias("month"), F.year("obs_date").alias("year")).agg(
        _dbl(half_up_mean("value", 4)).alias("mean_level"))


def price_vs_index(prices: DataFrame, unified: DataFrame, source="INSEE", category="alimentation") -> DataFrame:
    """Observed mean shelf price beside the official index mean, as one mixed-unit report."""
    p = prices.where(F.col("unit_price").isNotNull()).agg(
        _dbl(half_up_mean("unit_price", 2)).alias("value"), F.max("collected_on").alias("ref_date")).select(
        F.lit("prices (observed)").alias("source"), F.lit("food").alias("category"), "value",
        F.lit("EUR / product").alias("unit"), "ref_date")
    i = unified.where((F.col("source") == source) & ilike_contains("category", category)).groupBy("category").agg(
        _dbl(half_up_mean("value", 2)).alias("value"), F.max("obs_date").alias("ref_date")).select(
        F.lit(f"{source} (official)").alias("source"), "category", "value", F.lit("index").alias("unit"), "ref_date")
    return p.unionByName(i)


# ---------------------------------------------------------------------------------------------- D, L, Q, U
def distinct_sources(unified: DataFrame, first: str | None = None) -> DataFrame:
    """D01 (and L06: a reference source first, then alphabetical, as a sort key column)."""
    out = unified.select("source").distinct()
    if first:
        out = out.withColumn("sort_key", F.concat((F.col("source") != first).cast("int").cast("string"), "source"))
    return out


def distinct_categories(unified: DataFrame, source=None) -> DataFrame:
    """D02."""
    df = unified.where(F.col("source") == source.upper()) if source else unified
    return df.select("category").distinct()


def distinct_price_categories(prices: DataFrame) -> DataFrame:
    """D03."""
    return prices.select("category").distinct()


def index_page(unified: DataFrame, source=None, category=None, date_from=None, date_to=None,
               limit=100, offset=0) -> DataFrame:
    """Newest first with a total tie-break, then OFFSET/LIMIT (1..1000, >= 0)."""
    if not 1 <= int(limit) <= 1000 or int(offset) < 0:
        raise ValueError("limit must be in 1..1000 and offset >= 0")
    df = unified.where(index_filters(source, category, date_from, date_to))
    ordered = df.orderBy(F.desc("obs_date"), "category", "source", "area")
    return ordered.offset(int(offset)).limit(int(limit)).select(
        "obs_date", "area", "category", _dbl(F.col("value")).alias("value"), "source", "base_ref")


def price_page(prices: DataFrame, category=None, limit=100, offset=0) -> DataFrame:
    """Price listing, newest first (ties: category, product, url)."""
    if not 1 <= int(limit) <= 1000 or int(offset) < 0:
        raise ValueError("limit must be in 1..1000 and offset >= 0")
    df = prices.where(ilike_contains("category", category)) if category else prices
    ordered = df.orderBy(F.desc("collected_on"), "category", "product", "url")
    return ordered.offset(int(offset)).limit(int(limit)).select(
        "product", "category", _dbl(F.col("unit_price")).alias("unit_price"), "collected_on", "url")


def latest_row(unified: DataFrame, source: str, category: str) -> DataFrame:
    """The latest observation of one series pattern without a global sort (max_by)."""
    df = unified.where((F.col("source") == source) & ilike_contains("category", category))
    key = F.struct("obs_date", "area", "category")
    return df.agg(F.max_by(F.struct("obs_date", "area", "category", "value"), key).alias("r")).where(
        F.col("r").isNotNull()).select("r.obs_date", "r.area", "r.category", _dbl(F.col("r.value")).alias("value"))


def two_sources_in_year(unified: DataFrame, year: int, pattern: str, sources=("INSEE", "DATAGOUV")) -> DataFrame:
    """Q02: same category pattern across two sources in one year (OR of ANDs)."""
    cond = None
    for s in sources:
        c = (F.col("source") == s) & ilike_contains("category", pattern)
        cond = c if cond is None else cond | c
    df = unified.where(F.col("obs_date").between(F.lit(f"{year}-01-01").cast("date"),
                                                 F.lit(f"{year}-12-31").cast("date")) & cond)
    return df.select("obs_date", "area", "source", "category", _dbl(F.col("value")).alias("value"))


def one_month_codes(prefixed_raw: DataFrame, month: str, n=20) -> DataFrame:
    """Q03 (+L03): all codes of one month, first ``n`` by code (ties: area)."""
    df = prefixed_raw.where(F.col("obs_date") == F.lit(month).cast("date"))
    return df.orderBy("coicop", "area").limit(n).select(
        "coicop", "area", "obs_date", _dbl(F.col("value")).alias("value"), "unit")


def series_by_label(labelled_raw: DataFrame, pattern: str) -> DataFrame:
    """Q04."""
    return labelled_raw.where(ilike_contains("category", pattern)).select(
        "obs_date", "area", "category", _dbl(F.col("value")).alias("value"), "series_id")


def prices_by_category(prices: DataFrame, pattern: str) -> DataFrame:
    """Q05 (ordered by category, price at the sink)."""
    return prices.where(ilike_contains("category", pattern)).select(
        "product", "category", _dbl(F.col("unit_price")).alias("unit_price"), "collected_on")


def one_area_code(six_digit_raw: DataFrame, area: str, code: str) -> DataFrame:
    """Q06."""
    return six_digit_raw.where((F.col("ref_area") == area) & (F.col("coicop") == code)).select(
        "time_period", F.col("ref_area").alias("area"), "coicop", _dbl(F.col("obs_value")).alias("index_value"))


def two_year_extract(unified: DataFrame, source: str, date_from: str, date_to: str, n=50) -> DataFrame:
    """Q07 (+L03): first ``n`` rows by (date, category) with tie-breaks (area)."""
    df = unified.where(index_filters(source, None, date_from, date_to))
    return df.orderBy("obs_date", "category", "area").limit(n).select(
        "obs_date", "area", "category", _dbl(F.col("value")).alias("value"), "source")


def table_volumes(tables: dict[str, DataFrame]) -> DataFrame:
    """One count per table, UNION ALL. Each count is a partial aggregate over its own scan."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""The named query catalogue: one Spark plan per operator of the inventory, each with its DuckDB oracle SQL.

Every query reads the driver tables (through the stand-ins) in full; no row caps except where the limit is the
feature (top-N, pages, fixed extracts).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricedex.operators import analytics as A
from pricedex.operators import normalise as N
from pricedex.plans import oracle as O
from pricedex.plans import tables as T
from pricedex.sources import standins as S

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def W(body: str, *ctes: str) -> str:
    return O.with_ctes(body, *ctes)


m2 = lambda v: O.mean(v, 2)
m4 = lambda v: O.mean(v, 4)
r2 = O.round2
flt = O.filters

# ================================================================================================ normalisation
UNIFIED_SELECT = "select obs_date, area, category, cast(value as double) as value, source, base_ref from "


def _out(df: DataFrame) -> DataFrame:
    return df.withColumn("value", df["value"].cast("double"))


register("j01_six_digit_normalise", W(UNIFIED_SELECT + "n_ecb", "n_ecb"))(
    lambda spark, sf: _out(N.normalise_six_digit(S.ecb_raw(spark, sf))))
register("j02_labelled_normalise", W(UNIFIED_SELECT + "n_insee", "n_insee"))(
    lambda spark, sf: _out(N.normalise_labelled(S.insee_raw(spark, sf))))
register("j03_dotted_normalise", W(UNIFIED_SELECT + "n_datagouv", "n_datagouv"))(
    lambda spark, sf: _out(N.normalise_dotted(S.datagouv_raw(spark, sf))))
register("j04_prefixed_normalise", W(UNIFIED_SELECT + "n_eurostat", "n_eurostat"))(
    lambda spark, sf: _out(N.normalise_prefixed(S.eurostat_raw(spark, sf))))


@register("j05_first_wins_dedup", W("""
    select obs_date, area, category, cast(value as double) as value, source, base_ref from n_eurostat""", "n_eurostat"))
def _j05(spark, sf):
    """Every key three times: as it is, with a larger value, and in a later base with a smaller value."""
    from pyspark.sql import functions as F
    n = N.normalise_prefixed(S.eurostat_raw(spark, sf))
    larger = n.withColumn("value", (F.col("value") + 1).cast("decimal(18,4)"))
    later = n.withColumn("value", (F.col("value") - 1).cast("decimal(18,4)")).withColumn("base_ref", F.lit("2025"))
    return _out(N.unify(later, larger, n))


@register("j06_series_label_lookup", W(f"""
    select obs_date, area, i.series_id, coalesce(d.label, i.category) as label
    from (select obs_date, area, category,
                 case when sub_category = category then s.series_id else 'X' || substring(category, 15) end
                   as series_id
          from insee_raw left join (select series_id, substring(label, 1, 2) as code from series_dim
                                    where regexp_full_match(substring(label, 1, 2), '[0-9]{{2}}')) s
               on s.code = substring(insee_raw.category, 1, 2)) i
    left join series_dim d on d.series_id = i.series_id""", "insee_raw", "series_dim"))
def _j06(spark, sf):
    from pyspark.sql import functions as F
    from pricedex import reference_data as R
    raw = S.insee_raw(spark, sf)
    ids = R.literal_table(spark, [(lbl[:2], sid) for sid, lbl in R.SERIES_LABELS if lbl[:2].isdigit()],
                          ["code", "_sid"])
    keyed = raw.join(F.broadcast(ids), F.substring(raw["category"], 1, 2) == ids["code"], "left").select(
        "obs_date", "area", "category",
        F.when(F.col("sub_category") == F.col("category"), F.col("_sid"))
        .otherwise(F.concat(F.lit("X"), F.substring("category", 15, 1000))).alias("series_id"),
        F.col("category").alias("title"))
    out = N.label_series(keyed, "series_id", "title")
    return out.select("obs_date", "area", "series_id", F.col("category").alias("label"))


register("u03_unified", W(UNIFIED_SELECT + "unified", "unified"))(lambda spark, sf: _out(T.unified_plan(spark, sf)))

register("a09_load_audit", W("""
    select source, count(*) as n_rows, min(obs_date) as first_date, max(obs_date) as last_date
    from unified group by rollup (source)""", "unified"))(lambda spark, sf: A.load_audit(T.unified(spark, sf)))

# ================================================================================================ aggregations
register("a01_yearly_mean", W(f"""
    select cast(extract(year from obs_date) as integer) as year, {m2('value')} as mean_level,
           count(distinct category) as n_categories
    from unified where {flt('EUROSTAT', None, '1996-01-01', '1999-12-31')} group by 1""", "unified"))(
    lambda spark, sf: A.yearly_mean(T.unified(spark, sf), "EUROSTAT", "1996-01-01", "1999-12-31"))

register("a02_peak_year", W(f"""
    select cast(extract(year from obs_date) as integer) as year, {r2('max(value)')} as max_level
    from unified where source = 'EUROSTAT' group by 1
    having max(value) = (select max(value) from unified where source = 'EUROSTAT')""", "unified"))(
    lambda spark, sf: A.peak_year(T.unified(spark, sf), "EUROSTAT"))

register("a03_top10_categories", W(f"""
    select category, {m2('value')} as mean_level, {r2('max(value)')} as peak, count(*) as n_obs
    from unified where {flt('EUROSTAT', None, '1997-01-01', '1998-12-31')}
    group by category order by mean_level desc, category limit 10""", "unified"))(
    lambda spark, sf: A.top_categories(T.unified(spark, sf), "EUROSTAT", "1997-01-01", "1998-12-31", 10))

register("a04_two_area_pivot", W("""
    select try_cast(time_period || '-01' as date) as obs_date,
           cast(max(case when ref_area = 'NATION_0' then obs_value end) as double) as value_a,
           cast(max(case when ref_area = 'NATION_1' then obs_value end) as double) as value_b
    from ecb_raw
    where ref_area in ('NATION_0', 'NATION_1') and coicop = '000000'
      and try_cast(time_period || '-01' as date) between date '1996-01-01' and date '2000-12-31'
    group by 1""", "ecb_raw"))(
    lambda spark, sf: A.two_area_pivot(S.ecb_raw(spark, sf), "NATION_0", "NATION_1", "000000"))

register("a05_volatility", W(f"""
    select category, {m2('value')} as mean_level, round(stddev_samp(cast(value as double)), 2) as stddev,
           {r2('min(value)')} as min_level, {r2('max(value)')} as max_level
    from unified where {flt('EUROSTAT', None, '1996-01-01', '1999-12-31')} group by category""", "unified"))(
    lambda spark, sf: A.volatility(T.unified(spark, sf), "EUROSTAT", "1996-01-01", "1999-12-31"))

register("a06_months_above_threshold", W(f"""
    select category, count(*) filter (where above) as n_months_above, max(monthly_mean) as peak_monthly_mean
    from (select category, obs_date, {m2('value')} as monthly_mean, sum(value) > 2300 * count(value) as above
          from unified where source = 'EUROSTAT' group by category, obs_date)
    group by category""", "unified"))(
    lambda spark, sf: A.months_above(T.unified(spark, sf), "EUROSTAT", 2300))

register("a07_coverage_by_source", W("""
    select source, count(*) as n_rows, min(obs_date) as first_date, max(obs_date) as last_date,
           count(distinct category) as n_categories
    from unified group by source""", "unified"))(lambda spark, sf: A.coverage_by_source(T.unified(spark, sf)))

register("a08_coverage_by_source_base", W("""
    select source, base_ref, count(*) as n_obs, min(obs_date) as first_date, max(obs_date) as last_date,
           count(distinct category) as n_categories
    from unified group by source, base_ref""", "unified"))(
    lambda spark, sf: A.coverage_by_source_base(T.unified(spark, sf)))

register("a10_monthly_trend", W(f"""
    select obs_date as month, {m4('value')} as mean_level, count(distinct category) as n_categories
    from unified where {flt('EUROSTAT')} group by obs_date""", "unified"))(
    lambda spark, sf: A.monthly_trend(T.unified(spark, sf), "eurostat"))

register("a10_monthly_trend_filtered", W(f"""
    select obs_date as month, {m4('value')} as mean_level, count(distinct category) as n_categories
    from unified where {flt('ECB', 'alimentation', '1997-01-01', '2000-06-30')} group by obs_date""", "unified"))(
    lambda spark, sf: A.monthly_trend(T.unified(spark, sf), "ecb", "alimentation", "1997-01-01", "2000-06-30"))

register("a11_top_n_ranked", W(f"""
    select category, mean_level, peak, n_obs,
           cast(row_number() over (order by mean_level desc, category) as integer) as rank
    from (select category, {m2('value')} as mean_level, {r2('max(value)')} as peak, count(*) as n_obs
          from unified where {flt('EUROSTAT', None, '1997-01-01', '1999-12-31')}
          group by category order by mean_level desc, category limit 5)""", "unified"))(
    lambda spark, sf: A.top_n_categories(T.unified(spark, sf), "EUROSTAT", "1997-01-01", "1999-12-31", 5))

register("a12_source_comparison", W(f"""
    select source, base_ref, {m2('value')} as mean_level, {r2('min(value)')} as min_level,
           {r2('max(value)')} as max_level, count(*) as n_obs, min(obs_date) as first_date,
           max(obs_date) as last_date
    from unified where {flt(None, 'alimentation', '1996-01-01', '2000-12-31')}
    group by source, base_ref""", "unified"))(
    lambda spark, sf: A.source_comparison(T.unified(spark, sf), "alimentation", "1996-01-01", "2000-12-31"))

register("a13_summary", W("""
    select case when grouping(source, base_ref) = 0 then 'source' else 'total' end as kind, source, base_ref,
           count(*) as n_obs, min(obs_date) as first_date, max(obs_date) as last_date,
           cast(null as double) as latest_value
    from unified group by grouping sets ((source, base_ref), ())
    union all
    select 'latest', 'INSEE', null, null, null, obs_date, cast(value as double)
    from (select * from unified where source = 'INSEE' and category ilike '%ensemble%'
          and category not ilike '%hors%' order by obs_date desc, area desc limit 1)""", "unified"))(
    lambda spark, sf: A.summary(T.unified(spark, sf)))

register("a14_source_date_range", W("""
    select 'ECB' as source, min(obs_date) as date_min, max(obs_date) as date_max,
           cast(extract(year from min(obs_date)) as integer) as year_min,
           cast(extract(year from max(obs_date)) as integer) as year_max
    from unified where source = 'ECB' having min(obs_date) is not null""", "unified"))(
    lambda spark, sf: A.source_date_range(T.unified(spark, sf), "ecb"))

register("a14_source_date_range_unknown", W("""
    select 'NOPE' as source, min(obs_date) as date_min, max(obs_date) as date_max,
           cast(extract(year from min(obs_date)) as integer) as year_min,
           cast(extract(year from max(obs_date)) as integer) as year_max
    from unified where source = 'NOPE' having min(obs_date) is not null""", "unified"))(
    lambda spark, sf: A.source_date_range(T.unified(spark, sf), "nope"))

register("a15_price_stats", W(f"""
    select category, {m2('unit_price')} as mean_price, cast(min(unit_price) as double) as min_price,
           cast(max(unit_price) as double) as max_price, count(*) as n_products
    from prices where unit_price is not null group by category""", "prices"))(
    lambda spark, sf: A.price_stats(T.prices(spark, sf)))

register("a15_price_stats_pattern", W(f"""
    select category, {m2('unit_price')} as mean_price, cast(min(unit_price) as double) as min_price,
           cast(max(unit_price) as double) as max_price, count(*) as n_products
    from prices where unit_price is not null and category ilike '%o_o%' group by category""", "prices"))(
    lambda spark, sf: A.price_stats(T.prices(spark, sf), "o_o"))


@register("a16_filtered_count", W(f"""
    select count(*) as total from unified where {flt('EUROSTAT', 'boissons', '1996-01-01', None)}""", "unified"))
def _a16(spark, sf):
    from pricedex.functions.columns import index_filters
    return A.filtered_count(T.unified(spark, sf), index_filters("eurostat", "boissons", "1996-01-01"))


register("a17_yearly_kpis", W(f"""
    select year, mean_level,
           cast(mean_level_dec - lag(mean_level_dec) over (order by year) as double) as delta
    from (select cast(extract(year from obs_date) as integer) as year, {m2('value')} as mean_level,
                 cast({m2('value')} as decimal(18,2)) as mean_level_dec
          from unified where {flt('INSEE', '00')} group by 1)""", "unified"))(
    lambda spark, sf: A.yearly_kpis(T.unified(spark, sf), "INSEE", "00"))

register("a18_descriptive_stats", W(f"""
    select area, category, {r2('min(value)')} as min_level, {r2('max(value)')} as max_level,
           {m2('value')} as mean_level, round(stddev_samp(cast(value as double)), 2) as stddev,
           cast(arg_max(value, obs_date) - arg_min(value, obs_date) as double) as total_change,
           count(*) as n_points
    from unified where {flt('EUROSTAT')} group by area, category""", "unified"))(
    lambda spark, sf: A.descriptive_stats(T.unified(spark, sf), "EUROSTAT"))

register("a19_category_kpis", W(f"""
    select area, category, cast(arg_max(value, obs_date) as double) as latest_value,
           cast(arg_max(value, obs_date) - arg_min(value, obs_date) as double) as total_change,
           cast(max(value) as double) as max_level,
           min(obs_date) filter (where value = mx) as max_month,
           round(stddev_samp(cast(value as double)), 2) as stddev
    from (select *, max(value) over (partition by area, category) as mx
          from unified where {flt('DATAGOUV')}) group by area, category""", "unified"))(
    lambda spark, sf: A.category_kpis(T.unified(spark, sf), "DATAGOUV"))

register("a23_series_span", W(f"""
    select cast(min(value) as double) as min_level, cast(max(value) as double) as max_level,
           cast(arg_max(value, obs_date) - arg_min(value, obs_date) as double) as total_change, count(*) as n_points
    from unified where {flt('EUROSTAT', '00')} and area = 'NATION_7' having count(*) > 0""", "unified"))(
    lambda spark, sf: A.series_span(T.unified(spark, sf), "EUROSTAT", "00", "NATION_7"))

register("a20_seasonality_matrix", W(f"""
    select cast(month(obs_date) as integer) as month, cast(year(obs_date) as integer) as year,
           {O.mean('value', 4)} as mean_level
    from unified where {flt('EUROSTAT', 'alimentation')} group by 1, 2""", "unified"))(
    lambda spark, sf: A.seasonality_matrix(T.unified(spark, sf), "EUROSTAT", "alimentation"))

register("a24_price_vs_index", W(f"""
    select 'prices (observed)' as source, 'food' as category, {m2('unit_price')} as value,
           'EUR / product' as unit, max(collected_on) as ref_date
    from prices where unit_price is not null
    union all
    select 'INSEE (official)', category, {m2('value')}, 'index', max(obs_date)
    from unified where source = 'INSEE' and category ilike '%alimentation%' group by category""",
    "prices", "unified"))(lambda spark, sf: A.price_vs_index(T.prices(spark, sf), T.unified(spark, sf)))

# ================================================================================================ distinct / pages
register("d01_distinct_sources", W("""
    select source, cast(cast(source <> 'INSEE' as integer) as varchar) || source as sort_key
    from (select distinct source from unified)""", "unified"))(
    lambda spark, sf: A.distinct_sources(T.unified(spark, sf), first="INSEE"))
register("d02_distinct_categories", W("select distinct category from unified where source = 'INSEE'", "unified"))(
    lambda spark, sf: A.distinct_categories(T.unified(spark, sf), "insee"))
register("d03_distinct_price_categories", W("select distinct category from prices", "prices"))(
    lambda spark, sf: A.distinct_price_categories(T.prices(spark, sf)))

register("l01_index_page", W(f"""
    select obs_date, area, category, cast(value as double) as value, source, base_ref from unified
    where {flt('EUROSTAT', None, '1997-01-01', None)}
    order by obs_date desc, category, source, area limit 100 offset 40""", "unified"))(
    lambda spark, sf: A.index_page(T.unified(spark, sf), "eurostat", None, "1997-01-01", None, 100, 40))

register("l02_price_page", W("""
    select product, category, cast(unit_price as double) as unit_price, collected_on, url from prices
    order by collected_on desc, category, product, url limit 50 offset 10""", "prices"))(
    lambda spark, sf: A.price_page(T.prices(spark, sf), None, 50, 10))

register("l04_latest_row", W("""
    select obs_date, area, category, cast(value as double) as value from unified
    where source = 'DATAGOUV' and category ilike '%ensemble%'
    order by obs_date desc, area desc, category desc limit 1""", "unified"))(
    lambda spark, sf: A.latest_row(T.unified(spark, sf), "DATAGOUV", "ensemble"))

register("q02_two_sources_in_year", W("""
    select obs_date, area, source, category, cast(value as double) as value from unified
    where obs_date between date '1998-01-01' and date '1998-12-31'
      and ((source = 'INSEE' and category ilike '%ensemble%') or (source = 'DATAGOUV' and category ilike '%ensemble%'))""",
    "unified"))(lambda spark, sf: A.two_sources_in_year(T.unified(spark, sf), 1998, "ensemble"))

register("q03_one_month_codes", W("""
    select coicop, area, obs_date, cast(value as double) as value, unit from eurostat_raw
    where obs_date = date '1998-01-01' order by coicop, area limit 20""", "eurostat_raw"))(
    lambda spark, sf: A.one_month_codes(S.eurostat_raw(spark, sf), "1998-01-01", 20))

register("q04_series_by_label", W("""
    select obs_date, area, category, cast(value as double) as value, series_id from insee_raw
    where category ilike '%alimentation%'""", "insee_raw"))(
    lambda spark, sf: A.series_by_label(S.insee_raw(spark, sf), "alimentation"))

register("q05_prices_by_category", W("""
    select product, category, cast(unit_price as double) as unit_price, collected_on from prices
    where category ilike '%promo%'""", "prices"))(
    lambda spark, sf: A.prices_by_category(T.prices(spark, sf), "promo"))

register("q06_one_area_code", W("""
    select time_period, ref_area as area, coicop, cast(obs_value as double) as index_value from ecb_raw
    where ref_area = 'NATION_5' and coicop = '010000'""", "ecb_raw"))(
    lambda spark, sf: A.one_area_code(S.ecb_raw(spark, sf), "NATION_5", "010000"))

register("q07_two_year_extract", W(f"""
    select obs_date, area, category, cast(value as double) as value, source from unified
    where {flt('EUROSTAT', None, '1997-01-01', '1998-12-31')} order by obs_date, category, area limit 50""",
    "unified"))(lambda spark, sf: A.two_year_extract(T.unified(spark, sf), "EUROSTAT", "1997-01-01", "1998-12-31"))

register("u01_table_volumes", W("""
    select 'ecb_raw' as table_name, count(*) as n_rows from ecb_raw
    union all select 'insee_raw', count(*) from insee_raw
    union all select 'datagouv_raw', count(*) from datagouv_raw
    union all select 'prices', count(*) from prices
    union all select 'eurostat_raw', count(*) from eurostat_raw
    union all select 'unified', count(*) from unified""",
    "ecb_raw", "insee_raw", "datagouv_raw", "prices", "eurostat_raw", "unified"))(
    lambda spark, sf: A.table_volumes({
        "ecb_raw": S.ecb_raw(spark, sf), "insee_raw": S.insee_raw(spark, sf),
        "datagouv_raw": S.datagouv_raw(spark, sf), "prices": T.prices(spark, sf),
        "eurostat_raw": S.eurostat_raw(spark, sf), "unified": T.unified(spark, sf)}))

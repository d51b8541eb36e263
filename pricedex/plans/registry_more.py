"""Further registered queries: windows and alignments (W, J07, J11). Sources, forecasting and monitoring are
registered from their own modules, imported at the end."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from pricedex.operators import pages as PG
from pricedex.session import application_id
from pricedex.sources.landing import fresh_path
from pricedex.operators import windows as WN
from pricedex.plans import tables as T
from pricedex.plans.registry import W, flt, register

_SERIES_W = "partition by source, area, category order by obs_date"

register("w01_moving_average_12", W(f"""
    select obs_date, area, category, cast(value as double) as value,
           cast(sign(s) * ((abs(s) * 200 + n * 10000) // (n * 20000)) as double) / 100 as moving_avg_12
    from (select *, sum(cast(value * 10000 as hugeint)) over w as s, count(value) over w as n
          from unified where {flt('INSEE', None, '1996-01-01', '2000-12-31')}
          window w as ({_SERIES_W} rows between 11 preceding and current row))""", "unified"))(
    lambda spark, sf: WN.moving_average(T.unified(spark, sf), "INSEE", "1996-01-01", "2000-12-31"))

register("w02_year_over_year", W(f"""
    select obs_date, area, category, cast(yoy as double) as yoy,
           case when yoy < 0 then 'down' else 'up' end as direction
    from (select obs_date, area, category, value - lag(value, 12) over ({_SERIES_W}) as yoy
          from unified where {flt('EUROSTAT')})
    where yoy is not null""", "unified"))(
    lambda spark, sf: WN.year_over_year(T.unified(spark, sf), "EUROSTAT"))

register("w02_year_over_year_calendar", W(f"""
    select a.obs_date, a.area, a.category, cast(a.value - b.value as double) as yoy,
           case when a.value - b.value < 0 then 'down' else 'up' end as direction
    from (select * from unified where {flt('EUROSTAT')}) a
    join (select * from unified where {flt('EUROSTAT')}) b
      on a.source = b.source and a.area = b.area and a.category = b.category
     and a.obs_date = cast(b.obs_date + interval 12 month as date)""", "unified"))(
    lambda spark, sf: WN.year_over_year_calendar(T.unified(spark, sf), "EUROSTAT"))

register("w03_month_over_month", W(f"""
    select obs_date, area, category, mom_pct
    from (select obs_date, area, category,
                 (cast(value as double) / lag(cast(value as double), 1) over ({_SERIES_W}) - 1) * 100 as mom_pct
          from unified where {flt('ECB')})
    where mom_pct is not null""", "unified"))(
    lambda spark, sf: WN.month_over_month(T.unified(spark, sf), "ECB"))

register("j07_category_vs_overall", W("""
    select area, obs_date,
           cast(max(case when substring(category, 1, 2) = '03' then value end) as double) as category_value,
           cast(max(case when substring(category, 1, 2) = '00' then value end) as double) as overall_value
    from unified where source = 'EUROSTAT' and substring(category, 1, 2) in ('03', '00')
    group by area, obs_date""", "unified"))(
    lambda spark, sf: WN.category_vs_overall(T.unified(spark, sf), "03", "EUROSTAT"))

register("j11_source_gap", W("""
    select a.obs_date, a.area, a.category, cast(a.value as double) as left_value,
           cast(b.value as double) as right_value, cast(abs(a.value - b.value) as double) as abs_gap
    from (select * from unified where source = 'INSEE') a
    left join (select * from unified where source = 'ECB') b
      on a.obs_date = b.obs_date and a.area = b.area and a.category = b.category""", "unified"))(
    lambda spark, sf: WN.source_gap(T.unified(spark, sf), "INSEE", "ECB"))


# ---------------------------------------------------------------------------------------------- pages by key
INDEX_ORDER = [("obs_date", True), ("category", False), ("source", False), ("area", False)]
PRICE_ORDER = [("collected_on", True), ("category", False), ("product", False), ("url", False)]
_LISTINGS: dict[tuple, str] = {}


def _listing(spark, sf, name, rows, order):
    """A listing is written once per application."""
    key = (application_id(spark), name, os.path.abspath(sf))
    if key not in _LISTINGS:
        path = fresh_path(spark, f"listing_{name}")
        PG.write_listing(rows(spark, sf), path, order, files=8)
        _LISTINGS[key] = path
    return _LISTINGS[key]


@register("l01_page_500_by_key", W("""
    select obs_date, area, category, cast(value as double) as value, source, base_ref from unified
    order by obs_date desc, category, source, area limit 20 offset 9980""", "unified"))
def _l01_by_key(spark, sf):
    path = _listing(spark, sf, "index", T.unified, INDEX_ORDER)
    return PG.page(spark, path, INDEX_ORDER, 20, 20 * 499).withColumn("value", F.col("value").cast("double")).select(
        "obs_date", "area", "category", "value", "source", "base_ref")


@register("l02_page_35_by_key", W("""
    select product, category, cast(unit_price as double) as unit_price, collected_on, url from prices
    order by collected_on desc, category, product, url limit 50 offset 1700""", "prices"))
def _l02_by_key(spark, sf):
    path = _listing(spark, sf, "prices", T.prices, PRICE_ORDER)
    return PG.page(spark, path, PRICE_ORDER, 50, 50 * 34).withColumn("unit_price", F.col("unit_price").cast("double")).select(
        "product", "category", "unit_price", "collected_on", "url")


register("a16_total_from_index", W("select count(*) as total from unified", "unified"))(
    lambda spark, sf: PG.total_rows(spark, _listing(spark, sf, "index", T.unified, INDEX_ORDER)))

"""DuckDB SQL for the stand-in tables, used as the independent oracle of every registered query.

Each stand-in is a CTE with the same definition as its Spark counterpart in ``pricedex.sources.standins`` and
``pricedex.operators.normalise``. ``with_ctes(body, *names)`` prefixes a query with the CTEs it needs (and their
dependencies, in order).
"""

from __future__ import annotations

from pricedex import reference_data as R
from pricedex.sources import standins as S


def _part_code_sql() -> str:
    whens = " ".join(f"when '{t}' then '{c}'" for t, c in S.PART_TYPE_CODES)
    return f"case p_type {whens} else '{S.OVERALL_CODE}' end"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ref": ((), f"select * from {R.sql_values(R.COICOP_LEVEL1, ['code', 'label'])}"),
    "series_dim": ((), f"select * from {R.sql_values(R.SERIES_LABELS, ['series_id', 'label'])}"),
    "base_obs": ((), f"""
        select cast(date_trunc('month', o_orderdate) as date) as obs_date, n_name as area,
               case when o_orderpriority in ('{S.PRIO_ECB}', '{S.PRIO_INSEE}', '{S.PRIO_DATAGOUV}') then o_orderpriority
                    else '{S.PRIO_EUROSTAT}' end as prio,
               {_part_code_sql()} as code, p_size % 2 as sub,
               cast(cast((sum(cast(round(l_extendedprice * 100) as bigint)) * 100) // sum(cast(l_quantity as bigint))
                    as decimal(14,0)) * cast(0.0001 as decimal(5,4)) as decimal(18,4)) as value
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
             join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        group by 1, 2, 3, 4, 5"""),
    "ecb_raw": (("base_obs",), f"""
        select strftime(obs_date, '%Y-%m') as time_period, value as obs_value, area as ref_area,
               code || case when sub = 0 then '0000' else '1000' end as coicop, 'I15' as unit
        from base_obs where prio = '{S.PRIO_ECB}'"""),
    "insee_raw": (("base_obs", "ref"), f"""
        select obs_date, value,
               case when sub = 0 then label else 'Ensemble hors ' || code end as category,
               label as sub_category, '0017' || code || cast(sub as varchar) as series_id, 'INSEE' as source, area
        from base_obs join ref using (code) where prio = '{S.PRIO_INSEE}'"""),
    "datagouv_raw": (("base_obs",), f"""
        select obs_date, value, code || case when sub = 0 then '' else '.1' end as category,
               cast(null as varchar) as sub_category, code || case when sub = 0 then '' else '.1' end as coicop_code,
               'DATAGOUV' as source, area
        from base_obs where prio = '{S.PRIO_DATAGOUV}'"""),
    "eurostat_raw": (("base_obs",), f"""
        select area, 'CP' || code || case when sub = 0 then '' else '11' end as coicop, obs_date, value,
               'I15' as unit
        from base_obs where prio = '{S.PRIO_EUROSTAT}'"""),
    "n_ecb": (("ecb_raw", "ref"), """
        select try_cast(time_period || '-01' as date) as obs_date, ref_area as area, r.label as category,
               cast(obs_value as decimal(18,4)) as value, 'ECB' as source, '2015' as base_ref
        from ecb_raw e join ref r on r.code = substring(e.coicop, 1, 2)
        where obs_value is not null and time_period is not null and ref_area is not null and coicop is not null
          and right(coicop, 4) = '0000' and try_cast(time_period || '-01' as date) is not null"""),
    "n_insee": (("insee_raw", "ref"), """
        select obs_date, area, r.label as category, cast(value as decimal(18,4)) as value, 'INSEE' as source,
               '2015' as base_ref
        from insee_raw i join ref r on r.code = substring(i.category, 1, 2)
        where value is not null and category is not null and obs_date is not null"""),
    "n_datagouv": (("datagouv_raw", "ref"), """
        select obs_date, area, r.label as category, cast(value as decimal(18,4)) as value, 'DATAGOUV' as source,
               '2025' as base_ref
        from datagouv_raw d join ref r on r.code = d.category
        where value is not null and category is not null and regexp_full_match(category, '[0-9]{2}')
          and obs_date is not null"""),
    "n_eurostat": (("eurostat_raw", "ref"), """
        select obs_date, area, r.label as category, cast(value as decimal(18,4)) as value, 'EUROSTAT' as source,
               '2015' as base_ref
        from eurostat_raw e join ref r on r.code = substring(e.coicop, 3, 2)
        where value is not null and area is not null and coicop is not null
          and regexp_full_match(coicop, 'CP[0-9]{2}') and obs_date is not null"""),
    "unified": (("n_ecb", "n_insee", "n_datagouv", "n_eurostat"), """
        select obs_date, area, category, min(value) as value, source, min(base_ref) as base_ref
        from (select * from n_ecb union all select * from n_insee union all select * from n_datagouv
              union all select * from n_eurostat)
        group by obs_date, area, category, source"""),
    "prices_raw": ((), """
        select p_partkey as id, lpad(cast(p_partkey as varchar), 13, '0') as product_code, p_name as product_name,
               'en:' || lower(p_type) as category_tag, round(p_retailprice - 900, 2) as price, 'EUR' as currency,
               cast(date '2022-01-01' + cast(p_partkey % 365 as integer) as date) as date
        from part"""),
    "prices": (("prices_raw",), f"""
        select product_name as product,
               case when category_tag is null or category_tag in ('', 'nan', 'None')
                         or regexp_replace(category_tag, '^[a-z]{{2}}:', '') = '' then '{R.UNCLASSIFIED_CATEGORY}'
                    else regexp_replace(category_tag, '^[a-z]{{2}}:', '') end as category,
               cast(price as decimal(10,2)) as unit_price, date as collected_on,
               'https://example.org/product/' || product_code as url
        from prices_raw
        where price is not null and date is not null and price between 0.01 and 500"""),
    "request_log": ((), """
        select ts, 'GET' as method,
               case event_type when 'view' then '/api/inflation' when 'click' then '/api/inflation/sub'
                    when 'purchase' then '/api/predict/' || lpad(cast(user_id % 13 as varchar), 2, '0')
                    when 'signup' then '/health' else '/api/prix-alimentaires' end as path,
               case when event_type <> 'error' then 200 when event_id % 4 = 0 then 500 when event_id % 4 = 1 then 404
                    when event_id % 4 = 2 then 422 else 403 end as status,
               value / 100 as latency_s,
               case when event_type = 'purchase' then lpad(cast(user_id % 13 as varchar), 2, '0') end as category
        from events"""),
    "enriched": (("request_log",), """
        select *,
               case when path = '/api/inflation' then '/api/inflation'
                    when starts_with(path, '/api/inflation/') then '/api/inflation/{sub}'
                    when path = '/api/prix-alimentaires' then '/api/prix-alimentaires'
                    when starts_with(path, '/api/prix-alimentaires/') then '/api/prix-alimentaires/{sub}'
                    when starts_with(path, '/api/predict/') then '/api/predict/{categorie}'
                    when starts_with(path, '/api/metrics/') then '/api/metrics/{categorie}'
                    else path end as endpoint,
               case when status >= 500 then 'server_error'
                    when status = 404 and starts_with(path, '/api/') then 'not_found'
                    when status = 422 then 'validation' when status = 403 then 'unauthorized' end as error_type,
               case when starts_with(path, '/api/predict') or starts_with(path, '/api/metrics/') then 'model'
                    else 'data' end as api,
               cast(status as varchar) as status_code
        from request_log"""),
    "observed": (("enriched",), """
        select * from enriched
        where (api = 'data' and starts_with(path, '/api/')) or (api = 'model' and contains(path, '/predict'))"""),
}


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "with " + ",\n".join(f"{n} as ({CTES[n][1]})" for n in order) + "\n" + body


def mean(v: str, digits: int) -> str:
    """Exact round-half-up mean of a decimal column with at most 4 decimals, as a double."""
    s = f"sum(cast(({v}) * 10000 as hugeint))"
    n = f"count({v})"
    return (f"(cast(sign({s}) * ((abs({s}) * {2 * 10 ** digits} + {n} * 10000) // ({n} * 20000)) as double)"
            f" / {10 ** digits})")


def round2(v: str) -> str:
    return f"cast(round({v}, 2) as double)"


def filters(source=None, category=None, date_from=None, date_to=None) -> str:
    preds = []
    if source:
        preds.append(f"source = '{source.upper()}'")
    if category:
        preds.append(f"category ilike '%{category}%'")
    if date_from:
        preds.append(f"obs_date >= date '{date_from}'")
    if date_to:
        preds.append(f"obs_date <= date '{date_to}'")
    return " and ".join(preds) if preds else "true"


def dbl(x: float) -> str:
    return f"cast({float(x)!r} as double)"


def hist_quantile(q: float, counts: list[str], total: str, bounds) -> str:
    """SQL twin of ``streaming.monitor.histogram_quantile`` (same double operations in the same order)."""
    rank = f"({dbl(q)} * {total})"
    parts = []
    for i, ub in enumerate(bounds):
        start = 0.0 if i == 0 else float(bounds[i - 1])
        prev = "0" if i == 0 else counts[i - 1]
        val = f"({dbl(start)} + {dbl(float(ub) - start)} * (({rank} - {prev}) / ({counts[i]} - {prev})))"
        parts.append(f"when {counts[i]} >= {rank} then {val}")
    return f"(case {' '.join(parts)} else {dbl(bounds[-1])} end)"

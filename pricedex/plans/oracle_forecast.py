"""DuckDB SQL of the fitted forecast models (F03, F04, F06, F10, F11, F13): the same definitions as
``operators.additive`` and ``operators.monthly``, with recursive CTEs where those use array functions.

``with_forecast(body, *models)`` prefixes a query with the CTE ``fc`` (rows of ``operators.forecast.forecast``) of some
models, and the CTEs that lead to it: ``additive_fit``, ``smoothed``, ``arima_fit``.
"""

from __future__ import annotations

import math

from pricedex.operators import additive as A
from pricedex.operators import monthly as M
from pricedex.operators.forecast import DEFAULT_CUTOFF
from pricedex.plans import oracle as O

KEY = ["source", "area", "category", "fit"]
K = ", ".join(KEY)
HORIZON = 12


def _osum(values: str) -> str:
    """Sum of a list of doubles from the first entry to the last."""
    return f"list_reduce(list_prepend(0.0::double, {values}), lambda p, q: p + q)"


def _on(a: str, b: str, key=KEY) -> str:
    return " and ".join(f"{a}.{c} = {b}.{c}" for c in key)


def _solve(name: str, rows: str, settings: str, key: list[str]) -> list[tuple[str, str]]:
    """CTEs that end in ``<name>_beta`` (key, beta): ridge regression of the last entry of ``rows.z`` on the others, with one
    row a group of ``settings`` (scale, ridge). Sums over all pairs of columns, forward elimination, back substitution."""
    k = ", ".join(key)
    return [
        (f"{name}_pairs", f"""
            select {k}, i, j, cast(sum(z[i] * z[j]) as bigint) as s
            from (select {k}, z, i, unnest(range(1, len(z) + 1)) as j
                  from (select {k}, z, unnest(range(1, len(z))) as i from {rows})) group by {k}, i, j"""),
        (f"{name}_gram", f"select {k}, list(s order by i, j) as g from {name}_pairs group by {k}"),
        (f"{name}_matrix", f"""
            select {k}, list_transform(range(1, len(ridge) + 1), lambda i: list_transform(range(1, len(ridge) + 2), lambda j:
                case when i = j then g[(i - 1) * (len(ridge) + 1) + j]::double / (scale[i] * scale[j]) + ridge[i]
                     else g[(i - 1) * (len(ridge) + 1) + j]::double / (scale[i] * scale[j]) end)) as m
            from {name}_gram join {settings} using ({k})"""),
        (f"{name}_forward", f"""
            select {k}, m as rest, cast([] as double[][]) as done from {name}_matrix
            union all
            select {k}, list_transform(rest[2:], lambda r: list_transform(r[2:], lambda v, i: v - r[1] * tail[i])),
                   list_append(done, tail)
            from (select *, list_transform(rest[1][2:], lambda v: v / rest[1][1]) as tail
                  from {name}_forward where len(rest) > 0)"""),
        (f"{name}_back", f"""
            select {k}, done, cast([] as double[]) as beta from {name}_forward where len(rest) = 0
            union all
            select {k}, done[:-2], list_prepend(done[-1][-1] - {_osum("list_transform(beta, lambda x, i: done[-1][i] * x)")}, beta)
            from {name}_back where len(done) > 0"""),
        (f"{name}_beta", f"select {k}, beta from {name}_back where len(done) = 0"),
    ]


def _season(t: str) -> str:
    phase = f"((({t}) * 4 % 1461 + 1461) % 1461 / 1461.0::double)"
    return "[" + ", ".join(f"cast(round({f}({O.dbl(2 * math.pi * k)} * {phase}) * {A.MICRO}) as bigint)"
                           for k in range(1, A.FOURIER_ORDER + 1) for f in ("sin", "cos")) + "]"


def _design(t: str) -> str:
    return (f"list_concat([1::bigint, ({t} - t0)::bigint], "
            f"list_transform(changepoints, lambda c: greatest({t} - c, 0)::bigint), {_season(t)})")


def _terms(x: str) -> str:
    return f"list_transform({x}, lambda v, i: beta[i] * (v / scale[i]))"


def _month(ds: str) -> str:
    return f"cast(extract(year from {ds}) * 12 + extract(month from {ds}) - 1 as integer)"


def _hex(text: str, start: int, digits: int) -> str:
    return f"cast('0x' || substr({text}, {start}, {digits}) as bigint)"


def _common(source: str, cutoff: str) -> list[tuple[str, str]]:
    day = "cast(date_diff('day', date '1970-01-01', ds) as integer)"
    return [
        ("s", f"select source, area, category, obs_date as ds, cast(value as double) as y from unified where source = '{source}'"),
        ("cnt", f"""select source, area, category, cast(count(*) filter (where ds < date '{cutoff}') as integer) as n_train,
                           count(*) as n from s group by all"""),
        ("sn", "select s.*, n_train, n from s join cnt using (source, area, category)"),
        ("obs", f"""
            select source, area, category, 'eval' as fit, ds, {day} as t, cast(round(y * {A.UNITS}) as bigint) as q
            from sn where ds < date '{cutoff}' and n_train >= 2 and n > n_train
            union all select source, area, category, 'prod', ds, {day}, cast(round(y * {A.UNITS}) as bigint) from sn where n >= 2"""),
        ("lasts", f"select {K}, max(ds) as last_ds from obs group by all"),
        ("targets", f"""
            select source, area, category, 'eval' as fit, 'eval' as kind, ds, y, n_train
            from sn where ds >= date '{cutoff}' and n_train >= 2 and n > n_train
            union all select source, area, category, 'prod', 'fitted', ds, y, n_train from sn where n >= 2
            union all select source, area, category, 'prod', 'future',
                   cast(unnest(generate_series(max(ds) + interval 1 month, max(ds) + interval {HORIZON} month, interval 1 month)) as date),
                   null, max(n_train) from sn where n >= 2 group by source, area, category"""),
        ("ahead", f"""select targets.*, greatest({_month('ds')} - {_month('last_ds')}, 1) as h, {day} as t, last_ds
                      from targets join lasts using ({K})"""),
    ]


def _additive() -> list[tuple[str, str]]:
    waves = 2 * A.FOURIER_ORDER
    unit = f"(top / {float(A.UNITS)}::double)"
    place = {q: q * (A.DRAWS - 1) for q in (0.1, 0.9)}

    def point(q: float) -> str:
        low = int(place[q])
        return f"(offs[{low + 1}] + {O.dbl(place[q] - low)} * (offs[{min(low + 2, A.DRAWS)}] - offs[{low + 1}]))"

    def day(d: str) -> str:
        return f"cast(date_diff('day', date '1970-01-01', cast({d} as date)) as integer)"

    return [
        ("dated", f"""select {K}, count(*) as n, min(t) as t0, max(t) as t1, greatest(max(abs(q)), 1) as top,
                             list(t order by t) as dates from obs group by {K}"""),
        ("early", f"""select *, least({A.CHANGEPOINTS}, e - 1)::integer as k, greatest(t1 - t0, 1)::double as span
                      from (select *, greatest(n * 8 // 10, 1) as e from dated)"""),
        ("settings", f"""
            select *, list_transform(range(1, k + 1), lambda j: dates[1 + (2 * j * (e - 1) + k) // (2 * k)]) as changepoints,
                   list_concat([1.0::double, span], list_transform(range(0, k), lambda i: span),
                               list_transform(range(0, {waves}), lambda i: {A.MICRO}.0::double), [top::double]) as scale,
                   list_concat([0.0::double, 0.0::double], list_transform(range(0, k), lambda i: {O.dbl(A.TREND_RIDGE)}),
                               list_transform(range(0, {waves}), lambda i: {O.dbl(A.SEASON_RIDGE)})) as ridge from early"""),
        ("design_rows", f"select {K}, list_append({_design('t')}, q) as z from obs join settings using ({K})"),
        *_solve("add", "design_rows", "settings", KEY),
        ("coefs", f"select * from settings join add_beta using ({K})"),
        ("off", f"""select {K}, cast(round((q / top - {_osum(_terms('x'))}) * {A.MICRO}) as bigint) as r
                    from (select *, {_design('t')} as x from obs join coefs using ({K}))"""),
        ("additive_fit", f"""
            select coefs.*, sigma from coefs join (select {K}, sqrt(cast(sum(r * r) as bigint) / greatest(count(*) - {A.FREE}, 1)) / {A.MICRO}.0::double as sigma
                                                   from off group by {K}) using ({K})"""),
        ("parts", f"""
            select {K}, kind, ds, y, n_train, h, sigma, top, {_osum('c[1:k + 2]')} * {unit} as trend, {_osum('c[k + 3:]')} * {unit} as yearly
            from (select *, {_terms('x')} as c from (select *, {_design('t')} as x from ahead join additive_fit using ({K})))"""),
        ("draws", f"""
            select {K}, h, t_h, t_before, draw, k, span, sigma, top, t1,
                   (case when k > 0 then {_osum("list_transform(beta[3:k + 2], lambda b: abs(b))")} / k else 0.0 end) + 1e-08::double as size,
                   md5(concat_ws('|', {K}, draw, h) || '|slope') as sh, md5(concat_ws('|', {K}, draw, h) || '|noise') as nh
            from (select {K}, h, {day('last_ds + to_months(h)')} as t_h, {day('last_ds + to_months(h - 1)')} as t_before
                  from (select {K}, last_ds, unnest(range(1, max(h) + 1))::integer as h from ahead where kind <> 'fitted' group by {K}, last_ds))
            join additive_fit using ({K}) cross join (select unnest(range(1, {A.DRAWS + 1})) as draw)"""),
        ("changed", f"""
            select *, case when not ({_hex('sh', 1, 8)} / {1 << 32}.0::double < k * (t_h - t_before) / span) then 0
                           when {_hex('sh', 9, 1)} < 8 then -amount else amount end as change
            from (select *, cast(round(ln(({_hex('sh', 10, 7)} + 0.5::double) / {1 << 28}.0::double) * -{A.NANO}.0::double) as bigint) as amount
                  from draws)"""),
        ("walked", f"""
            select *, sum(change) over w as a, sum(change * (t_before - t1)) over w as b,
                   cast(round(sqrt(-2.0::double * ln(({_hex('nh', 1, 13)} + 0.5::double) / {1 << 52}.0::double))
                              * cos({_hex('nh', 14, 13)} / {1 << 52}.0::double * {O.dbl(2 * math.pi)}) * {A.NANO}) as bigint) as noise
            from changed window w as (partition by {K}, draw order by h rows unbounded preceding)"""),
        ("sampled", f"""
            select {K}, h, list(o order by o) as offs from (
                select {K}, h, (cast(a * (t_h - t1) - b as bigint)::double / {A.NANO}.0::double * size / span
                                + noise::double / {A.NANO}.0::double * sigma) * {unit} as o from walked) group by {K}, h"""),
        ("bands", f"select {K}, h, least({point(0.1)}, 0.0) as low, greatest({point(0.9)}, 0.0) as high from sampled"),
        ("additive_fc", f"""
            select source, area, category, 'additive' as model, kind, ds, y, trend + yearly as yhat,
                   (trend + yearly) + case when kind = 'fitted' then -({O.dbl(A.Z80)} * sigma * {unit}) else low end as yhat_lower,
                   (trend + yearly) + case when kind = 'fitted' then {O.dbl(A.Z80)} * sigma * {unit} else high end as yhat_upper,
                   case when kind <> 'eval' then trend end as trend, case when kind <> 'eval' then yearly end as yearly, n_train
            from parts left join bands using ({K}, h)"""),
    ]


def _monthly() -> list[tuple[str, str]]:
    return [
        ("months", f"select {K}, {_month('ds')} as month, arg_max(q, ds) as q from obs group by {K}, {_month('ds')}"),
        ("gaps", f"""select *, lead(month) over w as next_month, lead(q) over w as next_q
                     from months window w as (partition by {K} order by month)"""),
        ("filled", "select *, unnest(range(month, coalesce(next_month, month + 1)))::integer as pos from gaps"),
        ("grids", f"""
            select {K}, list(cast(v as bigint) order by pos) as qs, count(*)::integer as n, max(pos) as last from (
                select *, case when pos = month then q else q + cast(sign((next_q - q) * (pos - month)) as bigint)
                    * ((2 * abs((next_q - q) * (pos - month)) + (next_month - month)) // (2 * (next_month - month))) end as v
                from filled) group by {K}"""),
    ]


def _smooth(weights: str, name: str) -> list[tuple[str, str]]:
    """CTE <name>: the state after all months for the weights a, b, g of each row of ``weights`` (with ys and start)."""
    old, error = "s.season[1]", "(x.y - (s.level + s.trend + s.season[1]))"
    p = M.PERIOD
    return [(name, f"""
        select * exclude (start), list_reduce(list_prepend(start, list_transform(ys, lambda y: {{'y': y, 'i': 0, 'level': 0.0::double,
                   'trend': 0.0::double, 'season': cast([] as double[]), 'sse': 0.0::double}})),
               lambda s, x: {{'y': x.y, 'i': s.i + 1, 'level': s.level + s.trend + a * {error}, 'trend': s.trend + a * b * {error},
                   'season': list_append(s.season[2:{p}], {old} + g * (1.0::double - a) * {error}),
                   'sse': case when s.i < {p} then s.sse else s.sse + {error} * {error} end}}) as state
        from {weights}""")]


def _holt_winters() -> list[tuple[str, str]]:
    p = M.PERIOD
    grid = "unnest([" + ", ".join(map(O.dbl, M.GRID)) + "])"
    out = [
        ("valued", f"select {K}, n, last, list_transform(qs, lambda q: q / {float(A.UNITS)}::double) as ys from grids"),
        ("years", f"""select *, {_osum(f'ys[1:{p}]')} / {p}.0::double as y1, {_osum(f'ys[{p + 1}:{2 * p}]')} / {p}.0::double as y2
                      from valued where n >= {2 * p}"""),
        ("started", f"""
            select {K}, ys, {{'y': 0.0::double, 'i': 0, 'level': y1, 'trend': (y2 - y1) / {p}.0::double,
                              'season': list_transform(ys[1:{p}], lambda y: y - y1), 'sse': 0.0::double}} as start from years"""),
        ("weights0", f"""select *, {grid} as g from (select *, {grid} as b from (select *, {grid} as a from started))"""),
    ]
    for i, offsets in enumerate([*M.OFFSETS, None]):
        out += _smooth(f"weights{i}", f"tried{i}")
        out.append((f"best{i}", f"""
            select {K}, a, b, g, state from (select *, row_number() over (partition by {K} order by state.sse, a, b, g) as rank
                                             from tried{i}) where rank = 1"""))
        if offsets:
            axis = [f"unnest(list_transform([{', '.join(map(O.dbl, offsets))}], lambda o: "
                    f"greatest(least(w{c} + o, {O.dbl(M.HIGHEST)}), {O.dbl(M.LOWEST)}))) as {c}" for c in "abg"]
            inner = f"select {K}, ys, start, best{i}.a as wa, best{i}.b as wb, best{i}.g as wg from started join best{i} using ({K})"
            out.append((f"weights{i + 1}", f"select *, {axis[2]} from (select *, {axis[1]} from (select *, {axis[0]} from ({inner})))"))
    final = f"best{len(M.OFFSETS)}"
    mean = f"({_osum('ys')} / n)"
    return [*out, ("smoothed", f"""
        select {K}, n, last, ys[-1] as last_y, a as alpha, b as beta, g as gamma, state.sse as sse, state.level as level,
               state.trend as trend, state.season as season,
               case when n >= {2 * p} then sqrt(state.sse / (n - {p}))
                    when n > 1 then sqrt({_osum('list_transform(ys, lambda y: (y - mean) * (y - mean))')} / n) else 0.0 end as sigma
        from (select *, {mean} as mean from valued) left join {final} using ({K})"""),
        ("smoothed_fc", f"""
        select source, area, category, 'holt_winters' as model, kind, ds, y, yhat, yhat - band as yhat_lower, yhat + band as yhat_upper,
               null::double as trend, null::double as yearly, n_train
        from (select *, case when alpha is null then last_y else level + greatest(steps, 1) * trend
                                 + season[(greatest(steps, 1) - 1) % {p} + 1] end as yhat,
                     {O.dbl(A.Z80)} * sigma * sqrt(1.0::double + greatest(steps, 0) / 12.0::double) as band
              from (select *, {_month('ds')} - last as steps from targets join smoothed using ({K})) where kind <> 'fitted')""")]


def _arima() -> list[tuple[str, str]]:
    def settings(rows: str, key: str) -> str:
        return f"""select {key}, list_transform(range(0, max(len(z))), lambda i: 1.0::double) as scale,
                          list_prepend(0.0::double, list_transform(range(0, max(len(z)) - 2), lambda i: 1.0::double)) as ridge
                   from {rows} group by {key}"""

    def outside(a: str, b: str) -> str:
        return f"(abs({b}) < 1 and {b} + {a} > -1 and {b} - {a} > -1)"

    kinds = [*KEY, "kind"]
    kk = ", ".join(kinds)
    step = "c[1] + c[2] * {0} + c[3] * {1} + c[4] * {2} + c[5] * {3}"
    shock = f"cast(round({_osum('list_transform(list_prepend(1, list_reverse(d[i - lags:i - 1])), lambda v, j: beta[j] * (v / 1.0::double))')}) as bigint)"
    return [
        ("raw_changes", f"""
            select {K}, last, qs[-1] as last_q, n - 1 as m, least({M.MAX_LAGS}, (n - 1) // 4)::integer as lags,
                   case when n > 1 then list_transform(range(2, n + 1), lambda i: qs[i] - qs[i - 1]) else [0::bigint] end as raw from grids"""),
        ("united", "select *, 1 + list_max(list_transform(raw, lambda v: abs(v))) // 16777216 as unit from raw_changes"),
        ("changes", """select * exclude (raw), list_transform(raw, lambda v: cast(sign(v) as bigint)
                              * ((2 * abs(v) + unit) // (2 * unit))) as d from united"""),
        ("lagged", f"""
            select {K}, list_concat([1::bigint], list_reverse(d[i - lags:i - 1]), [d[i]]) as z
            from (select *, unnest(range(lags + 1, m + 1)) as i from changes where m >= {M.MIN_CHANGES})"""),
        ("lagged_set", settings("lagged", K)),
        *_solve("long", "lagged", "lagged_set", KEY),
        ("shocks", f"""
            select * exclude (beta), list_transform(range(1, m + 1), lambda i: case when i <= lags then 0::bigint else d[i] - {shock} end) as e
            from changes join long_beta using ({K})"""),
        ("lag_pairs", f"""
            select {K}, 'arima' as kind, [1::bigint, d[i - 1], d[i - 2], e[i - 1], e[i - 2], d[i]] as z
            from (select *, unnest(range(lags + 3, m + 1)) as i from shocks)
            union all select {K}, 'ar', [1::bigint, d[i - 1], d[i - 2], d[i]]
            from (select *, unnest(range(lags + 3, m + 1)) as i from shocks)"""),
        ("both_set", settings("lag_pairs", kk)),
        *_solve("two", "lag_pairs", "both_set", kinds),
        ("picked", f"""
            select {K}, case when {outside('f.beta[4]', 'f.beta[5]')} then 'arima' else 'ar' end as kind,
                   case when {outside('f.beta[4]', 'f.beta[5]')} then f.beta else list_concat(r.beta, [0.0::double, 0.0::double]) end as c
            from (select * from two_beta where kind = 'arima') f join (select * from two_beta where kind = 'ar') r using ({K})"""),
        ("tested", f"select {K}, case when {outside(f'(-c[2] / {O.dbl(M.GROWTH)})', f'(-c[3] / {O.dbl(M.GROWTH * M.GROWTH)})')} then kind else 'drift' end as kind, c from picked"),
        ("resid", f"""
            select {K}, kind, c, list_transform(range(lags + 3, m + 1), lambda i: d[i] - cast(round(
                {step.format('d[i - 1]', 'd[i - 2]', 'e[i - 1]', 'e[i - 2]')}) as bigint)) as off from shocks join tested using ({K})"""),
        ("arima_fit", f"""
            select {K}, last, last_q, unit, coalesce(kind, 'drift') as kind, case when kind <> 'drift' then c end as coef,
                   d[-1] as d1, d[-2] as d2, off[-1] as e1, off[-2] as e2,
                   case when coalesce(kind, 'drift') <> 'drift' then sqrt(list_sum(list_transform(off, lambda r: r * r))::bigint / len(off))
                        else sqrt(cast(len(d) * list_sum(list_transform(d, lambda v: v * v)) - list_sum(d) * list_sum(d) as bigint)::double)
                             / len(d) end as sigma, cast(list_sum(d) as bigint) / len(d) as drift
            from changes left join resid using ({K})"""),
        ("furthest", f"""select {K}, max(greatest({_month('ds')} - last, 1)) as furthest
                         from targets join arima_fit using ({K}) where targets.kind <> 'fitted' group by {K}"""),
        ("path", f"""
            select {K}, 0 as h, furthest, d1::double as d1, coalesce(d2, 0)::double as d2, coalesce(e1, 0)::double as e1,
                   coalesce(e2, 0)::double as e2, last_q::double as level, coef as c, unit, drift
            from arima_fit join furthest using ({K})
            union all
            select {K}, h + 1, furthest, change, d1, 0.0, e1, level + change * unit, c, unit, drift
            from (select *, case when c is null then drift else {step.format('d1', 'd2', 'e1', 'e2')} end as change
                  from path where h < furthest)"""),
        ("arima_fc", f"""
            select source, area, category, 'arima_2_1_2' as model, kind, ds, y, level / {float(A.UNITS)}::double as yhat,
                   level / {float(A.UNITS)}::double - band as yhat_lower, level / {float(A.UNITS)}::double + band as yhat_upper,
                   null::double as trend, null::double as yearly, n_train
            from (select t.*, p.level, {O.dbl(A.Z80)} * ((f.sigma * f.unit) / {float(A.UNITS)}::double) * sqrt(p.h::double) as band
                  from targets t join arima_fit f on {_on('t', 'f')}
                  join path p on {_on('t', 'p')} and p.h = greatest({_month('t.ds')} - f.last, 1) where t.kind <> 'fitted')"""),
    ]


FAMILIES = {"additive": (lambda: _additive(), "additive_fc"), "holt_winters": (lambda: _monthly() + _holt_winters(), "smoothed_fc"),
            "arima_2_1_2": (lambda: _monthly() + _arima(), "arima_fc")}


def with_forecast(body: str, *models: str, source: str = "INSEE", cutoff: str = DEFAULT_CUTOFF) -> str:
    ctes: dict[str, str] = dict(_common(source, cutoff))
    for m in models:
        ctes |= dict(FAMILIES[m][0]())
    ctes["fc"] = " union all ".join(f"select * from {FAMILIES[m][1]}" for m in models)
    ctes["m"] = """
        select source, area, category, model, round_even(avg(abs(y - yhat)), 4) as mae,
               round_even(sqrt(avg((y - yhat) * (y - yhat))), 4) as rmse,
               round_even(avg(abs((y - yhat) / case when y <> 0 then y else 1 end)) * 100, 2) as mape_pct,
               max(n_train) as n_train, count(*) as n_eval
        from fc where kind = 'eval' group by source, area, category, model"""
    head = O.with_ctes("\x00", "unified").replace("with ", "with recursive ", 1)
    recursive = ("_forward", "_back", "path")
    text = ",\n".join(f"{n} as {'' if n.endswith(recursive) else 'materialized '}({sql})" for n, sql in ctes.items())
    return head.replace("\n\x00", ",\n" + text + "\n" + body)

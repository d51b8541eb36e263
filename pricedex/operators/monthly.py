"""Holt-Winters and ARIMA(2,1,2) on gapless monthly series, for every series at once in DataFrame operations.

A series is first put on a monthly grid (the last value of a month; missing months on the line between their neighbours,
to four decimals), as one array per series: its length is bounded by the number of months. The smoothing recursion is an
``aggregate`` over that array; the autoregressions are ``least_squares`` of lags in units of the fourth decimal, so their
sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricedex.operators.additive import UNITS, Z80
from pricedex.operators.least_squares import ordered_sum, predicted, solve
from pricedex.sources.store import spread, written

PERIOD = 12
GRID = [0.05, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95]  # smoothing weights tried first
OFFSETS = [[-0.15, -0.075, 0.0, 0.075, 0.15], [-0.05, -0.025, 0.0, 0.025, 0.05]]  # and around the best, in two rounds
LOWEST, HIGHEST = 0.01, 0.99
MAX_LAGS = 12
GROWTH = 1.02  # a month, from which on an autoregression counts as explosive
MIN_CHANGES = 20  # month-to-month changes that an ARIMA fit needs


def month_number(ds: str) -> Column:
    return (F.year(ds) * 12 + F.month(ds) - 1).cast("int")


def monthly(obs: DataFrame, key: list[str]) -> DataFrame:
    """Per group (key): ``qs`` array<long> of the values on the gapless grid (in units), ``n``, ``last`` (month number)."""
    months = obs.groupBy(*key, month_number("ds").alias("month")).agg(F.max_by("q", "ds").alias("q"))
    after = Window.partitionBy(*key).orderBy("month")  # bounded by the months of one series
    gap = months.withColumn("next_month", F.lead("month").over(after)).withColumn("next_q", F.lead("q").over(after))
    last = F.coalesce(F.col("next_month") - 1, F.col("month"))
    filled = gap.withColumn("at", F.explode(F.sequence("month", last)))
    rise = (F.col("next_q") - F.col("q")) * (F.col("at") - F.col("month"))
    # rounded half away from zero, in whole numbers
    step = F.expr("(2 * abs((next_q - q) * (at - month)) + (next_month - month)) div (2 * (next_month - month))")
    q = F.when(F.col("at") == F.col("month"), F.col("q")).otherwise(F.col("q") + F.sign(rise).cast("long") * step)
    rows = filled.select(*key, "at", q.cast("long").alias("q"))
    found = rows.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("at", "q"))).alias("grid"), F.max("at").alias("last"))
    return found.select(*key, F.col("grid.q").alias("qs"), F.size("grid").alias("n"), "last")


# ------------------------------------------------------------------------------------------------ Holt-Winters
SEASON = [f"s{i + 1}" for i in range(PERIOD)]  # the next twelve seasonal terms; fields turn faster than an array


def _start() -> Column:
    """Level, trend and season of the first two years of ``ys``."""
    year = [ordered_sum(F.slice("ys", 1 + PERIOD * i, PERIOD)) / F.lit(float(PERIOD)) for i in range(2)]
    return F.struct(F.lit(0).alias("i"), year[0].alias("level"), ((year[1] - year[0]) / F.lit(float(PERIOD))).alias("trend"),
                    *[(F.col("ys")[i] - year[0]).alias(s) for i, s in enumerate(SEASON)], F.lit(0.0).alias("sse"))


def _smooth(a: Column, b: Column, g: Column) -> Column:
    """State after the whole array ``ys`` from ``start``: level, trend, the next twelve seasonal terms, squared error.

    In error-correction form: with the one-step error e, level + trend + a e, trend + a b e, season + g (1 - a) e.
    """
    def step(s: Column, y: Column) -> Column:
        error = y - (s["level"] + s["trend"] + s["s1"])
        return F.struct(
            (s["i"] + 1).alias("i"), (s["level"] + s["trend"] + a * error).alias("level"), (s["trend"] + a * b * error).alias("trend"),
            *[s[later].alias(f) for f, later in zip(SEASON, SEASON[1:])], (s["s1"] + g * (F.lit(1.0) - a) * error).alias(SEASON[-1]),
            F.when(s["i"] < PERIOD, s["sse"]).otherwise(s["sse"] + error * error).alias("sse"))

    return F.aggregate("ys", F.col("start"), step)


def holt_winters(grids: DataFrame, key: list[str]) -> DataFrame:
    """Additive trend and season of period 12. Weights (alpha, beta, gamma) by the smallest squared one-step error from the
    second year on: a coarse grid, then two finer ones around the best (ties: the smallest weights). Per group of at least
    two years: the weights, ``sse``, the state after the last month and ``sigma``; for shorter groups these are null and
    ``sigma`` is the values' standard deviation (their forecast is the last value)."""
    rows = grids.withColumn("ys", F.transform("qs", lambda q: q / F.lit(float(UNITS))))
    long = written(rows.where(F.col("n") >= 2 * PERIOD).select(*key, "ys", _start().alias("start")), "smoothing-starts")
    tried = None
    for offsets in [None, *OFFSETS]:
        if tried is None:
            axes = [F.array(*map(F.lit, GRID))] * 3
            rows_now = spread(long, *key)
        else:
            axes = [F.array(*[F.greatest(F.least(F.col("best")[w] + F.lit(o), F.lit(HIGHEST)), F.lit(LOWEST)) for o in offsets])
                    for w in "abg"]
            rows_now = spread(tried, *key)
        for name, axis in zip("abg", axes, strict=True):
            rows_now = rows_now.withColumn(name, F.explode(axis))
        sse = _smooth(F.col("a"), F.col("b"), F.col("g"))["sse"]
        best = rows_now.groupBy(*key).agg(F.min(F.struct(sse.alias("sse"), "a", "b", "g")).alias("best"))
        tried = written(best, "smoothing-weights").join(long, key)
    state = _smooth(F.col("best.a"), F.col("best.b"), F.col("best.g"))
    fitted = tried.select(*key, "best", state.alias("state"))
    n = F.col("n")
    mean = ordered_sum(F.col("ys")) / n
    deviation = F.sqrt(ordered_sum(F.transform("ys", lambda y: (y - mean) * (y - mean))) / n)
    sigma = F.when(n >= 2 * PERIOD, F.sqrt(F.col("best.sse") / (n - PERIOD))).when(n > 1, deviation).otherwise(F.lit(0.0))
    return rows.join(fitted, key, "left").select(
        *key, "n", "last", F.element_at("ys", -1).alias("last_y"), F.col("best.a").alias("alpha"), F.col("best.b").alias("beta"),
        F.col("best.g").alias("gamma"), F.col("best.sse").alias("sse"), F.col("state.level").alias("level"),
        F.col("state.trend").alias("trend"), F.when(F.col("state").isNotNull(), F.array(*[F.col("state")[f] for f in SEASON]))
        .alias("season"), sigma.alias("sigma"))


def holt_winters_forecast(targets: DataFrame, models: DataFrame, key: list[str]) -> DataFrame:
    """``targets`` (key, ds) with ``yhat`` and ``band``."""
    found = targets.join(models, key)
    h = month_number("ds") - F.col("last")
    ahead = F.greatest(h, F.lit(1))
    yhat = F.col("level") + ahead * F.col("trend") + F.col("season")[(ahead - 1) % PERIOD]
    band = F.lit(Z80) * F.col("sigma") * F.sqrt(F.lit(1.0) + F.greatest(h, F.lit(0)) / F.lit(12.0))
    return found.select(*targets.columns, F.when(F.col("alpha").isNull(), F.col("last_y")).otherwise(yhat).alias("yhat"),
                        band.alias("band"))


# ------------------------------------------------------------------------------------------------ ARIMA(2,1,2)
def _regressed(rows: DataFrame, key: list[str]) -> DataFrame:
    """Coefficients of ``z`` (a constant, the lags, the change itself); a lag's diagonal gets one squared unit, so that a
    series without changes has a solution."""
    width = rows.groupBy(*key).agg(F.max(F.size("z")).alias("width"))
    settings = width.select(*key, F.array_repeat(F.lit(1.0), F.col("width")).alias("scale"), F.concat(
        F.array(F.lit(0.0)), F.array_repeat(F.lit(1.0), F.col("width") - 2)).alias("ridge"))
    return solve(rows, settings, key).select(*key, "scale", "beta")


def arima(grids: DataFrame, key: list[str]) -> DataFrame:
    """ARIMA(2,1,2) with a constant by two lagged regressions: a long autoregression (a quarter of the changes, at most 12)
    whose residuals then stand for the innovations. Per group: ``kind``, ``unit``, ``coef`` (constant, two lags, two
    innovations), the last two changes and innovations, ``sigma`` and ``drift`` (these four in units).

    ``kind`` is ``arima``; ``ar`` where the moving-average part is not invertible (both roots outside the unit circle): the
    same months are fitted without it; ``drift`` where the autoregression is explosive (a root that grows by more than
    ``GROWTH`` a month; a lasting cycle is not) or there are fewer than
    ``MIN_CHANGES`` changes: the forecast goes on by the mean change.
    """
    size = F.size("qs") - 1
    base = grids.withColumn("d", F.expr("transform(sequence(1, greatest(size(qs) - 1, 1)), i -> if(size(qs) > 1, qs[i] - qs[i - 1], 0))"))
    # whole numbers of at most 24 bits or so: one unit, unless a series changes by more than 1 600 at a time
    base = base.withColumn("unit", F.expr("1 + array_max(transform(d, v -> abs(v))) div 16777216")).withColumn("d", F.expr(
        "transform(d, v -> cast(sign(v) AS bigint) * ((2 * abs(v) + unit) div (2 * unit)))"))
    base = base.select(*key, "last", "unit", size.alias("m"), F.element_at("qs", -1).alias("last_q"), "d",
                       F.least(F.lit(MAX_LAGS), F.expr("(size(qs) - 1) div 4")).cast("int").alias("lags"))
    long = base.where(F.col("m") >= MIN_CHANGES)
    one = F.array(F.lit(1).cast("long"))
    lagged = F.reverse(F.slice("d", F.col("at") - F.col("lags") + 1, F.col("lags")))  # ``at`` counts from zero
    first = long.withColumn("at", F.explode(F.sequence(F.col("lags"), F.col("m") - 1))).select(
        *key, F.concat(one, lagged, F.array(F.col("d")[F.col("at")])).alias("z"))
    stage1 = _regressed(first, key)

    def whole(z: Column) -> Column:
        return F.round(predicted(z, F.col("scale"), F.col("beta"))).cast("long")

    # innovations: zero before the first month that has all lags
    shocks = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda i: F.when(i < F.col("lags"), F.lit(0).cast("long")).otherwise(
        F.col("d")[i] - whole(F.concat(one, F.reverse(F.slice("d", i - F.col("lags") + 1, F.col("lags")))))))
    known = written(long.join(stage1, key).withColumn("e", shocks).drop("scale", "beta"), "innovations")
    at = known.withColumn("at", F.explode(F.sequence(F.col("lags") + 2, F.col("m") - 1)))
    d, e, i = F.col("d"), F.col("e"), F.col("at")
    full = at.select(*key, F.lit("arima").alias("kind"), F.concat(one, F.array(d[i - 1], d[i - 2], e[i - 1], e[i - 2], d[i])).alias("z"))
    short = at.select(*key, F.lit("ar").alias("kind"), F.concat(one, F.array(d[i - 1], d[i - 2], d[i])).alias("z"))
    fits = _regressed(full.unionByName(short), [*key, "kind"])
    coef = F.concat("beta", F.array_repeat(F.lit(0.0), 5 - F.size("beta")))
    by_kind = fits.groupBy(*key).pivot("kind", ["arima", "ar"]).agg(F.first(coef))
    chosen = by_kind.withColumn("kind", F.when(_roots_outside(F.col("arima")[3], F.col("arima")[4]), F.lit("arima")).otherwise(F.lit("ar")))
    chosen = chosen.withColumn("coef", F.when(F.col("kind") == "arima", F.col("arima")).otherwise(F.col("ar"))).drop("arima", "ar")
    # phi(z) = 1 - c1 z - c2 z^2
    chosen = chosen.withColumn("kind", F.when(_roots_outside(
        -F.col("coef")[1] / F.lit(GROWTH), -F.col("coef")[2] / F.lit(GROWTH * GROWTH)), F.col("kind")).otherwise(F.lit("drift")))
    used = known.join(chosen, key)
    off = F.transform(F.sequence(F.col("lags") + 2, F.col("m") - 1), lambda j: d[j] - F.round(_next(
        F.col("coef"), d[j - 1], d[j - 2], e[j - 1], e[j - 2])).cast("long"))
    used = used.withColumn("off", off).select(
        *key, "kind", "coef", F.element_at("off", -1).alias("e1"), F.element_at("off", -2).alias("e2"),
        F.sqrt(F.aggregate("off", F.lit(0).cast("long"), lambda s, r: s + r * r) / F.size("off")).alias("sigma"))
    total = F.aggregate("d", F.lit(0).cast("long"), lambda s, v: s + v)
    squares = F.aggregate("d", F.lit(0).cast("long"), lambda s, v: s + v * v)
    n = F.size("d")
    deviation = F.sqrt((n * squares - total * total).cast("double")) / n
    found = base.join(used, key, "left").withColumn("kind", F.coalesce("kind", F.lit("drift")))
    return found.select(
        *key, "last", "last_q", "unit", "kind", F.when(F.col("kind") != "drift", F.col("coef")).alias("coef"),
        F.element_at("d", -1).alias("d1"), F.try_element_at("d", F.lit(-2)).alias("d2"), "e1", "e2",
        F.when(F.col("kind") == "drift", deviation).otherwise(F.col("sigma")).alias("sigma"), (total / n).alias("drift"))


def _roots_outside(a: Column, b: Column) -> Column:
    """Whether 1 + a z + b z^2 has all roots outside the unit circle."""
    return (F.abs(b) < 1) & (b + a > -1) & (b - a > -1)


def _next(c: Column, d1: Column, d2: Column, e1: Column, e2: Column) -> Column:
    return c[0] + c[1] * d1 + c[2] * d2 + c[3] * e1 + c[4] * e2


def arima_forecast(targets: DataFrame, models: DataFrame, key: list[str]) -> DataFrame:
    """``targets`` (key, ds) with ``yhat`` and ``band``; the path of a group is walked once, to its furthest month."""
    ahead = targets.join(models.select(*key, "last"), key).withColumn("h", F.greatest(month_number("ds") - F.col("last"), F.lit(1)))
    furthest = ahead.groupBy(*key).agg(F.max("h").alias("furthest"))
    c = F.col("coef")
    start = F.struct(F.col("d1").cast("double").alias("d1"), F.coalesce(F.col("d2"), F.lit(0)).cast("double").alias("d2"),
                     F.coalesce(F.col("e1"), F.lit(0)).cast("double").alias("e1"), F.coalesce(F.col("e2"), F.lit(0)).cast("double").alias("e2"),
                     F.col("last_q").cast("double").alias("level"), F.expr("cast(array() AS array<double>)").alias("path"))

    def step(s: Column, _: Column) -> Column:
        change = F.when(c.isNull(), F.col("drift")).otherwise(_next(c, s["d1"], s["d2"], s["e1"], s["e2"]))
        level = s["level"] + change * F.col("unit")
        return F.struct(change.alias("d1"), s["d1"].alias("d2"), F.lit(0.0).alias("e1"), s["e1"].alias("e2"), level.alias("level"),
                        F.concat(s["path"], F.array(level)).alias("path"))

    walked = models.join(furthest, key).select(
        *key, (F.col("sigma") * F.col("unit")).alias("sigma"), F.aggregate(F.sequence(F.lit(1), F.col("furthest")), start, step)["path"].alias("path"))
    band = F.lit(Z80) * (F.col("sigma") / F.lit(float(UNITS))) * F.sqrt(F.col("h").cast("double"))
    return ahead.drop("last").join(walked, key).select(
        *targets.columns, (F.col("path")[F.col("h") - 1] / F.lit(float(UNITS))).alias("yhat"), band.alias("band"))

"""piecewise-linear trend with regularised changepoints plus a yearly Fourier season, with an interval
by reproducible sampling, for every series at once in DataFrame operations.

y = a + b t + sum_j d_j max(t - c_j, 0) + sum_k (s_k sin + c_k cos)(2 pi k phase), fitted by ridge regression
(``least_squares``): values enter to four decimals, days as whole numbers, sines and cosines in millionths, so all sums
are exact. The changepoints are observed dates, evenly spaced over the first 80 % of a series' observations.

The interval follows the reference's idea of sampling the future: in each draw the slope may change every month, as often
and by as much (Laplace) as the fitted changepoints do, and noise of the residuals' size is added; the bounds are the
10 % and 90 % points of the draws. Draws come from a hash of (series, fit, draw, month), so they are the same wherever and
however often a task runs. In-sample rows have noise only and get its normal quantile.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricedex.operators.least_squares import predicted, solve
from pricedex.sources.store import written

Z80 = 1.2815515655446004  # two-sided 80 % normal quantile
UNITS = 10_000  # of the value
MICRO = 1_000_000  # units of sines and of residuals
CHANGEPOINTS = 25
FOURIER_ORDER = 4
TREND_RIDGE = 0.04  # (noise scale 0.01 / changepoint prior 0.05) squared
SEASON_RIDGE = 1e-06  # (noise scale 0.01 / season prior 10) squared
FREE = 2 + 2 * FOURIER_ORDER  # columns that take freedom from the residuals (changepoints are held back)
DRAWS = 200
NANO = 1_000_000_000  # units of sampled slope changes and noise


def season(t: Column) -> Column:
    """Sines and cosines of the yearly phase of day ``t`` (days since 1970), in millionths."""
    phase = F.pmod(t * 4, F.lit(1461)) / F.lit(1461.0)
    waves = []
    for k in range(1, FOURIER_ORDER + 1):
        angle = F.lit(2 * math.pi * k) * phase
        waves += [F.round(wave(angle) * MICRO).cast("long") for wave in (F.sin, F.cos)]
    return F.array(*waves)


def design(t: Column) -> Column:
    """1, days since the first date, days since each changepoint passed, season: needs columns t0 and changepoints."""
    hinges = F.transform("changepoints", lambda c: F.greatest(t - c, F.lit(0)).cast("long"))
    return F.concat(F.array(F.lit(1).cast("long"), (t - F.col("t0")).cast("long")), hinges, season(t))


def fit(obs: DataFrame, key: list[str]) -> DataFrame:
    """One row per group of ``obs`` (key, t int, q long): settings, ``beta`` and ``sigma`` (of values divided by ``top``)."""
    groups = obs.groupBy(*key).agg(
        F.count("*").alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1"),
        F.greatest(F.max(F.abs("q")), F.lit(1)).alias("top"),
        F.sort_array(F.collect_list("t")).alias("dates"))  # bounded by the dates of one series
    early = F.greatest(F.expr("n * 8 div 10"), F.lit(1))
    groups = groups.withColumn("early", early).withColumn("k", F.least(F.lit(CHANGEPOINTS), F.col("early") - 1).cast("int"))
    groups = groups.withColumn("changepoints", F.expr(
        "CASE WHEN k > 0 THEN transform(sequence(1, k), j -> dates[cast((2 * j * (early - 1) + k) div (2 * k) AS int)]) "
        "ELSE cast(array() AS array<int>) END"))
    span = F.greatest(F.col("t1") - F.col("t0"), F.lit(1)).cast("double")
    groups = groups.withColumn("span", span)
    waves = 2 * FOURIER_ORDER
    scale = F.concat(F.array(F.lit(1.0), F.col("span")), F.array_repeat("span", F.col("k")),
                     F.array_repeat(F.lit(float(MICRO)), waves), F.array(F.col("top").cast("double")))
    ridge = F.concat(F.array(F.lit(0.0), F.lit(0.0)), F.array_repeat(F.lit(TREND_RIDGE), F.col("k")),
                     F.array_repeat(F.lit(SEASON_RIDGE), waves))
    groups = groups.withColumn("scale", scale).withColumn("ridge", ridge).drop("dates", "early")
    rows = obs.join(groups.select(*key, "t0", "changepoints"), key).select(
        *key, F.concat(design(F.col("t")), F.array("q")).alias("z"))
    solved = written(solve(rows, groups, key), "additive-coefficients")
    off = obs.join(solved, key).select(*key, F.round(
        (F.col("q") / F.col("top") - predicted(design(F.col("t")), F.col("scale"), F.col("beta"))) * MICRO).cast("long").alias("r"))
    spread = off.groupBy(*key).agg(F.sum(F.col("r") * F.col("r")).alias("rr"), F.count("*").alias("rows"))
    sigma = F.sqrt(F.col("rr") / F.greatest(F.col("rows") - FREE, F.lit(1))) / F.lit(float(MICRO))
    return solved.join(spread.select(*key, sigma.alias("sigma")), key)


def parts(rows: DataFrame, models: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` (key, t) with ``trend`` and ``yearly`` of their group's model, in the unit of the value."""
    found = rows.join(models.select(*key, "t0", "changepoints", "k", "scale", "beta", "top"), key)
    z, scale, beta, unit = design(F.col("t")), F.col("scale"), F.col("beta"), F.col("top") / F.lit(float(UNITS))
    n_trend = F.col("k") + 2
    return found.withColumn("trend", predicted(z, scale, beta, 0, n_trend) * unit).withColumn(
        "yearly", predicted(z, scale, beta, n_trend, F.lit(2 * FOURIER_ORDER)) * unit).drop(
        "t0", "changepoints", "k", "scale", "beta", "top")


def _hex(text: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(text, start, digits), 16, 10).cast("long")


def sampled_band(steps: DataFrame, models: DataFrame, key: list[str], draws: int = DRAWS) -> DataFrame:
    """(key, h, low, high): the 10 % and 90 % points of the draws around the prediction, in the unit of the value.

    ``steps`` has the future months of each group: key, h (1, 2, ...), and the day numbers ``t`` and ``t_before`` of the
    month and of the one before.
    """
    slopes = F.expr("slice(beta, 3, k)")
    size = F.when(F.col("k") > 0, F.aggregate(slopes, F.lit(0.0), lambda a, v: a + F.abs(v)) / F.col("k")).otherwise(F.lit(0.0))
    known = models.select(*key, "t1", "k", "span", "sigma", "top", (size + F.lit(1e-08)).alias("size"))
    rows = steps.join(known, key).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    name = F.concat_ws("|", *key, "draw", "h")
    rows = rows.withColumn("slope_hash", F.md5(F.concat(name, F.lit("|slope")).cast("binary"))).withColumn(
        "noise_hash", F.md5(F.concat(name, F.lit("|noise")).cast("binary")))
    rate = F.col("k") * (F.col("t") - F.col("t_before")) / F.col("span")
    changes = _hex(F.col("slope_hash"), 1, 8) / F.lit(float(1 << 32)) < rate
    uniform = (_hex(F.col("slope_hash"), 10, 7) + F.lit(0.5)) / F.lit(float(1 << 28))
    amount = F.round(F.log(uniform) * F.lit(-float(NANO))).cast("long")
    signed = F.when(_hex(F.col("slope_hash"), 9, 1) < 8, -amount).otherwise(amount)
    rows = rows.withColumn("change", F.when(changes, signed).otherwise(F.lit(0).cast("long")))
    so_far = Window.partitionBy(*key, "draw").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)  # at most 36 or so rows
    rows = rows.withColumn("a", F.sum("change").over(so_far)).withColumn(
        "b", F.sum(F.col("change") * (F.col("t_before") - F.col("t1"))).over(so_far))
    bent = (F.col("a") * (F.col("t") - F.col("t1")) - F.col("b")).cast("double") / F.lit(float(NANO)) * F.col("size") / F.col("span")
    # Box and Muller, to nine decimals
    radius = F.sqrt(F.lit(-2.0) * F.log((_hex(F.col("noise_hash"), 1, 13) + F.lit(0.5)) / F.lit(float(1 << 52))))
    turn = F.cos(_hex(F.col("noise_hash"), 14, 13) / F.lit(float(1 << 52)) * F.lit(2 * math.pi))
    noise = F.round(radius * turn * NANO).cast("long").cast("double") / F.lit(float(NANO)) * F.col("sigma")
    off = (bent + noise) * (F.col("top") / F.lit(float(UNITS)))
    found = rows.groupBy(*key, "h").agg(F.sort_array(F.collect_list(off)).alias("offs"))  # as many as draws

    def point(q: float) -> Column:
        place = q * (draws - 1)
        low = int(place)
        a, b = F.col("offs")[low], F.col("offs")[min(low + 1, draws - 1)]
        return a + F.lit(place - low) * (b - a)

    return found.select(*key, "h", F.least(point(0.1), F.lit(0.0)).alias("low"), F.greatest(point(0.9), F.lit(0.0)).alias("high"))

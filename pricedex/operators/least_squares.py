"""Least squares per group in DataFrame operations: exact sums of products, then a fixed-order elimination on arrays.

Design columns are whole numbers (days, lags in units of the value, sines in millionths), so every sum of products is an
exact long whatever the order of the rows: partial sums are combined before the shuffle and a group of any length is never
gathered. The scaled normal equations are at most a few dozen numbers square; their solution takes the same floating-point
steps in the same order wherever it runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricedex.sources.store import spread

SLOT = 64  # more than the columns of any design


def sums_of_products(rows: DataFrame, key: list[str]) -> DataFrame:
    """Per group a map i * SLOT + j -> sum of z[i] * z[j] (i <= j, i not the last; zero sums may be missing) of ``z``
    array<bigint>. A sum beyond the long range raises an error."""
    left = spread(rows).select(*key, "z", F.posexplode("z").alias("i", "a")).where("a <> 0 AND i < size(z) - 1")
    both = left.select(*key, "i", "a", F.posexplode("z").alias("j", "b")).where("j >= i AND b <> 0")
    sums = both.groupBy(*key, "i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("s"))
    entry = F.struct((F.col("i") * SLOT + F.col("j")).alias("at"), "s")
    return sums.groupBy(*key).agg(F.map_from_entries(F.collect_list(entry)).alias("g"))


def eliminate(matrix: Column, size: Column) -> Column:
    """Solution of the equations [A | b] (rows of size + 1 doubles), the unknowns eliminated in their order.

    Every step sets the first row aside and takes it off the others, which lose their first column; the rows set aside then
    give the unknowns from the last to the first.
    """
    def step(s: Column, _: Column) -> Column:
        pivot = s["rest"][0]
        tail = F.transform(F.slice(pivot, 2, F.size(pivot) - 1), lambda v: v / pivot[0])
        rest = F.transform(F.slice(s["rest"], 2, F.size(s["rest"]) - 1), lambda row: F.zip_with(
            F.slice(row, 2, F.size(row) - 1), tail, lambda v, t: v - row[0] * t))
        return F.struct(rest.alias("rest"), F.concat(s["done"], F.array(tail)).alias("done"))

    start = F.struct(matrix.alias("rest"), F.expr("cast(array() AS array<array<double>>)").alias("done"))
    done = F.aggregate(F.sequence(F.lit(1), size), start, step, lambda s: s["done"])

    def back(found: Column, row: Column) -> Column:  # row: what the unknown's equation has for the later ones, and its right side
        known = ordered_sum(F.zip_with(F.slice(row, 1, F.size(row) - 1), found, lambda a, x: a * x))
        return F.concat(F.array(F.element_at(row, -1) - known), found)

    return F.aggregate(F.reverse(done), F.expr("cast(array() AS array<double>)"), back)


def solve(rows: DataFrame, settings: DataFrame, key: list[str]) -> DataFrame:
    """``settings`` with ``beta`` array<double>: ridge regression of the last entry of ``z`` on the others.

    ``settings`` has one row a group with ``scale`` array<double>, what each entry of ``z`` is divided by, and ``ridge``
    array<double>, what is added to the diagonal of the scaled equations; ``beta`` belongs to the scaled entries.
    """
    size = F.size("ridge")

    def cell(i: Column, j: Column) -> Column:
        total = F.coalesce(F.try_element_at("g", F.least(i, j) * SLOT + F.greatest(i, j)), F.lit(0).cast("long"))
        value = total.cast("double") / (F.col("scale")[i] * F.col("scale")[j])
        return F.when(i == j, value + F.col("ridge")[i]).otherwise(value)

    matrix = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.transform(F.sequence(F.lit(0), size), lambda j: cell(i, j)))
    found = spread(settings.join(sums_of_products(rows, key), key), *key).withColumn("m", matrix)
    return found.withColumn("beta", eliminate(F.col("m"), size)).drop("g", "m")


def ordered_sum(values: Column) -> Column:
    """Sum of an array of doubles from its first entry to its last."""
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def predicted(z: Column, scale: Column, beta: Column, first: Column | int = 0, count: Column | None = None) -> Column:
    """Sum of beta * (z / scale) over ``count`` entries from ``first`` (to beta's last by default), in order."""
    terms = F.zip_with(F.zip_with(z, scale, lambda a, s: a / s), beta, lambda v, b: b * v)
    first = F.lit(first) if isinstance(first, int) else first
    return ordered_sum(F.slice(terms, first + 1, F.size(beta) - first if count is None else count))

"""Pages by key (L01, L02, A16): deep pages of a listing without reading the pages before them.

A listing is written once in its order, ranges of it in files of their own, with an index that has the key of every
``every``-th row. A page looks up the last indexed key at or before its first row and the first at or after its last one,
and reads only the rows between: at most ``every`` rows more than the page on either side, whatever the page's number. The
predicate's first column reaches the Parquet scan, whose files and row groups outside the range are skipped.

The order's columns must be a key of the rows, without nulls. A page beyond the end is empty; a page that reaches beyond it
is short.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.sources.files import read_ordered, write_ordered

EVERY = 1000
Order = list[tuple[str, bool]]  # (column, descending)


def _sorted(order: Order) -> list[Column]:
    return [F.desc(c) if down else F.asc(c) for c, down in order]


def write_listing(rows: DataFrame, path: str, order: Order, every: int = EVERY, files: int | None = None) -> None:
    """The listing below ``path``: rows in order, and the index (position, the order's columns, total number of rows)."""
    spark = rows.sparkSession
    write_ordered(rows, f"{path}/rows", _sorted(order), files)
    placed = read_ordered(spark, f"{path}/rows")
    total = placed.agg(F.count("*").alias("total")).select("total").scalar()
    placed.where(F.col("position") % every == 0).select("position", *[c for c, _ in order], total.alias("total")).write.mode(
        "overwrite").parquet(f"{path}/index")


def _from(order: Order, key) -> Column:
    """Rows at or after ``key`` in the order."""
    whole, same = F.lit(False), F.lit(True)
    for c, down in order:
        whole = whole | (same & ((F.col(c) < F.lit(key[c])) if down else (F.col(c) > F.lit(key[c]))))
        same = same & (F.col(c) == F.lit(key[c]))
    first, down = order[0]
    bound = F.col(first) <= F.lit(key[first]) if down else F.col(first) >= F.lit(key[first])  # alone, for the scan
    return bound & (whole | same)


def _before(order: Order, key) -> Column:
    first, down = order[0]
    bound = F.col(first) >= F.lit(key[first]) if down else F.col(first) <= F.lit(key[first])
    return bound & ~_from(order, key)


def page(spark: SparkSession, path: str, order: Order, limit: int = 100, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit - 1`` of the listing, in order."""
    if not 1 <= int(limit) <= 1000 or int(offset) < 0:
        raise ValueError("limit must be in 1..1000 and offset >= 0")
    key = F.struct("position", *[c for c, _ in order])
    position = F.col("position")
    # one row: the two indexed keys around the page
    around = spark.read.parquet(f"{path}/index").agg(
        F.max_by(key, F.when(position <= offset, position)).alias("low"),
        F.min_by(key, F.when(position >= offset + limit, position)).alias("high")).first()
    rows = spark.read.parquet(f"{path}/rows").drop("part", "place")
    if around.low is None:
        return rows.where(F.lit(False))
    wanted = [_from(order, around.low)] + ([_before(order, around.high)] if around.high is not None else [])
    between = rows.where(reduce(Column.__and__, wanted))
    return between.orderBy(*_sorted(order)).offset(int(offset) - around.low.position).limit(int(limit))


def total_rows(spark: SparkSession, path: str) -> DataFrame:
    """The listing's number of rows, from its index."""
    return spark.read.parquet(f"{path}/index").agg(F.coalesce(F.max("total"), F.lit(0)).alias("total"))

"""Raw source tables -> one unified long table.

Unified schema: obs_date date, area string, category string, value decimal(18,4), source string, base_ref string.
Logical key (obs_date, area, category, source) — enforced by ``first_wins``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricedex import reference_data as R
from pricedex.functions.columns import period_to_date, short_label

UNIFIED_KEY = ["obs_date", "area", "category", "source"]
UNIFIED_COLUMNS = ["obs_date", "area", "category", "value", "source", "base_ref"]


def _ref(df: DataFrame) -> DataFrame:
    # 13 rows: broadcast is always safe.
    return F.broadcast(R.coicop_dim(df.sparkSession))


def _unified(df: DataFrame, date: Column, area: Column, value: Column, source: str, base_ref: str) -> DataFrame:
    return df.select(
        date.alias("obs_date"), area.alias("area"), F.col("label").alias("category"),
        value.cast("decimal(18,4)").alias("value"), F.lit(source).alias("source"), F.lit(base_ref).alias("base_ref"),
    ).where(F.col("obs_date").isNotNull())


def normalise_six_digit(raw: DataFrame, source: str = "ECB", base_ref: str = "2015") -> DataFrame:
    """key = first two digits of a six-digit code; level 1 only (last four digits '0000')."""
    cleaned = raw.where(
        F.col("obs_value").isNotNull() & F.col("time_period").isNotNull() & F.col("ref_area").isNotNull()
        & F.col("coicop").isNotNull() & (F.right(F.col("coicop"), F.lit(4)) == "0000")
    ).withColumn("code", F.substring("coicop", 1, 2))
    joined = cleaned.join(_ref(raw), "code")
    return _unified(joined, period_to_date("time_period"), F.col("ref_area"), F.col("obs_value"), source, base_ref)


def normalise_labelled(raw: DataFrame, source: str = "INSEE", base_ref: str = "2015", area: Column | None = None) -> DataFrame:
    """key = first two characters of the label (rows whose label has no code are dropped)."""
    area = area if area is not None else (F.col("area") if "area" in raw.columns else F.lit("FR"))
    cleaned = raw.where(F.col("value").isNotNull() & F.col("category").isNotNull()).withColumn(
        "code", F.substring("category", 1, 2))
    joined = cleaned.join(_ref(raw), "code")
    return _unified(joined, F.col("obs_date"), area, F.col("value"), source, base_ref)


def normalise_dotted(raw: DataFrame, source: str = "DATAGOUV", base_ref: str = "2025", area: Column | None = None) -> DataFrame:
    """key = the code itself, level 1 only ('^[0-9]{2}$')."""
    area = area if area is not None else (F.col("area") if "area" in raw.columns else F.lit("FR"))
    cleaned = raw.where(
        F.col("value").isNotNull() & F.col("category").isNotNull() & F.col("category").rlike(r"^[0-9]{2}$")
    ).withColumn("code", F.col("category"))
    joined = cleaned.join(_ref(raw), "code")
    return _unified(joined, F.col("obs_date"), area, F.col("value"), source, base_ref)


def normalise_prefixed(raw: DataFrame, source: str = "EUROSTAT", base_ref: str = "2015") -> DataFrame:
    """key = two digits after 'CP', level 1 only ('^CP[0-9]{2}$')."""
    cleaned = raw.where(
        F.col("value").isNotNull() & F.col("area").isNotNull() & F.col("coicop").isNotNull()
        & F.col("coicop").rlike(r"^CP[0-9]{2}$")
    ).withColumn("code", F.substring("coicop", 3, 2))
    joined = cleaned.join(_ref(raw), "code")
    return _unified(joined, F.col("obs_date"), F.col("area"), F.col("value"), source, base_ref)


def first_wins(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key, the row with the smallest ``order_cols`` (then the other columns) wins.

    ``min`` of a struct is lexicographic and combinable, so the dedup is a partial (map-side) aggregate:
    a hot key is reduced in every task before the shuffle and never gathers its rows in one place.
    """
    rest = [c for c in df.columns if c not in key_cols and c not in order_cols]
    if not rest and len(order_cols) == 1:  # plain min: a hash aggregate with a fixed-width buffer
        return df.groupBy(*key_cols).agg(F.min(order_cols[0]).alias(order_cols[0])).select(*df.columns)
    packed = F.min(F.struct(*[F.col(c) for c in order_cols + rest])).alias("_w")
    return df.groupBy(*key_cols).agg(packed).select(*key_cols, *[F.col(f"_w.{c}").alias(c) for c in order_cols + rest]
                                                    ).select(*df.columns)


def unify(*normalised: DataFrame) -> DataFrame:
    """U03 + J05: union of the normalised sources, one row per logical key: the smallest base, then the smallest value."""
    return _one_per_key(reduce(lambda a, b: a.unionByName(b), normalised))


def _one_per_key(rows: DataFrame) -> DataFrame:
    """The smallest value of each key and base (a hash aggregate that does the reducing), then the smallest base."""
    reduced = rows.groupBy(*UNIFIED_KEY, "base_ref").agg(F.min("value").alias("value"))
    return first_wins(reduced.select(*UNIFIED_COLUMNS), UNIFIED_KEY, ["base_ref", "value"])


def anti_join_append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Idempotent append: rows of ``incoming`` whose key is not yet in ``target``, one per key as in ``unify``."""
    return _one_per_key(incoming).join(target.select(*UNIFIED_KEY), UNIFIED_KEY, "left_anti")


def label_series(obs: DataFrame, id_col: str = "series_id", title_col: str = "title") -> DataFrame:
    """Series id -> fixed label (broadcast lookup, 13 rows), falling back to a label parsed from the title."""
    dim = F.broadcast(R.series_label_dim(obs.sparkSession, id_col, "_label"))
    return obs.join(dim, id_col, "left").withColumn(
        "category", F.coalesce(F.col("_label"), short_label(F.col(title_col)))).drop("_label")

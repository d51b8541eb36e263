"""Silver tables as Spark plans over the stand-in raw tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from pricedex.operators.cleaning import clean_prices
from pricedex.operators.normalise import (UNIFIED_COLUMNS, normalise_dotted, normalise_labelled,
                                          normalise_prefixed, normalise_six_digit, unify)
from pricedex.sources import standins as S
from pricedex.sources.store import materialise


UNIFIED_SCHEMA = "obs_date date, area string, category string, value decimal(18,4), base_ref string, source string"


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified table as written once per application (partitioned by source), as the analytic queries read it."""
    return materialise(spark, "unified", (os.path.abspath(sf_dir),), lambda: unified_plan(spark, sf_dir),
                       partition_by=["source"], schema=UNIFIED_SCHEMA, columns=UNIFIED_COLUMNS)


def unified_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four sources normalised, unioned and deduplicated on (obs_date, area, category, source)."""
    return unify(
        normalise_six_digit(S.ecb_raw(spark, sf_dir)),
        normalise_labelled(S.insee_raw(spark, sf_dir)),
        normalise_dotted(S.datagouv_raw(spark, sf_dir)),
        normalise_prefixed(S.eurostat_raw(spark, sf_dir)),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_prices(S.prices_raw(spark, sf_dir))

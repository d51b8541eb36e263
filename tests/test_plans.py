"""Plan shape: pruning and pushdown reach the scans, no cartesian products, no row-at-a-time Python UDF."""

import re

import pytest

import __spark_entry__ as E
from pricedex.sources import standins as S

from conftest import SF_SMALL

# the text operators and their pipeline have their own tests
QUERIES = {k: q for k, q in E.queries().items() if not k.startswith("op") and k != "pipeline"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_base_obs_scans_are_pruned(spark):
    plan = plan_of(S.base_obs_plan(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all("l_shipdate" not in s and "l_comment" not in s for s in lineitem)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_and_no_row_udf(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDF anywhere
    assert "InPandas" not in plan and "ArrowEvalPython" not in plan


def test_source_filter_is_pushed_to_partitioned_stand_in(spark):
    plan = plan_of(S.ecb_raw(spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(prio" in plan and "1-URGENT" in plan


def test_unified_reads_prune_source_partitions(spark):
    from pricedex.plans import tables as T
    plan = plan_of(T.unified(spark, SF_SMALL).where("source = 'EUROSTAT'"))
    assert "PartitionFilters: [isnotnull(source" in plan and "EUROSTAT" in plan


def test_partial_aggregation_before_shuffles(spark):
    """Hot keys are reduced in every task before the exchange: partial aggregates in the stand-in build and in the
    unified dedup, where a hash aggregate (fixed-width min) does the reducing."""
    from pricedex.plans import tables as T

    base = plan_of(S.base_obs_plan(spark, SF_SMALL))
    assert "partial_sum" in base
    unified = plan_of(T.unified_plan(spark, SF_SMALL))
    assert re.search(r"HashAggregate\(keys=\[obs_date[^\n]*functions=\[partial_min\(value", unified)


def test_forecasts_run_without_python(spark):
    """Of the jobs that write: sums, elimination, smoothing and sampling are all native."""
    from pricedex.operators import additive, forecast as FC, monthly
    from pricedex.plans import tables as T

    obs, _ = FC.observations(FC.modelling_series(T.unified(spark, SF_SMALL)), FC.DEFAULT_CUTOFF)
    fits = additive.fit(obs, FC.FIT_KEY)
    grids = monthly.monthly(obs, FC.FIT_KEY)
    for df in (fits, grids, monthly.holt_winters(grids, FC.FIT_KEY), monthly.arima(grids, FC.FIT_KEY),
               FC.forecast(FC.modelling_series(T.unified(spark, SF_SMALL)), horizon=3, models=FC.MODELS)):
        plan = plan_of(df)
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan

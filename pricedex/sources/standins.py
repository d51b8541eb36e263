"""Stand-in raw tables derived from the driver's tables.

The reference lands four index sources (six-digit codes, labelled series, dotted codes, prefixed codes), a shelf-price
feed and a request log. Here they are derived from the TPC-H-like driver tables so that their size grows with the
input:

* ``base_obs`` — one monthly unit-price index per (month, area, order priority, category code, sub-level):
  lineitem ⋈ orders ⋈ part ⋈ customer ⋈ nation, aggregated once. Three order priorities feed a source each, all
  others the fourth, so every line item counts once.
* ``prices_raw`` — one price item per part.
* ``request_log`` — one HTTP request per event.

``base_obs`` is written once per session as a parquet table (partitioned by priority) in the shared folder named by
``spark.checkpoint.dir``; every later query reads it with partition pruning instead of re-running the join. Its size
is bounded by months × areas × priorities × codes × 2, independent of the number of line items.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex import reference_data as R

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
                 "benchmark labels conversations").split()

# Which order priority plays which raw source.
PRIO_ECB = "1-URGENT"
PRIO_INSEE = "2-HIGH"
PRIO_DATAGOUV = "3-MEDIUM"
PRIO_EUROSTAT = "4-NOT SPECIFIED"  # and every other or missing priority

# Part type -> two-digit category code of the stand-in ('STANDARD' plays the overall index '00').
PART_TYPE_CODES = [("ECONOMY", "01"), ("LARGE", "02"), ("MEDIUM", "03"), ("PROMO", "04"), ("SMALL", "05")]
OVERALL_CODE = "00"

BASE_OBS_SCHEMA = "obs_date date, area string, code string, sub int, value decimal(18,4), prio string"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_code(p_type) -> F.Column:
    (t0, c0), *rest = PART_TYPE_CODES
    chain = F.when(p_type == t0, F.lit(c0))
    for t, code in rest:
        chain = chain.when(p_type == t, F.lit(code))
    return chain.otherwise(F.lit(OVERALL_CODE))


def base_obs_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one heavy job: join line items to their order, part, customer and nation, aggregate per month."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("area"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("obs_date"),
        F.when(F.col("o_orderpriority").isin(PRIO_ECB, PRIO_INSEE, PRIO_DATAGOUV), F.col("o_orderpriority"))
        .otherwise(PRIO_EUROSTAT).alias("prio"),
    )
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", part_code(F.col("p_type")).alias("code"), (F.col("p_size") % 2).alias("sub"))
    items = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").cast("bigint").alias("qty"),
    )
    # Joins of large sides are left to Catalyst/AQE: sort-merge at scale, broadcast only when the runtime size
    # is under spark.sql.autoBroadcastJoinThreshold (Spark's own size check). Skewed keys are split by AQE.
    order_dim = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "obs_date", "prio", "area")
    joined = items.join(part, items.l_partkey == part.p_partkey).join(
        order_dim, items.l_orderkey == order_dim.o_orderkey)
    # Integer arithmetic keeps the value exact: price per unit to 4 decimals, truncated (not rounded).
    return joined.groupBy("obs_date", "area", "prio", "code", "sub").agg(
        F.expr("cast(cast((sum(cents) * 100) div sum(qty) as decimal(14,0)) "
               "* cast(0.0001 as decimal(5,4)) as decimal(18,4))").alias("value"))


def base_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base_obs`` as a written table (built on first use in this application, then reused)."""
    from pricedex.sources.store import materialise

    return materialise(spark, "base_obs", (os.path.abspath(sf_dir),), lambda: base_obs_plan(spark, sf_dir),
                       partition_by=["prio"], schema=BASE_OBS_SCHEMA)


def _with_labels(df: DataFrame) -> DataFrame:
    dim = F.broadcast(R.coicop_dim(df.sparkSession))
    return df.join(dim, "code")


# ------------------------------------------------------------------------------------------- raw source stand-ins
def ecb_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-digit-code source: time_period 'YYYY-MM', obs_value, ref_area, coicop ('010000' level 1), unit."""
    b = base_obs(spark, sf_dir).where(F.col("prio") == PRIO_ECB)
    return b.select(
        F.date_format("obs_date", "yyyy-MM").alias("time_period"),
        F.col("value").alias("obs_value"),
        F.col("area").alias("ref_area"),
        F.concat("code", F.when(F.col("sub") == 0, F.lit("0000")).otherwise(F.lit("1000"))).alias("coicop"),
        F.lit("I15").alias("unit"),
    )


def insee_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled source: category 'XX - Label'; sub-level rows carry an 'Ensemble hors …' label (no code)."""
    b = _with_labels(base_obs(spark, sf_dir).where(F.col("prio") == PRIO_INSEE))
    return b.select(
        "obs_date",
        "value",
        F.when(F.col("sub") == 0, F.col("label"))
        .otherwise(F.concat(F.lit("Ensemble hors "), F.col("code"))).alias("category"),
        F.col("label").alias("sub_category"),
        F.concat(F.lit("0017"), F.col("code"), F.col("sub").cast("string")).alias("series_id"),
        F.lit("INSEE").alias("source"),
        "area",
    )


def datagouv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dotted-code source: category '01' (level 1) or '01.1'."""
    b = base_obs(spark, sf_dir).where(F.col("prio") == PRIO_DATAGOUV)
    cat = F.concat("code", F.when(F.col("sub") == 0, F.lit("")).otherwise(F.lit(".1")))
    return b.select(
        "obs_date", "value", cat.alias("category"), F.lit(None).cast("string").alias("sub_category"),
        cat.alias("coicop_code"), F.lit("DATAGOUV").alias("source"), "area",
    )


def eurostat_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefixed-code source: coicop 'CP01' (level 1) or 'CP0111'."""
    b = base_obs(spark, sf_dir).where(F.col("prio") == PRIO_EUROSTAT)
    return b.select(
        "area",
        F.concat(F.lit("CP"), "code", F.when(F.col("sub") == 0, F.lit("")).otherwise(F.lit("11"))).alias("coicop"),
        "obs_date", "value", F.lit("I15").alias("unit"),
    )


def prices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price items (one per part): id, product_code, product_name, category_tag, price, currency, date."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.lpad(F.col("p_partkey").cast("string"), 13, "0").alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit("en:"), F.lower("p_type")).alias("category_tag"),
        F.round(F.col("p_retailprice") - 900, 2).alias("price"),
        F.lit("EUR").alias("currency"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("p_partkey") % 365).cast("int")).alias("date"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API request per event: ts, method, path, status, latency_s, category."""
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    predict_code = F.lpad((F.col("user_id") % 13).cast("string"), 2, "0")
    path = (
        F.when(et == "view", F.lit("/api/inflation"))
        .when(et == "click", F.lit("/api/inflation/sub"))
        .when(et == "purchase", F.concat(F.lit("/api/predict/"), predict_code))
        .when(et == "signup", F.lit("/health"))
        .otherwise(F.lit("/api/prix-alimentaires"))
    )
    err = F.col("event_id") % 4
    status = F.when(et != "error", F.lit(200)).otherwise(
        F.when(err == 0, F.lit(500)).when(err == 1, F.lit(404)).when(err == 2, F.lit(422)).otherwise(F.lit(403)))
    return e.select(
        "ts", F.lit("GET").alias("method"), path.alias("path"), status.alias("status"),
        (F.col("value") / 100).alias("latency_s"),
        F.when(et == "purchase", predict_code).alias("category"),
    )

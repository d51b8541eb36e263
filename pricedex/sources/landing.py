"""Land the stand-in raw tables as files in the reference's raw formats, written by the executors into the shared
table folder. The readers in ``sources.files`` and the cleaning jobs then read them back, so every format is
exercised on data whose size follows the driver tables.

Each call writes to a fresh folder (never reused, never deleted here).
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pricedex.session import shared_table_root
from pricedex.sources import standins as S

WIDE_KEY_HEADER = "freq,unit,coicop,geo\\time"
FLAGGED_MONTH = "1998-03"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_table_root(spark)}/landing/{name}/{uuid.uuid4().hex}"


def land_wide_bulk(spark: SparkSession, sf_dir: str) -> str:
    """Wide gzip TSV: one row per (freq,unit,coicop,area), one column per month ('YYYY-MM ' with a trailing space),
    ':' for missing cells, a provisional flag ' p' on one month, plus a second unit that the reader must drop and a
    series of numbers that do not fit."""
    raw = S.eurostat_raw(spark, sf_dir)
    month = F.date_format("obs_date", "yyyy-MM")
    # Column names need the list of months: bounded by the calendar (a few hundred at most).
    months = sorted(r[0] for r in raw.select(month).distinct().collect())
    cell = F.when(month == FLAGGED_MONTH, F.concat(F.col("value").cast("string"), F.lit(" p"))).otherwise(
        F.col("value").cast("string"))
    i15 = raw.select(F.concat_ws(",", F.lit("M"), F.col("unit"), "coicop", "area").alias("k"),
                     month.alias("m"), cell.alias("c"))
    other_unit = raw.select(F.concat_ws(",", F.lit("M"), F.lit("I05"), "coicop", "area").alias("k"),
                            month.alias("m"), (F.col("value") * 2).cast("string").alias("c"))
    # one series whose cells no index value can have: 21 digits do not fit, the cleaner drops them
    too_large = raw.select(month.alias("m")).distinct().select(
        F.lit("M,I15,CP00,OVERFLOW").alias("k"), "m", F.lit("1" * 21).alias("c"))
    wide = i15.unionByName(other_unit).unionByName(too_large).groupBy("k").pivot("m", months).agg(F.max("c"))
    wide = wide.toDF(WIDE_KEY_HEADER, *[m + " " for m in months])
    path = fresh_path(spark, "wide_bulk")
    (wide.write.option("sep", "\t").option("header", True).option("nullValue", ":")
     .option("compression", "gzip").csv(path))
    return path


def land_long_csv(spark: SparkSession, sf_dir: str) -> str:
    """Long ';' CSV of the dotted-code source in several files: as published (plus rows that each violate one filter:
    unit, index type, territory, product group, frequency, base period), with the columns in another order, without
    the index type, in a legacy encoding, and one with lines that are too long (skipped) or too short (padded)."""
    raw = S.datagouv_raw(spark, sf_dir)
    m = F.month("obs_date")
    base = {
        "IDX_TYPE": F.lit("CPI"), "IND_TYPE": F.lit("IX"), "PRODUCT_GROUP": F.lit("_Z"),
        "COICOP_2018": F.col("category"), "OBS_STATUS": F.lit("A"), "SEASONAL_ADJUST": F.lit("N"),
        "GEO": F.lit("F"), "GEO_OBJECT": F.col("area"), "TPH_CPI": F.lit("_T"), "UNIT_MEASURE": F.lit("IX"),
        "FREQ": F.lit("M"), "DECIMALS": F.lit("2"), "CONF_STATUS": F.lit("F"), "BASE_PER": F.lit("2015"),
        "TIME_PERIOD": F.date_format("obs_date", "yyyy-MM"), "OBS_VALUE": F.col("value").cast("string"),
    }

    def rows(months, columns=tuple(base), **override):
        cols = base | {k: F.lit(v) for k, v in override.items()}
        return raw.where(m.isin(*months)).select(*[cols[k].alias(k) for k in columns])

    published = rows([1, 2, 3, 4])
    for month, override in ((1, {"UNIT_MEASURE": "PC"}), (2, {"IND_TYPE": "GY"}), (3, {"GEO": "D"}),
                            (4, {"PRODUCT_GROUP": "X1"}), (5, {"FREQ": "A"}), (6, {"BASE_PER": "2025"})):
        published = published.unionByName(rows([month], **override))
    files = {"published": (published, "UTF-8"), "reordered": (rows([5, 6, 7], tuple(reversed(base))), "UTF-8"),
             "shorter": (rows([8, 9, 10], tuple(c for c in base if c != "IND_TYPE")), "UTF-8"),
             "legacy": (rows([11, 12], IDX_TYPE="indic\u00e9"), "ISO-8859-1")}
    path = fresh_path(spark, "long_csv")
    for name, (df, encoding) in files.items():
        df.write.option("sep", ";").option("header", True).option("encoding", encoding).csv(f"{path}/file={name}")
    names = list(base)
    good = {**{k: "x" for k in names}, "IND_TYPE": "IX", "GEO": "F", "PRODUCT_GROUP": "_Z", "UNIT_MEASURE": "IX", "FREQ": "M",
            "BASE_PER": "2015", "TIME_PERIOD": "1999-01", "OBS_VALUE": "1"}
    too_long, too_short = ";".join([*good.values(), "more"]), "CPI;IX;_Z"
    body = "\n".join([";".join(names), too_long, too_short, too_short])
    spark.range(1).select(F.lit(body).alias("value")).write.text(f"{path}/file=bad")
    return path


def land_series_csv(spark: SparkSession, sf_dir: str) -> str:
    """Series CSV with untidy headers (spaces, mixed case), integer-looking codes without their leading zeros, an
    extra column the cleaner must drop, and January rows again with a value that does not fit."""
    raw = S.ecb_raw(spark, sf_dir)
    out = raw.select(
        F.col("time_period").alias(" time_period"), F.col("obs_value").cast("string").alias("OBS_VALUE "),
        F.col("ref_area").alias("Ref_Area"), F.col("coicop").cast("int").cast("string").alias("ICP_ITEM"),
        F.col("unit").alias("unit_measure"), F.lit("x").alias("COMMENT"))
    too_large = out.where(F.month(F.to_date(F.concat(F.col(" time_period"), F.lit("-01")))) == 1).withColumn(
        "OBS_VALUE ", F.lit("1e20"))
    out = out.unionByName(too_large)
    path = fresh_path(spark, "series_csv")
    out.write.option("header", True).csv(path)
    return path


def xml_title(category):
    """Title of a series: either the coded-nomenclature form or the country form (both shortened by P17)."""
    return F.when(F.col("category").startswith("Ensemble hors"), F.concat(
        F.lit("Indice des prix - Base 2015 - France - Nomenclature Coicop : "), category, F.lit(" - Séries arrêtées"))
    ).otherwise(F.concat(F.lit("Indice des prix - France - "), category))


def land_sdmx_xml(spark: SparkSession, sf_dir: str) -> str:
    """XML with one <Series> per (series, area) and its <Obs> children; statuses: M in July (to drop), absent in
    August (defaults to A), P in September, A otherwise. Half the series carry a namespace prefix."""
    raw = S.insee_raw(spark, sf_dir)
    m = F.month("obs_date")
    status = F.when(m == 7, F.lit("M")).when(m == 8, F.lit(None)).when(m == 9, F.lit("P")).otherwise(F.lit("A"))
    obs = F.struct(F.date_format("obs_date", "yyyy-MM").alias("_TIME_PERIOD"),
                   F.col("value").cast("string").alias("_OBS_VALUE"), status.alias("_OBS_STATUS"))
    # one group per series: bounded by its months, not by the input size
    series = raw.groupBy(F.col("series_id").alias("_IDBANK"), F.col("area").alias("_REF_AREA"),
                         xml_title(F.col("category")).alias("_TITLE_FR")).agg(
        F.array_sort(F.collect_list(obs)).alias("Obs")).withColumn("_FREQ", F.lit("M"))
    path, plain = fresh_path(spark, "sdmx_xml"), fresh_path(spark, "sdmx_xml_plain")
    series = series.select("_IDBANK", "_FREQ", "_TITLE_FR", "_REF_AREA", "Obs")
    half = F.pmod(F.xxhash64("_IDBANK", "_REF_AREA"), F.lit(2))
    writer = {"rootTag": "StructureSpecificData", "rowTag": "Series"}
    series.where(half == 0).write.format("xml").options(**writer).save(f"{path}/names=plain")
    series.where(half == 1).write.format("xml").options(**writer).save(plain)
    prefixed = F.regexp_replace("value", "<(/?)(Series|Obs)", "<$1m:$2")
    spark.read.text(plain).select(prefixed.alias("value")).write.text(f"{path}/names=prefixed")
    return path


def land_price_json(spark: SparkSession, sf_dir: str) -> str:
    """Price items as one per line, as indented arrays and as pages ``{"items": [...]}`` of a thousand items or fewer."""
    raw = S.prices_raw(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    path = fresh_path(spark, "price_json")
    shape, page = F.col("id") % 3, F.floor(F.col("id") / 1000).alias("page")
    raw.where(shape == 0).write.json(f"{path}/shape=lines/page=0")
    for k, name in ((1, "array"), (2, "items")):
        items = raw.where(shape == k).groupBy(page).agg(F.collect_list(F.struct(*raw.columns)).alias("items"))
        body = F.to_json("items", {"pretty": "true"}) if k == 1 else F.to_json(F.struct("items"))
        items.select("page", body.alias("value")).write.partitionBy("page").text(f"{path}/shape={name}")
    return path

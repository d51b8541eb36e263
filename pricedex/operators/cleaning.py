"""Per-source cleaning jobs (P01-P29). Every job is a lazy DataFrame -> DataFrame composition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricedex.functions.columns import (category_from_tag, flagged_number, period_to_date, to_number, truncate100,
                                        zero_pad)

PRODUCT_URL_PREFIX = "https://example.org/product/"


# ------------------------------------------------------------------------------------------------ generic steps
Steps = list[tuple[str, Column]]


def optional_equals(df: DataFrame, col: str, value: str) -> Column | None:
    """``col == value`` only where the column exists: by the frame's columns, or by row where ``_present``
    lists the columns of the row's file."""
    if col not in df.columns:
        return None
    same = F.coalesce(F.col(col) == value, F.lit(False))
    return same | ~F.array_contains("_present", col) if "_present" in df.columns else same


def apply_steps(df: DataFrame, steps: Steps) -> DataFrame:
    for _, keep in steps:
        df = df.where(F.coalesce(keep, F.lit(False)))
    return df


def step_report(df: DataFrame, steps: Steps) -> DataFrame:
    """Rows in, out and dropped per cleaning step, from one aggregate over the steps the job itself applies."""
    counts, so_far = [F.count(F.lit(1)).alias("s0")], F.lit(True)
    for i, (_, keep) in enumerate(steps, start=1):
        so_far = so_far & F.coalesce(keep, F.lit(False))
        counts.append(F.count_if(so_far).alias(f"s{i}"))
    rows = F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(f"s{i - 1}").alias("rows_in"),
                              F.col(f"s{i}").alias("rows_out")) for i, (name, _) in enumerate(steps, start=1)])
    return df.agg(*counts).select(F.inline(rows)).withColumn("rows_dropped", F.col("rows_in") - F.col("rows_out"))


def present(*cols: str) -> Column:
    """P05 as a condition: none of the columns is null."""
    kept = F.lit(True)
    for c in cols:
        kept = kept & F.col(c).isNotNull()
    return kept


def normalise_header(df: DataFrame, rename: dict[str, str], keep: list[str]) -> DataFrame:
    """Strip + upper-case header names, rename, keep only the wanted columns that are present."""
    df = df.toDF(*[c.strip().upper() for c in df.columns])
    df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
    return df.select(*[c for c in keep if c in df.columns])


# ------------------------------------------------------------------------------------------------ price items
def _typed_prices(raw: DataFrame, url_prefix: str) -> DataFrame:
    return raw.select(
        F.col("product_name").alias("product"), category_from_tag("category_tag").alias("category"),
        to_number("price").alias("_price"), F.col("date").cast("string").try_cast("date").alias("collected_on"),
        F.concat(F.lit(url_prefix), F.col("product_code").cast("string")).alias("url"))


def _price_steps() -> Steps:
    return [("price", present("_price")), ("date", present("collected_on")),
            ("sane_price", F.col("_price").between(0.01, 500))]


def clean_prices(raw: DataFrame, url_prefix: str = PRODUCT_URL_PREFIX) -> DataFrame:
    """P29 (price feed): P09 coerce, P21 url from barcode, P19 category tag, P05 + P20 price sanity."""
    out = apply_steps(_typed_prices(raw, url_prefix), _price_steps())
    return out.select("product", "category", F.col("_price").cast("decimal(10,2)").alias("unit_price"),
                      "collected_on", "url")


def price_report(raw: DataFrame) -> DataFrame:
    return step_report(_typed_prices(raw, PRODUCT_URL_PREFIX), _price_steps())


# ------------------------------------------------------------------------------------------------ wide bulk file
def _keyed_wide(wide: DataFrame) -> tuple[DataFrame, list[str]]:
    """The key column split into its parts, the period columns as strings under trimmed names."""
    periods = [c.strip() for c in wide.columns[1:]]
    renamed = wide.toDF(wide.columns[0], *periods)
    parts = F.split(F.col(wide.columns[0]), ",")
    return renamed.select(
        parts.getItem(0).alias("freq"), parts.getItem(1).alias("unit"), parts.getItem(2).alias("coicop"),
        F.trim(parts.getItem(3)).alias("area"), *[F.col(f"`{p}`").cast("string").alias(p) for p in periods]), periods


def _long_wide(keyed: DataFrame, periods: list[str]) -> DataFrame:
    """One row per key and period, typed; a number that does not fit becomes null."""
    return keyed.unpivot(["freq", "unit", "coicop", "area"], periods, "time_period", "raw").select(
        "area", "coicop", period_to_date("time_period").alias("obs_date"),
        flagged_number("raw").try_cast("decimal(18,4)").alias("value"), "unit")


def _wide_steps(unit: str, areas: list[str] | None) -> Steps:
    kept = [("unit", F.col("unit") == unit)]
    return kept + [("area", F.col("area").isin(*areas))] if areas else kept


def clean_wide_bulk(wide: DataFrame, unit: str = "I15", areas: list[str] | None = None) -> DataFrame:
    """P29 (wide bulk file): P01 split key, P02 filter before unpivot, P03 unpivot, P04 flags, P06 dates, P05.

    Output: area, coicop, obs_date, value, unit.
    """
    keyed, periods = _keyed_wide(wide)
    keyed = apply_steps(keyed, _wide_steps(unit, areas))  # before the unpivot (Expand), not left to pushdown
    return apply_steps(_long_wide(keyed, periods), [("valid_row", present("value", "obs_date"))])


def wide_bulk_report(wide: DataFrame, unit: str = "I15", areas: list[str] | None = None) -> DataFrame:
    """P28 counted in cells (a row of the file is one per period): the job's filters on the unpivoted rows."""
    steps = _wide_steps(unit, areas) + [("valid_row", present("value", "obs_date"))]
    return step_report(_long_wide(*_keyed_wide(wide)), steps)


# ------------------------------------------------------------------------------------------------ long CSV
LONG_CSV_COLUMNS = ["IDX_TYPE", "IND_TYPE", "PRODUCT_GROUP", "COICOP_2018", "OBS_STATUS", "SEASONAL_ADJUST", "GEO",
                    "GEO_OBJECT", "TPH_CPI", "UNIT_MEASURE", "FREQ", "DECIMALS", "CONF_STATUS", "BASE_PER",
                    "TIME_PERIOD", "OBS_VALUE"]


def long_csv_steps(raw: DataFrame) -> Steps:
    """The long-CSV filters in order: P10 monthly-or-all, P12 index unit, P13-P15 optional filters, P11 base-or-all,
    P05 on the typed columns.

    The two "filter or keep all" rules ask whether any row that got so far matches; one pre-pass over the file answers
    both (a scalar subquery: one aggregate whose row is broadcast back).
    """
    monthly, base = F.col("FREQ") == "M", F.col("BASE_PER") == "2015"
    between = [("index_unit", F.col("UNIT_MEASURE") == "IX")]
    for name, col, val in (("index_type", "IND_TYPE", "IX"), ("territory", "GEO", "F"), ("aggregate", "PRODUCT_GROUP", "_Z")):
        if (keep := optional_equals(raw, col, val)) is not None:
            between.append((name, keep))
    based = base
    for _, keep in between:
        based = based & keep
    flags = raw.select(F.struct(F.max(monthly).alias("monthly"), F.max(based).alias("based"),
                                F.max(based & monthly).alias("both")).alias("flags")).scalar()
    has_monthly = F.coalesce(flags["monthly"], F.lit(False))
    has_base = F.coalesce(F.when(has_monthly, flags["both"]).otherwise(flags["based"]), F.lit(False))
    valid = (period_to_date("TIME_PERIOD").isNotNull() & to_number("OBS_VALUE").isNotNull()
             & F.col("COICOP_2018").isNotNull())
    return [("monthly", ~has_monthly | monthly), *between, ("base_2015", ~has_base | base), ("valid_row", valid)]


def clean_long_csv(raw: DataFrame, source: str = "data.gouv.fr", keep_area: str | None = None) -> DataFrame:
    """P29 (long CSV): the steps of ``long_csv_steps``, then P06, P09. Output: obs_date, value, category, source."""
    return apply_steps(raw, long_csv_steps(raw)).select(
        period_to_date("TIME_PERIOD").alias("obs_date"), to_number("OBS_VALUE").alias("value"),
        F.col("COICOP_2018").alias("category"), F.lit(source).alias("source"),
        *([F.col(keep_area).alias("area")] if keep_area else []))


def long_csv_report(raw: DataFrame) -> DataFrame:
    """P28 for the long-CSV job."""
    return step_report(raw, long_csv_steps(raw))


# ------------------------------------------------------------------------------------------------ series CSV
SERIES_RENAME = {"TIME_PERIOD": "time_period", "OBS_VALUE": "obs_value", "REF_AREA": "ref_area",
                 "ICP_ITEM": "coicop", "UNIT_MEASURE": "unit"}


def _typed_series(raw: DataFrame) -> DataFrame:
    df = normalise_header(raw, SERIES_RENAME, list(SERIES_RENAME.values()))
    return df.withColumn("coicop", zero_pad("coicop", 6)).withColumn(
        "obs_value", to_number("obs_value").try_cast("decimal(18,4)"))


SERIES_REQUIRED = ("time_period", "obs_value", "ref_area", "coicop")


def clean_series_csv(raw: DataFrame) -> DataFrame:
    """P29 (series CSV): P07 header, P08 zero-pad, P09 coerce ('-' / '' -> null; too large -> null), P05.

    Output: time_period, obs_value, ref_area, coicop, unit (six-digit raw table).
    """
    return apply_steps(_typed_series(raw), [(c, present(c)) for c in SERIES_REQUIRED])


def series_report(raw: DataFrame) -> DataFrame:
    """P28 for the series-CSV job."""
    return step_report(_typed_series(raw), [(c, present(c)) for c in SERIES_REQUIRED])


# ------------------------------------------------------------------------------------------------ XML series
def _xml_observations(series: DataFrame) -> DataFrame:
    extra = [c for c in ("area",) if c in series.columns]
    return series.select("series_id", "title", *extra, F.explode("obs").alias("o")).select(
        "series_id", "title", *extra, F.col("o.period").alias("period"), F.col("o.value").alias("raw_value"),
        F.coalesce(F.col("o.status"), F.lit("A")).alias("status"))


def _xml_steps() -> Steps:
    return [("status", ~F.col("status").isin("M", "L")), ("value", F.col("raw_value") != ""),
            ("period", F.col("period") != ""), ("date", period_to_date("period").isNotNull())]


def clean_xml_series(series: DataFrame) -> DataFrame:
    """P29 (XML): explode observations, P16 status filter, J06 labels, P06, P18.

    ``series`` has one row per Series element: series_id, title, obs (array<struct<period,value,status>>).
    Output: obs_date, value, category, sub_category, series_id, source.
    """
    from pricedex.operators.normalise import label_series

    labelled = label_series(apply_steps(_xml_observations(series), _xml_steps()))
    return labelled.select(
        period_to_date("period").alias("obs_date"),
        to_number("raw_value").alias("value"),
        truncate100("category").alias("category"),
        truncate100("title").alias("sub_category"),
        "series_id",
        F.lit("INSEE").alias("source"),
        *[c for c in ("area",) if c in series.columns],
    )


def xml_report(series: DataFrame) -> DataFrame:
    """P28 for the XML job, counted in observations."""
    return step_report(_xml_observations(series), _xml_steps())

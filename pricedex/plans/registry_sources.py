"""Registered queries of the sources and cleaning jobs (S01-S12, P01-P29): land a stand-in in its raw format,
read it back with the reader, clean it, compare with the stand-in itself."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from pricedex.operators import cleaning as C
from pricedex.operators.normalise import UNIFIED_KEY, anti_join_append, first_wins
from pricedex.plans import tables as T
from pricedex.plans.registry import W, register
from pricedex.session import parallelism
from pricedex.sources import files as FS
from pricedex.sources import landing as L
from pricedex.sources import standins as S
from pricedex.sources.store import materialise


@register("s01_wide_bulk_clean", W("""
    select area, coicop, obs_date, cast(value as double) as value, unit from eurostat_raw""", "eurostat_raw"))
def _s01(spark, sf):
    wide = FS.read_wide_tsv(spark, L.land_wide_bulk(spark, sf), partitions=parallelism(spark))
    out = C.clean_wide_bulk(wide, unit="I15")
    return out.withColumn("value", F.col("value").cast("double"))


def _long_csv(spark, sf):
    """The landed long CSV, parsed once per application: the job, its pre-pass and its report read the table."""
    return materialise(spark, "long_csv", (os.path.abspath(sf),), lambda: FS.read_long_csv(spark, L.land_long_csv(spark, sf)))


@register("s02_long_csv_clean", W("""
    select obs_date, cast(value as double) as value, category, 'data.gouv.fr' as source, area
    from datagouv_raw""", "datagouv_raw"))
def _s02(spark, sf):
    return C.clean_long_csv(_long_csv(spark, sf), keep_area="GEO_OBJECT")


@register("s03_series_csv_clean", W("""
    select time_period, cast(obs_value as double) as obs_value, ref_area, coicop, unit from ecb_raw""", "ecb_raw"))
def _s03(spark, sf):
    out = C.clean_series_csv(FS.read_series_csv(spark, L.land_series_csv(spark, sf)))
    return out.withColumn("obs_value", F.col("obs_value").cast("double"))


@register("s04_sdmx_xml_clean", W("""
    select obs_date, cast(value as double) as value, category,
           substring(case when category like 'Ensemble hors%'
                          then 'Indice des prix - Base 2015 - France - Nomenclature Coicop : ' || category
                               || ' - Séries arrêtées'
                          else 'Indice des prix - France - ' || category end, 1, 100) as sub_category,
           series_id, 'INSEE' as source, area
    from insee_raw where month(obs_date) <> 7""", "insee_raw"))
def _s04(spark, sf):
    return C.clean_xml_series(FS.read_sdmx_xml(spark, L.land_sdmx_xml(spark, sf)))


@register("s05_price_json_clean", W("""
    select product, category, cast(unit_price as double) as unit_price, collected_on, url from prices""", "prices"))
def _s05(spark, sf):
    out = C.clean_prices(FS.read_price_json(spark, L.land_price_json(spark, sf)))
    return out.withColumn("unit_price", F.col("unit_price").cast("double"))


@register("s06_page_extract", r"""
    select page_id, url,
           nullif(replace(replace(replace(replace(trim(regexp_replace(inner_html, '<[^>]+>', '', 'g')), '&lt;', '<'), '&gt;', '>'),
                  '&quot;', '"'), '&amp;', '&'), '') as product_name,
           'c' || cast(page_id % 7 as varchar) || ' & co' as categories
    from (select page_id, url,
                 case when contains(html, '<h1>')
                      then split_part(split_part(html, '<h1>', 2), '</h1>', 1) else '' end as inner_html from pages)""")
def _s06(spark, sf):
    """The pages have a heading but no product categories: each gets a heading class and a categories paragraph, between
    near misses that must not match."""
    pages = S.read_table(spark, sf, "pages")
    extra = F.concat(F.lit('<h1 class="sub-title-1">x</h1><p id="sub-categories">no</p><p id="categories"> c'),
                     (F.col("page_id") % 7).cast("string"), F.lit(" &amp; co</p>"))
    html = F.concat(extra, F.replace("html", F.lit("<h1>"), F.lit('<h1 class="big title-1">')))
    return FS.extract_product(pages.withColumn("html", html), h1_class="title-1")


@register("s06_page_elements", r"""
    select page_id, url,
           nullif(replace(replace(replace(replace(trim(regexp_replace(inner_html, '<[^>]+>', '', 'g')), '&lt;', '<'), '&gt;', '>'),
                  '&quot;', '"'), '&amp;', '&'), '') as product_name,
           'c' || cast(page_id % 7 as varchar) || ' & co' as categories
    from (select page_id, url,
                 case when contains(html, '<h1>')
                      then split_part(split_part(html, '<h1>', 2), '</h1>', 1) else '' end as inner_html from pages)""")
def _s06_elements(spark, sf):
    """The same pages with upper-case tags, single and no quotes, an inner element around the heading's text, and headings in a
    comment, a script and another tag's attribute, none of which must be found."""
    pages = S.read_table(spark, sf, "pages")
    extra = F.concat(
        F.lit("<!-- <h1 class='title-1'>old</h1> --><SCRIPT>var a = \"<h1 class='title-1'>js</h1>\";</SCRIPT>"
              "<h1 data-note=' class=\"title-1\" '>no</h1><P ID=categories><i> c"),
        (F.col("page_id") % 7).cast("string"), F.lit("</i> &amp; <B>co</B></P>"))
    headed = F.replace(F.replace("html", F.lit("<h1>"), F.lit("<H1 lang=fr\n CLASS = 'big title-1'><span class=\"x>y\">")),
                       F.lit("</h1>"), F.lit("</span></H1 >"))
    return FS.extract_product(pages.withColumn("html", F.concat(extra, headed)), h1_class="title-1")


@register("s09_load_verified", W("select count(*) as rows_written from unified", "unified"))
def _s09(spark, sf):
    """The load counts the rows on the way in and compares them with the table."""
    n = FS.load_table(T.unified(spark, sf), L.fresh_path(spark, "loaded"), partition_by=["source"])
    return spark.range(1).select(F.lit(n).cast("bigint").alias("rows_written"))


@register("s10_payload_kept", W("select 'price items' as feed, count(*) as lines, "
                                "cast(sum(cast(price as decimal(18,2))) as double) as total from prices_raw", "prices_raw"))
def _s10(spark, sf):
    """The landed price feed is copied unchanged, then read from the copies: nothing is lost."""
    landed = L.land_price_json(spark, sf)
    kept = FS.keep_payload(spark, landed, L.fresh_path(spark, "payload"))
    unpacked = L.fresh_path(spark, "payload_files")
    body = F.rtrim(F.decode("content", "UTF-8"), F.lit("\n"))
    (kept.where(F.sha2("content", 256) == F.col("sha256")).select(F.monotonically_increasing_id().alias("copy"),
                                                                 body.alias("value"))
     .write.partitionBy("copy").text(unpacked))
    items = FS.read_price_json(spark, unpacked)
    return items.agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total")).select(
        F.lit("price items").alias("feed"), "lines", "total")


@register("l05_sorted_sink", W("""
    select obs_date, area, category, cast(value as double) as value, source,
           row_number() over (partition by source order by obs_date, area, category) - 1 as position
    from unified where source = 'DATAGOUV'""", "unified"))
def _l05(spark, sf):
    """A sink in one order over several files; the position is the row's place in the order."""
    path = L.fresh_path(spark, "sorted_sink")
    rows = T.unified(spark, sf).where(F.col("source") == "DATAGOUV")
    FS.write_ordered(rows, path, ["obs_date", "area", "category"], files=6)
    return FS.read_ordered(spark, path).select(
        "obs_date", "area", "category", F.col("value").cast("double").alias("value"), "source", "position")


@register("l06_categories_in_order", W("""
    select source, category, row_number() over (order by (source <> 'INSEE')::int, source, category) - 1 as position
    from (select distinct source, category from unified)""", "unified"))
def _l06(spark, sf):
    """The reference source first, then by name: the order of a table read back."""
    path = L.fresh_path(spark, "ordered_categories")
    rows = T.unified(spark, sf).select("source", "category").distinct()
    FS.write_ordered(rows, path, [(F.col("source") != "INSEE").cast("int"), "source", "category"], files=4)
    return FS.read_ordered(spark, path).select("source", "category", "position")


@register("j05_idempotent_append", W("""
    select obs_date, area, category, cast(value as double) as value, source, base_ref from unified
    where source = 'EUROSTAT'""", "unified"))
def _append(spark, sf):
    """An append adds only keys that the table lacks, whatever base the incoming row has."""
    rows = T.unified(spark, sf).where(F.col("source") == "EUROSTAT")
    half = rows.where(F.month("obs_date") <= 6)
    again = rows.withColumn("value", (F.col("value") + F.when(F.month("obs_date") <= 6, 1).otherwise(0)).cast("decimal(18,4)"))
    other_base = rows.withColumn("base_ref", F.lit("2025")).withColumn("value", (F.col("value") - 1).cast("decimal(18,4)"))
    table = half.unionByName(anti_join_append(half, again.unionByName(other_base)))
    return table.withColumn("value", F.col("value").cast("double"))


@register("s12_partition_rebuild", W("""
    select obs_date, area, category, cast(value as double) as value, source, base_ref from unified""", "unified"))
def _s12(spark, sf):
    """A table whose ECB partition is wrong; only that partition is rebuilt (dynamic overwrite)."""
    unified = T.unified(spark, sf)
    path = L.fresh_path(spark, "unified_table")
    wrong = F.when(F.col("source") == "ECB", F.col("value") + 1).otherwise(F.col("value")).cast("decimal(18,4)")
    FS.load_table(unified.withColumn("value", wrong), path, partition_by=["source"])
    ecb_again = first_wins(unified.where(F.col("source") == "ECB"), UNIFIED_KEY, ["value"])
    FS.write_table(ecb_again, path, partition_by=["source"], dynamic=True)
    table = spark.read.parquet(path)
    return table.select("obs_date", "area", "category", F.col("value").cast("double").alias("value"), "source",
                        "base_ref")


def _report_sql(steps: list[tuple[str, str]], counts: str, *ctes: str) -> str:
    """Rows (step_no, step, rows_in, rows_out, rows_dropped); ``counts`` selects s0, s1, ... as one row."""
    parts = [f"select {i} as step_no, '{name}' as step, s{i - 1} as rows_in, s{i} as rows_out, "
             f"s{i - 1} - s{i} as rows_dropped from ({counts})" for i, name in enumerate(steps, start=1)]
    return W(" union all ".join(parts), *ctes)


# the landed file: good rows, six kinds of bad rows by month, two short lines (padded, without a frequency)
_P28_COUNTS = """select n + n1 + n2 + n3 + n4 + n5 + n6 + 2 as s0, n + n1 + n2 + n3 + n4 + n6 as s1,
                        n + n2 + n3 + n4 + n6 as s2, n + n3 + n4 + n6 as s3, n + n4 + n6 as s4, n + n6 as s5,
                        n as s6, n as s7
                 from (select count(*) as n, count(*) filter (where month(obs_date) = 1) as n1,
                              count(*) filter (where month(obs_date) = 2) as n2,
                              count(*) filter (where month(obs_date) = 3) as n3,
                              count(*) filter (where month(obs_date) = 4) as n4,
                              count(*) filter (where month(obs_date) = 5) as n5,
                              count(*) filter (where month(obs_date) = 6) as n6 from datagouv_raw)"""
register("p28_cleaning_report", _report_sql(
    ["monthly", "index_unit", "index_type", "territory", "aggregate", "base_2015", "valid_row"], _P28_COUNTS, "datagouv_raw"))(
    lambda spark, sf: C.long_csv_report(_long_csv(spark, sf)))

register("p28_price_report", _report_sql(["price", "date", "sane_price"], """
    select count(*) as s0, count(price) as s1, count(*) filter (where price is not null and date is not null) as s2,
           count(*) filter (where date is not null and price between 0.01 and 500) as s3 from prices_raw""", "prices_raw"))(
    lambda spark, sf: C.price_report(FS.read_price_json(spark, L.land_price_json(spark, sf))))

register("p28_series_report", _report_sql(["time_period", "obs_value", "ref_area", "coicop"], """
    select n + n1 as s0, n + n1 as s1, n as s2, n as s3, n as s4
    from (select count(*) as n, count(*) filter (where right(time_period, 2) = '01') as n1 from ecb_raw)""", "ecb_raw"))(
    lambda spark, sf: C.series_report(FS.read_series_csv(spark, L.land_series_csv(spark, sf))))

register("p28_xml_report", _report_sql(["status", "value", "period", "date"], """
    select n + n7 as s0, n as s1, n as s2, n as s3, n as s4
    from (select count(*) filter (where month(obs_date) <> 7) as n,
                 count(*) filter (where month(obs_date) = 7) as n7 from insee_raw)""", "insee_raw"))(
    lambda spark, sf: C.xml_report(FS.read_sdmx_xml(spark, L.land_sdmx_xml(spark, sf))))

# cells of the wide file: every (series, month), both units, and one series too large to store
register("p28_wide_report", _report_sql(["unit", "valid_row"], """
    select (2 * keys + 1) * months as s0, (keys + 1) * months as s1, n as s2
    from (select count(distinct (coicop, area)) as keys, count(distinct obs_date) as months, count(*) as n
          from eurostat_raw)""", "eurostat_raw"))(
    lambda spark, sf: C.wide_bulk_report(FS.read_wide_tsv(spark, L.land_wide_bulk(spark, sf))))


@register("s09_verified_publish", W("""
    select source, count(*) as n_rows, 2 as version, false as bad_load_published from unified group by source""", "unified"))
def _s09_publish(spark, sf):
    """S09 + S12: a load that lost rows fails and leaves the version before it readable; the next good one replaces it."""
    root = L.fresh_path(spark, "published")
    rows = T.unified(spark, sf)
    FS.publish(rows.where(F.col("source") != "INSEE"), root, partition_by=["source"])
    try:
        FS.publish(rows, root, partition_by=["source"], expected=rows.count() + 1)
        bad = True
    except FS.PublishError:
        bad = "INSEE" in [r.source for r in FS.published(spark, root).select("source").distinct().collect()]
    FS.publish(rows, root, partition_by=["source"], expected=rows.count())
    return FS.published(spark, root).groupBy("source").agg(F.count("*").alias("n_rows")).withColumns(
        {"version": F.lit(FS.published_version(spark, root)), "bad_load_published": F.lit(bad)})

"""Cleaning rules, one fixture row per rule (meaning of the reference's collection tests)."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from pricedex.functions.columns import (category_from_tag, flagged_number, period_to_date, short_label, slug,
                                        zero_pad)
from pricedex.operators import cleaning as C
from pricedex.sources import files as FS

BASE_ROW = dict(IDX_TYPE="CPI", IND_TYPE="IX", PRODUCT_GROUP="_Z", COICOP_2018="01", OBS_STATUS="A",
                SEASONAL_ADJUST="N", GEO="F", GEO_OBJECT="FRANCE", TPH_CPI="_T", UNIT_MEASURE="IX", FREQ="M",
                DECIMALS="2", CONF_STATUS="F", BASE_PER="2015", TIME_PERIOD="2024-01", OBS_VALUE="119.17")


def rows_df(spark, *overrides):
    rows = [{**BASE_ROW, **o} for o in overrides]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in C.LONG_CSV_COLUMNS))


def test_long_csv_output_columns_and_source(spark):
    out = C.clean_long_csv(rows_df(spark, {}))
    assert out.columns == ["obs_date", "value", "category", "source"]
    r = out.collect()
    assert len(r) == 1 and r[0].source == "data.gouv.fr" and r[0].category == "01"
    assert r[0].obs_date == dt.date(2024, 1, 1) and r[0].value == pytest.approx(119.17)


def test_monthly_filter_keeps_m(spark):
    assert C.clean_long_csv(rows_df(spark, {}, {"FREQ": "A"})).count() == 1


def test_monthly_filter_falls_back_when_no_m(spark):
    assert C.clean_long_csv(rows_df(spark, {"FREQ": "A"}, {"FREQ": "A", "TIME_PERIOD": "2024-02"})).count() == 2


@pytest.mark.parametrize("col,bad", [("UNIT_MEASURE", "PC"), ("IND_TYPE", "GY"), ("GEO", "D"),
                                     ("PRODUCT_GROUP", "X1")])
def test_each_filter_keeps_one_of_two(spark, col, bad):
    assert C.clean_long_csv(rows_df(spark, {}, {col: bad})).count() == 1


def test_optional_filter_skipped_when_column_absent(spark):
    df = rows_df(spark, {}, {"GEO": "D"}).drop("GEO")
    assert C.clean_long_csv(df).count() == 2


def test_base_period_falls_back(spark):
    assert C.clean_long_csv(rows_df(spark, {"BASE_PER": "2025"}, {"BASE_PER": "2025"})).count() == 2
    assert C.clean_long_csv(rows_df(spark, {"BASE_PER": "2025"}, {})).count() == 1


def test_null_value_and_category_dropped(spark):
    df = rows_df(spark, {}, {"OBS_VALUE": None}, {"COICOP_2018": None}, {"OBS_VALUE": "n/a"})
    out = C.clean_long_csv(df)
    assert out.count() == 1 and out.where(F.col("value").isNull()).count() == 0


def test_bad_period_dropped(spark):
    assert C.clean_long_csv(rows_df(spark, {}, {"TIME_PERIOD": "2024-13"}, {"TIME_PERIOD": "x"})).count() == 1


def test_several_categories(spark):
    assert C.clean_long_csv(rows_df(spark, {}, {"COICOP_2018": "02"}, {"COICOP_2018": "03"})).count() == 3


def test_column_helpers(spark):
    df = spark.createDataFrame(
        [("119.8 p", "2024-01", "10000", "en:sweetened-spreads"), (":", " 2024-02 ", "010000", None),
         (": ", "2024-13", "1234567", ""), ("", "bad", "7", "nan")], "raw string, p string, code string, tag string")
    out = df.select(flagged_number("raw").alias("v"), period_to_date("p").alias("d"), zero_pad("code").alias("c"),
                    category_from_tag("tag").alias("t")).collect()
    assert [r.v for r in out] == [119.8, None, None, None]
    assert [r.d for r in out] == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), None, None]
    assert [r.c for r in out] == ["010000", "010000", "1234567", "000007"]
    assert [r.t for r in out] == ["sweetened-spreads", "non-classe", "non-classe", "non-classe"]


def test_short_label_cases(spark):
    df = spark.createDataFrame([
        ("IPC - Base 2015 - France - Nomenclature Coicop : 01 - Alimentation - Séries arrêtées",),
        ("Indice - France - Ensemble hors énergie",), ("Sans marqueur",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(short_label("t")).collect()]
    assert got == ["01 - Alimentation", "Ensemble hors énergie", "Sans marqueur", "inconnu", "inconnu"]


def test_slug(spark):
    df = spark.createDataFrame([("00 - Ensemble",), ("04 - Logement, eau, gaz, électricité",)], "c string")
    got = [r[0] for r in df.select(slug("c")).collect()]
    assert got[0] == "00_ensemble"
    for s in got:
        assert s == s.lower() and " " not in s and "-" not in s and "é" not in s and "," not in s
        assert not s.startswith("_") and not s.endswith("_")


def test_price_bounds(spark):
    raw = spark.createDataFrame(
        [(1, "1", "a", "en:x", p, "EUR", None, "2024-01-15") for p in (None, "0", "0.01", "500", "500.01", "abc")],
        FS.PRICE_ITEM_SCHEMA)
    out = C.clean_prices(raw).collect()
    assert sorted(float(r.unit_price) for r in out) == [0.01, 500.0]
    assert all(r.url == "https://example.org/product/1" for r in out)


def test_price_missing_barcode_keeps_null_url(spark):
    raw = spark.createDataFrame([(1, None, "a", None, "2.5", "EUR", None, "2024-01-15")], FS.PRICE_ITEM_SCHEMA)
    r = C.clean_prices(raw).collect()[0]
    assert r.url is None and r.category == "non-classe"


def test_wide_bulk_file(spark, tmp_dir):
    months = [f"2024-{m:02d}" for m in range(12, 2, -1)]  # 10 periods, descending
    header = "freq,unit,coicop,geo\\time\t" + "\t".join(m + " " for m in months)
    lines = [header]
    for area in ("FR", "DE"):
        for unit in ("I15", "I05"):
            for code in ("CP00", "CP01", "CP0111"):
                cells = []
                for i, _ in enumerate(months):
                    cells.append(":" if i == 0 else (": " if i == 1 else (f"{100 + i}.5 p" if i == 2 else f"{100 + i}")))
                lines.append(f"M,{unit},{code},{area}\t" + "\t".join(cells))
    path = f"{tmp_dir}/bulk.tsv.gz"
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    wide = FS.read_wide_tsv(spark, path)
    out = C.clean_wide_bulk(wide, unit="I15", areas=["FR"])
    assert out.count() == 3 * 8  # 3 codes x (10 periods - ':' - ': ')
    flagged = out.where(F.col("obs_date") == dt.date(2024, 10, 1)).select("value").distinct().collect()
    assert [float(r.value) for r in flagged] == [102.5]
    assert out.where(F.col("area") != "FR").count() == 0


def test_unpivot_row_count_invariant(spark):
    wide = spark.createDataFrame([("M,I15,CP00,FR", "1", None, "3"), ("M,I15,CP01,FR", None, None, "2")],
                                 "k string, `2024-01` string, `2024-02` string, `2024-03` string")
    out = C.clean_wide_bulk(wide)
    assert out.count() == 2 * 3 - 3


def test_xml_series(spark, tmp_dir):
    xml = """<?xml version="1.0" encoding="UTF-8"?>
<message:StructureSpecificData xmlns:message="http://example.org/message">
<Series IDBANK="001763417" FREQ="M" TITLE_FR="x">
  <Obs TIME_PERIOD="2024-01" OBS_VALUE="120.1" OBS_STATUS="A"/>
  <Obs TIME_PERIOD="2024-02" OBS_VALUE="120.2" OBS_STATUS="P"/>
  <Obs TIME_PERIOD="2024-03" OBS_VALUE="120.3" OBS_STATUS="M"/>
  <Obs TIME_PERIOD="2024-04" OBS_VALUE="120.4" OBS_STATUS="L"/>
  <Obs TIME_PERIOD="2024-05" OBS_VALUE="120.5"/>
  <Obs TIME_PERIOD="2024-13" OBS_VALUE="1"/>
  <Obs TIME_PERIOD="2024-06" OBS_VALUE=""/>
</Series>
<Series IDBANK="999" FREQ="M" TITLE_FR="IPC - Base 2015 - France - Nomenclature Coicop : 12 - Divers - Séries arrêtées">
  <Obs TIME_PERIOD="2024-01" OBS_VALUE="99.5"/>
</Series>
</message:StructureSpecificData>"""
    path = f"{tmp_dir}/series.xml"
    with open(path, "w", encoding="utf-8") as f:
        f.write(xml)
    out = C.clean_xml_series(FS.read_sdmx_xml(spark, path)).orderBy("series_id", "obs_date").collect()
    assert [(r.series_id, r.obs_date.month) for r in out] == [
        ("001763417", 1), ("001763417", 2), ("001763417", 5), ("999", 1)]
    assert out[0].category == "01 - Alimentation et boissons non alcoolisées"
    assert out[-1].category == "12 - Divers"


def test_series_csv(spark, tmp_dir):
    path = f"{tmp_dir}/series.csv"
    with open(path, "w") as f:
        f.write(" time_period ,OBS_VALUE,ref_area,ICP_ITEM,UNIT_MEASURE,EXTRA\n")
        f.write("2024-01,120.5,FR,10000,INX,x\n2024-02,-,FR,10000,INX,x\n2024-03,,FR,0,INX,x\n")
    out = C.clean_series_csv(FS.read_series_csv(spark, path)).collect()
    assert len(out) == 1 and out[0].coicop == "010000" and float(out[0].obs_value) == 120.5
    assert out[0].asDict().keys() == {"time_period", "obs_value", "ref_area", "coicop", "unit"}


def _lines_file(path, header, rows, encoding="utf-8"):
    with open(path, "wb") as f:
        f.write("\n".join([";".join(header)] + [";".join(r) for r in rows]).encode(encoding))


def test_each_file_has_its_own_encoding(spark, tmp_dir):
    for name, area, encoding in (("a", "Électricité – œuf €", "cp1252"), ("b", "Épicerie œ €", "utf-8")):
        _lines_file(f"{tmp_dir}/{name}.csv", C.LONG_CSV_COLUMNS,
                    [[{**BASE_ROW, "GEO_OBJECT": area}[c] for c in C.LONG_CSV_COLUMNS]], encoding)
    got = {r.GEO_OBJECT for r in FS.read_long_csv(spark, tmp_dir).collect()}
    assert got == {"Électricité – œuf €", "Épicerie œ €"}


def test_columns_by_name_and_absent_columns(spark, tmp_dir):
    turned = list(reversed(C.LONG_CSV_COLUMNS))
    _lines_file(f"{tmp_dir}/turned.csv", ["\ufeff" + turned[0], *turned[1:]], [[BASE_ROW[c] for c in turned]])
    shorter = [c for c in C.LONG_CSV_COLUMNS if c not in ("IND_TYPE", "GEO", "PRODUCT_GROUP")]
    _lines_file(f"{tmp_dir}/shorter.csv", shorter, [[BASE_ROW[c] for c in shorter]] * 2)
    _lines_file(f"{tmp_dir}/no_header.csv", ["x", "y"], [["1", "2"]])
    raw = FS.read_long_csv(spark, tmp_dir)
    assert raw.count() == 3 and raw.where("IND_TYPE is null").count() == 2
    assert C.clean_long_csv(raw).count() == 3  # P13-P15 do not apply where a file lacks the column


def test_malformed_lines_whatever_the_projection(spark, tmp_dir):
    row = [BASE_ROW[c] for c in C.LONG_CSV_COLUMNS]
    _lines_file(f"{tmp_dir}/bad.csv", C.LONG_CSV_COLUMNS,
                [row, [*row, "extra"], ["only", "three", "fields"], ['"quoted;field"', *row[1:]], [""]])
    raw = FS.read_long_csv(spark, tmp_dir)
    assert raw.count() == len(raw.collect()) == raw.select("FREQ").count() == 3  # too long: skipped; short: padded
    assert C.clean_long_csv(raw).count() == 2
    report = {r.step: (r.rows_in, r.rows_out) for r in C.long_csv_report(raw).collect()}
    assert report["monthly"] == (3, 2) and report["valid_row"] == (2, 2)


def test_numbers_that_do_not_fit_are_null(spark):
    wide = spark.createDataFrame([("M,I15,CP00,FR", "123456789012345678901", "3")], "k string, `2024-01` string, `2024-02` string")
    assert [float(r.value) for r in C.clean_wide_bulk(wide).collect()] == [3.0]
    series = spark.createDataFrame([("2024-01", "1e20", "FR", "1", "I"), ("2024-01", "2", "FR", "1", "I")],
                                   "TIME_PERIOD string, OBS_VALUE string, REF_AREA string, ICP_ITEM string, UNIT_MEASURE string")
    assert C.clean_series_csv(series).count() == 1


def test_prefixed_xml_names(spark, tmp_dir):
    with open(f"{tmp_dir}/s.xml", "w") as f:
        f.write('<m:Root xmlns:m="urn:m">\n<m:Series IDBANK="1" TITLE_FR="x"><m:Obs TIME_PERIOD="2024-01" OBS_VALUE="5"/>'
                '</m:Series>\n<Series IDBANK="2" TITLE_FR="y"><Obs TIME_PERIOD="2024-02" OBS_VALUE="6"/></Series>\n</m:Root>')
    got = {r.series_id: r.obs[0].value for r in FS.read_sdmx_xml(spark, f"{tmp_dir}/s.xml").collect()}
    assert got == {"1": "5", "2": "6"}


def test_price_json_shapes(spark, tmp_dir):
    import json

    items = [{"id": i, "product_code": str(i), "price": 1.5, "date": "2024-01-01"} for i in range(6)]
    bodies = {"lines": "\n".join(map(json.dumps, items[:2])), "array": json.dumps(items[2:4], indent=2),
              "page": json.dumps({"items": items[4:]})}
    for name, body in bodies.items():
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(body)
    assert sorted(r.id for r in FS.read_price_json(spark, tmp_dir).collect()) == list(range(6))


def test_tag_is_judged_after_stripping(spark):
    df = spark.createDataFrame([("en:nan",), ("en:None",), ("en:",), ("fr:jus",)], "t string")
    assert [r[0] for r in df.select(category_from_tag("t")).collect()] == ["non-classe"] * 3 + ["jus"]


def test_url_prefix_is_a_parameter(spark):
    raw = spark.createDataFrame([(1, "7", "a", None, "2.5", "EUR", None, "2024-01-15")], FS.PRICE_ITEM_SCHEMA)
    assert C.clean_prices(raw, url_prefix="https://shop.example/p/").first().url == "https://shop.example/p/7"


def test_load_is_verified_and_payload_kept(spark, tmp_dir):
    df = spark.range(10)
    assert FS.load_table(df, f"{tmp_dir}/t") == 10
    with open(f"{tmp_dir}/in.bin", "wb") as f:
        f.write(b"\x00raw\xff")
    kept = FS.keep_payload(spark, f"{tmp_dir}/in.bin", f"{tmp_dir}/kept").first()
    assert bytes(kept.content) == b"\x00raw\xff" and kept.length == 5


def test_row_report(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "v int, c string")
    got = C.step_report(df, [("v", C.present("v")), ("c", C.present("c"))]).collect()
    assert [(r.step, r.rows_in, r.rows_out, r.rows_dropped) for r in got] == [("v", 3, 2, 1), ("c", 2, 1, 1)]


def test_page_extract(spark):
    pages = spark.createDataFrame([
        (1, "u", '<h1 class="title-1 big">Nutella <b>400g</b></h1><p id="categories">Pâtes à tartiner</p>'),
        (2, "u", "<h1>Other</h1>"), (3, "u", "<p>nothing</p>")], "page_id long, url string, html string")
    out = {r.page_id: r for r in FS.extract_product(pages).collect()}
    assert out[1].product_name == "Nutella 400g" and out[1].categories == "Pâtes à tartiner"
    assert out[2].product_name is None and out[3].categories is None
    anyh1 = {r.page_id: r.product_name for r in FS.extract_product(pages, h1_class=None).collect()}
    assert anyh1[2] == "Other"


def test_long_csv_of_any_width_and_quoting(spark, tmp_dir):
    names = [f"X{i}" for i in range(280)] + ["TIME_PERIOD", "OBS_VALUE", "FREQ", "COICOP_2018", "GEO_OBJECT"]
    values = [str(i) for i in range(280)]
    lines = [";".join(names), ";".join([*values, "2024-01", "1.5", "M", '"01;1"', '"a ""quoted"" name"']),
             ";".join([*values, "2024-02", "", "M", "02", '""']), ";".join([*values, "2024-03", "2", "M"]),
             ";".join([*values, "2024-04", "2", "M", "03", "x", "one too many"])]
    with open(f"{tmp_dir}/wide.csv", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    got = {r.TIME_PERIOD: r for r in FS.read_long_csv(spark, tmp_dir).collect()}
    assert set(got) == {"2024-01", "2024-02", "2024-03"}
    assert got["2024-01"].COICOP_2018 == "01;1" and got["2024-01"].GEO_OBJECT == 'a "quoted" name'
    assert got["2024-02"].OBS_VALUE is None and got["2024-02"].GEO_OBJECT == ""
    assert got["2024-03"].COICOP_2018 is None and got["2024-03"].IDX_TYPE is None
    assert len(got["2024-01"]._present) == 285


def test_publish_keeps_the_old_version_until_a_load_is_verified(spark, tmp_dir):
    root = tmp_dir + "/t"
    assert FS.published_version(spark, root) == 0
    with pytest.raises(FS.PublishError):
        FS.published(spark, root)
    assert FS.publish(spark.range(5), root) == 1
    old = FS.published(spark, root)
    with pytest.raises(FS.PublishError):
        FS.publish(spark.range(7), root, expected=8)
    assert FS.published_version(spark, root) == 1 and FS.published(spark, root).count() == 5
    assert FS.publish(spark.range(7), root, expected=7) == 2
    assert FS.published(spark, root).count() == 7 and old.count() == 5  # a reader of the old version goes on


def test_page_elements_of_any_form(spark):
    pages = [(1, "<!-- <h1 class='title-1'>old</h1> --><H1 CLASS='big title-1'>Pâte <span class=\"a>b\">à <b>tartiner</b></span> &lt;1</H1>tail"),
             (2, "<h1 class=title-1>a<h1>inner</h1>b</h1>c"), (3, "<h1 class='title-10'>no</h1>"), (4, None), (5, ""),
             (6, "<h1 class='title-1'>not closed <i>at all"), (7, "<script><h1 class='title-1'>x</h1></script><p id='a categories'>1 < 2</p>"),
             (8, "<!-- open comment <h1 class='title-1'>x</h1>"), (9, "x" * 300_000 + "<h1 a='" + "y" * 100_000 + "' class='title-1'>far</h1>"),
             (10, "<h1x class='title-1'>no</h1x><h1\nclass = 'title-1'\n>yes</h1\n>")]
    df = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string")
    got = {r.page_id: r for r in FS.extract_product(df).collect()}
    assert [got[i].product_name for i, _ in pages] == ["Pâte à tartiner <1", "ainnerb", None, None, None, "not closed at all", None, None,
                                                       "far", "yes"]
    assert got[7].categories == "1 < 2"
    tokens = df.where("html is not null").select("html", F.array_join(FS.html_tokens(F.col("html")), "").alias("again")).collect()
    assert all(r.html == r.again for r in tokens)


def test_price_feeds_of_any_form_and_split(spark, tmp_dir):
    import json

    def item(i, **more):
        return {"id": i, "product_name": f'a "quoted" {{brace}} \\\\ {i}, [x] }}', "price": "1.5", **more}

    def names(items):
        return sorted((d["id"], d["product_name"]) for d in items)

    flat, nested = [item(i) for i in range(400)], [item(1000 + i, extra={"a": {"b": "}{"}, "c": [1, {"d": 2}]}) for i in range(300)]
    forms = {"lines": "\n".join(json.dumps(d) for d in flat[:100]) + "\n", "array": json.dumps(flat[100:200]),
             "indented": json.dumps(flat[200:300], indent=2), "page": json.dumps({"items": flat[300:400], "total": 100}),
             "nested": json.dumps(nested[:100]), "page2": json.dumps({"page": 3, "items": nested[100:200], "meta": {"a": {"b": 1}}, "n": 1}),
             "lines2": "\n".join(json.dumps(d) for d in nested[200:]), "empty": "", "none": "[]", "nopage": '{"items": [], "total": 0}'}
    for name, text in forms.items():
        with open(f"{tmp_dir}/{name}.json", "w", encoding="utf-8") as f:
            f.write(text)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in (before, "2000"):  # one split a file, and many
            spark.conf.set(key, size)
            got = FS.read_price_json(spark, tmp_dir).collect()
            assert sorted((r.id, r.product_name) for r in got) == names(flat + nested)
        assert spark.read.option("lineSep", "}").text(f"{tmp_dir}/array.json").rdd.getNumPartitions() > 3
    finally:
        spark.conf.set(key, before)

"""Normalisation joins, first-wins dedup and idempotent append."""

import datetime as dt

from pyspark.sql import functions as F

from pricedex import reference_data as R
from pricedex.operators import normalise as N

D = dt.date(2024, 1, 1)


def test_reference_dimension_has_13_codes():
    codes = [c for c, _ in R.COICOP_LEVEL1]
    assert codes == [f"{i:02d}" for i in range(13)]
    assert all(label.startswith(code + " - ") for code, label in R.COICOP_LEVEL1)


def test_six_digit_level1_only(spark):
    raw = spark.createDataFrame([("2024-01", 101.5, "FR", "010000", "I15"), ("2024-01", 1.0, "FR", "011000", "I15"),
                                 ("2024-01", None, "FR", "020000", "I15"), ("bad", 3.0, "FR", "030000", "I15"),
                                 ("2024-01", 2.0, "FR", "990000", "I15")],
                                "time_period string, obs_value double, ref_area string, coicop string, unit string")
    out = N.normalise_six_digit(raw).collect()
    assert [(r.category, float(r.value), r.source, r.base_ref) for r in out] == [
        ("01 - Alimentation et boissons non alcoolisées", 101.5, "ECB", "2015")]
    assert out[0].obs_date == D


def test_labelled_drops_uncoded_labels(spark):
    raw = spark.createDataFrame([(D, 1.0, "01 - Alimentation"), (D, 2.0, "Ensemble hors énergie"), (D, None, "02 - x")],
                                "obs_date date, value double, category string")
    out = N.normalise_labelled(raw).collect()
    assert [(r.category, r.area) for r in out] == [("01 - Alimentation et boissons non alcoolisées", "FR")]


def test_dotted_and_prefixed_level1(spark):
    dotted = spark.createDataFrame([(D, 1.0, "01"), (D, 2.0, "01.1"), (D, 3.0, "1")],
                                   "obs_date date, value double, category string")
    assert [r.base_ref for r in N.normalise_dotted(dotted).collect()] == ["2025"]
    pref = spark.createDataFrame([("FR", "CP01", D, 1.0), ("FR", "CP0111", D, 2.0), ("FR", "XP01", D, 3.0)],
                                 "area string, coicop string, obs_date date, value double")
    assert [r.category[:2] for r in N.normalise_prefixed(pref).collect()] == ["01"]


def _unified(spark, rows):
    return spark.createDataFrame(rows, "obs_date date, area string, category string, value decimal(18,4), "
                                       "source string, base_ref string")


def test_first_wins_smallest_value_and_idempotent(spark):
    from decimal import Decimal
    u = _unified(spark, [(D, "FR", "c", Decimal("2"), "S", "2015"), (D, "FR", "c", Decimal("1"), "S", "2015"),
                         (D, "DE", "c", Decimal("5"), "S", "2015")])
    once = N.first_wins(u, N.UNIFIED_KEY, ["value"])
    twice = N.first_wins(once, N.UNIFIED_KEY, ["value"])
    assert sorted((r.area, float(r.value)) for r in once.collect()) == [("DE", 5.0), ("FR", 1.0)]
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.columns == u.columns


def test_anti_join_append(spark):
    from decimal import Decimal
    target = _unified(spark, [(D, "FR", "c", Decimal("1"), "S", "2015")])
    incoming = _unified(spark, [(D, "FR", "c", Decimal("9"), "S", "2015"), (D, "DE", "c", Decimal("3"), "S", "2015"),
                                (D, "DE", "c", Decimal("4"), "S", "2015")])
    out = N.anti_join_append(target, incoming).collect()
    assert [(r.area, float(r.value)) for r in out] == [("DE", 3.0)]


def test_series_label_fallback(spark):
    obs = spark.createDataFrame([("001759970", "t"), ("x", "IPC - France - Nomenclature Coicop : 09 - Loisirs"),
                                 ("y", None)], "series_id string, title string")
    out = dict((r.series_id, r.category) for r in N.label_series(obs).collect())
    assert out == {"001759970": "00 - Ensemble", "x": "09 - Loisirs", "y": "inconnu"}


def test_base_rule_is_evaluated_after_previous_filters(spark):
    from pricedex.operators import cleaning as C
    row = {c: "x" for c in C.LONG_CSV_COLUMNS} | {"UNIT_MEASURE": "IX", "IND_TYPE": "IX", "GEO": "F", "PRODUCT_GROUP": "_Z",
                                                  "FREQ": "M", "TIME_PERIOD": "2024-01", "OBS_VALUE": "1"}
    rows = [row | {"BASE_PER": "2015", "UNIT_MEASURE": "PC"}, row | {"BASE_PER": "2025"}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], list(row))
    # the only 2015 row falls to an earlier filter: no 2015 row is left, so all remaining rows stay
    assert C.clean_long_csv(df).count() == 1


def test_one_row_per_key_whatever_the_base(spark):
    from decimal import Decimal
    u = _unified(spark, [(D, "FR", "c", Decimal("2"), "S", "2015"), (D, "FR", "c", Decimal("1"), "S", "2025")])
    assert [(float(r.value), r.base_ref) for r in N.unify(u).collect()] == [(2.0, "2015")]
    assert N.anti_join_append(u.where("base_ref = '2015'"), u.where("base_ref = '2025'")).count() == 0


def test_unified_structure(spark):
    """Four sources, base year per source, only level-1 normalised labels, unique logical key."""
    from conftest import SF_SMALL
    from pricedex.plans import tables as T

    u = T.unified(spark, SF_SMALL)
    bases = {(r.source, r.base_ref) for r in u.select("source", "base_ref").distinct().collect()}
    assert bases == {("ECB", "2015"), ("INSEE", "2015"), ("DATAGOUV", "2025"), ("EUROSTAT", "2015")}
    labels = {label for _, label in R.COICOP_LEVEL1}
    assert {r.category for r in u.select("category").distinct().collect()} <= labels
    assert u.groupBy(*N.UNIFIED_KEY).count().where("count > 1").count() == 0
    assert u.count() == T.unified_plan(spark, SF_SMALL).count()


def test_parameter_validation(spark):
    """Page limits 1..1000 with offset >= 0, top-N within 1..13 (rejected like the reference's endpoints)."""
    import pytest

    from decimal import Decimal
    from pricedex.operators import analytics as A

    u = _unified(spark, [(D, "FR", "c", Decimal("1"), "S", "2015")])
    for kwargs in ({"limit": 0}, {"limit": 1001}, {"offset": -1}):
        with pytest.raises(ValueError):
            A.index_page(u, **kwargs)
    for n in (0, 14):
        with pytest.raises(ValueError):
            A.top_n_categories(u, "S", n=n)
    assert A.index_page(u, limit=1000).count() == 1 and A.top_n_categories(u, "S", n=13).count() == 1


def test_ordered_sink_over_several_files(spark, tmp_dir):
    from pyspark.sql import functions as F

    from pricedex.sources import files as FS

    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), F.lit("x").alias("v")).repartition(5)
    FS.write_ordered(rows, tmp_dir + "/t", ["k"], files=6)
    table = spark.read.parquet(tmp_dir + "/t")
    assert table.select("part").distinct().count() >= 4
    assert table.groupBy("part").count().agg(F.max("count")).first()[0] < 10_000
    found = FS.read_ordered(spark, tmp_dir + "/t")
    got = [(r.position, r.k) for r in found.collect()]
    assert sorted(got) == list(enumerate(sorted(r.k for r in rows.collect())))
    FS.write_ordered(rows.limit(0), tmp_dir + "/empty", ["k"])
    assert FS.read_ordered(spark, tmp_dir + "/empty").collect() == []


def test_pages_by_key_equal_offsets_and_read_little(spark, tmp_dir):
    import datetime as dt

    from pyspark.sql import functions as F

    from pricedex.operators import pages as PG

    order = [("day", True), ("name", False), ("k", False)]
    rows = spark.range(5000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 40 * F.col("id") % 7 * 6).cast("int")).alias("day"),
        F.concat(F.lit("n"), F.col("id") % 3).alias("name"), F.col("id").alias("k"))
    PG.write_listing(rows, tmp_dir + "/l", order, every=100, files=6)
    expected = [tuple(r) for r in rows.orderBy(F.desc("day"), "name", "k").collect()]
    for offset, limit in ((0, 20), (95, 10), (100, 100), (2490, 250), (4990, 100), (5000, 10), (9999, 1)):
        found = PG.page(spark, tmp_dir + "/l", order, limit, offset)
        assert [tuple(r) for r in found.select("day", "name", "k").collect()] == expected[offset: offset + limit]
    assert PG.total_rows(spark, tmp_dir + "/l").first().total == 5000
    plan = PG.page(spark, tmp_dir + "/l", order, 20, 2400)._jdf.queryExecution().executedPlan().toString()
    assert "(day," in plan[plan.index("PushedFilters"):]
    PG.write_listing(rows.limit(0), tmp_dir + "/e", order)
    assert PG.page(spark, tmp_dir + "/e", order).collect() == [] and PG.total_rows(spark, tmp_dir + "/e").first().total == 0

"""KPI properties and the equality of the two physical shapes."""

from pyspark.sql import functions as F

from occurlens import constants as C
from occurlens.operators import kpis as K
from occurlens.schema import KPI_KEYS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_one_pass_equals_per_table(spark, clean_small):
    one_pass = K.compute_kpis(clean_small)
    for name in K.KPI_FUNCTIONS:
        assert rows(one_pass[name]) == rows(K.kpi(clean_small, name)), name


def test_annual_total_is_clean_count(clean_small):
    annual = K.kpi_annual_summary(clean_small)
    assert annual.agg(F.sum("total")).first()[0] == clean_small.count()


def test_monthly_not_above_annual(clean_small):
    a = K.kpi_annual_summary(clean_small).select("ano", "tipo_crime", F.col("total").alias("a"))
    m = K.kpi_monthly(clean_small).groupBy("ano", "tipo_crime").agg(F.sum("total").alias("m"))
    assert m.join(a, ["ano", "tipo_crime"]).filter(F.col("m") > F.col("a")).count() == 0


def test_hour_table_dense(clean_small):
    hour = K.kpi_by_hour(clean_small)
    counts = hour.groupBy("ano", "tipo_crime").count().select("count").distinct().collect()
    assert [r[0] for r in counts] == [24]


def test_period_is_hours_rolled_up(clean_small):
    from occurlens.functions import period

    hour = K.kpi_by_hour(clean_small).filter(F.col("ano").isNotNull())
    rolled = hour.groupBy("ano", period("hora").alias("periodo"), "tipo_crime").agg(F.sum("total").alias("total"))
    assert rows(rolled.select("ano", "periodo", "tipo_crime", F.col("total").cast("long"))) == \
        rows(K.kpi_by_period(clean_small).filter(F.col("ano").isNotNull()))


def test_keys_unique(clean_small):
    for name, df in K.compute_kpis(clean_small).items():
        keys = KPI_KEYS[name]
        assert df.groupBy(*keys).count().filter("count > 1").count() == 0, name


def test_top_n_keeps_ties_and_at_least_min(spark):
    df = spark.createDataFrame(
        [(2020, f"m{i}", "Furto") for i in range(5) for _ in range(10 - i)]
        + [(2020, "tie", "Furto")] * 6, "ano int, municipio string, tipo_crime string")
    out = K.kpi_by_municipality(df, n=3)
    got = sorted((r["municipio"], r["total"]) for r in out.collect())
    assert got == [("m0", 10), ("m1", 9), ("m2", 8)]
    out = K.kpi_by_municipality(df, n=5)  # m4 and tie share rank 5: both kept
    assert sorted(r["municipio"] for r in out.collect()) == ["m0", "m1", "m2", "m3", "m4", "tie"]


def test_yoy_skips_missing_years(spark):
    df = spark.createDataFrame([(2017, "Furto")] * 4 + [(2019, "Furto")] * 5 + [(2019, "Roubo")] * 2,
                               "ano int, tipo_crime string")
    got = {(r["ano"], r["tipo_crime"]): r["variacao_yoy_pct"] for r in K.kpi_annual_summary(df).collect()}
    assert got == {(2017, "Furto"): None, (2019, "Furto"): 25.0, (2019, "Roubo"): None}


def test_null_year_hours_are_zero(spark):
    df = spark.createDataFrame([(None, "Furto", 3), (2020, "Furto", 3)], "ano int, tipo_crime string, hora int")
    hour = K.kpi_by_hour(df)
    null_year = hour.filter(F.col("ano").isNull()).agg(F.sum("total")).first()[0]
    assert null_year == 0
    assert hour.filter((F.col("ano") == 2020) & (F.col("hora") == 3)).first()["total"] == 1
    from occurlens.schema import CLEAN_SCHEMA
    full = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in CLEAN_SCHEMA.fields])
    grouped = K.compute_kpis(full, materialize=False)[C.KPI_HOUR]
    assert rows(grouped) == rows(hour.select(*K.KPI_COLUMNS[C.KPI_HOUR]))


def test_cards_text_and_empty_guard(spark):
    import pytest
    from occurlens.operators import views as V

    annual = spark.createDataFrame([(2020, "Furto", 1234567, None), (2021, "Furto", 1500000, 21.5),
                                    (2021, "Roubo", 10, None)],
                                   "ano int, tipo_crime string, total long, variacao_yoy_pct double")
    text = V.cards_text(V.cards(annual)).first()
    assert text["total_txt"] == "2.734.577" and text["roubos_txt"] == "10"
    assert text["variacao_txt"].startswith("+") and text["variacao_txt"].endswith("%")
    with pytest.raises(ValueError):
        V.require_rows(annual.limit(0), "kpi_annual_summary")

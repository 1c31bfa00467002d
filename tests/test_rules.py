"""Unit tests of the row-level rules on hand-made values (edge cases)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from occurlens import functions as FN
from occurlens.operators import clean as CL


def one(spark, col, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def test_tolerant_int(spark):
    got = one(spark, FN.tolerant_int, ["2024", "2024.0", "7.6", "-7.6", "", "NULL", " 12 ", None, "99999999999"])
    assert got == [2024, 2024, 7, -7, None, None, 12, None, None]


def test_tolerant_double_keeps_zero(spark):
    assert one(spark, FN.tolerant_double, ["0", "-23.55", "", "abc"]) == [0.0, -23.55, None, None]


def test_parse_hour(spark):
    got = one(spark, FN.parse_hour, ["07:30:00", "7:30", "24:30:00", "25:00", "730", "", "NULL", "ab:cd", None])
    assert got == [7, 7, 24, 25, None, None, None, None, None]


def test_parse_date_formats(spark):
    got = one(spark, FN.parse_date, ["2024-01-15 00:00:00", "2024-01-15", "15/01/2024", "2024-02-30",
                                     "15-01-2024", "", "NULL", "2024/01/15", None])
    assert got == [dt.date(2024, 1, 15)] * 3 + [None] * 6


def test_clean_text_null_tokens(spark):
    got = one(spark, FN.clean_text, ["  S.PAULO  ", "NULL", "null", "N/D", "n/d", "", "   ", "\tX", None])
    assert got == ["S.PAULO", None, None, None, None, None, None, "\tX", None]


@pytest.mark.parametrize("text,expected", [
    ("Furto (art. 155)", "Furto"), ("ROUBO (art. 157)", "Roubo"), ("Furto e roubo", "Roubo"),
    ("Outro", "Outros"), (None, "Outros"),
])
def test_crime_type(spark, text, expected):
    assert one(spark, FN.crime_type, [text]) == [expected]


@pytest.mark.parametrize("text,expected", [
    ("iPhone 12", "Apple"), ("i-phone", "Apple"), ("I PHONE", "Apple"), ("APPLE (capa samsung)", "Apple"),
    ("SAMSUNG GALAXY J5", "Samsung"), ("galaxy", "Samsung"), ("Moto G", "Motorola"), ("MOTO", "Outras"),
    ("motorola", "Motorola"), ("LG K10", "LG"), ("LGK10", "Outras"), ("BELG", "LG"), ("xiaomi", "Xiaomi"),
    ("nokia ", "Nokia"), ("TCL", "TCL"), ("Multilaser", "Multilaser"), (None, "Outras"), ("Brand#13", "Outras"),
])
def test_brand(spark, text, expected):
    assert one(spark, lambda c: FN.brand(FN.clean_text(c)), [text]) == [expected]


@pytest.mark.parametrize("text,expected", [
    ("JD São Luiz", "JARDIM SAO LUIZ"), ("Consolação", "CONSOLACAO"), ("PQ DO CARMO", "PARQUE DO CARMO"),
    ("VL MARIANA", "VILA MARIANA"), ("CH FLORA", "CHACARA FLORA"), ("ST LESTE", "SETOR LESTE"),
    ("JD. EUROPA", "JARDIM. EUROPA"), ("JDX", "JDX"), ("Não Informado", "NAO INFORMADO"), (None, None),
])
def test_normalize_bairro(spark, text, expected):
    assert one(spark, FN.normalize_bairro, [text]) == [expected]


def test_normalize_bairro_idempotent(spark):
    values = ["JD ABC", "VL X", "Consolação PQ", "ST CH JD", "abc", "PQ"]
    once = one(spark, FN.normalize_bairro, values)
    assert one(spark, FN.normalize_bairro, once) == once


def test_period(spark):
    got = one(spark, FN.period, [0, 5, 6, 11, 12, 17, 18, 23, 24, None, -1], "int")
    assert got == ["Madrugada", "Madrugada", "Manhã", "Manhã", "Tarde", "Tarde", "Noite", "Noite", None, None, None]


def test_labels(spark):
    assert one(spark, FN.hour_label, [0, 9, 23], "int") == ["00h", "09h", "23h"]
    assert one(spark, FN.month_label, [1, 12, 13, None], "int") == ["Jan", "Dez", None, None]
    assert one(spark, FN.direction, [1.5, 0.0, -2.0, None], "double") == ["up", "down", "down", None]


def test_date_filter_compares_strings(spark):
    df = spark.createDataFrame([(v,) for v in ["19/01/2024", "20/01/2024", "NULL", "", "2024-01-15"]],
                               "DATA_OCORRENCIA_BO string")
    kept = [r[0] for r in CL.filter_valid_dates(df, "compat").collect()]
    assert sorted(kept) == ["20/01/2024", "2024-01-15", "NULL"]
    parsed = [r[0] for r in CL.filter_valid_dates(df, "parsed").collect()]
    assert sorted(parsed) == ["19/01/2024", "20/01/2024", "2024-01-15"]


def test_tolerant_int_is_no_float_cast(spark):
    from occurlens.functions import tolerant_int

    texts = ["12", " 12 ", "-7.6", "2024.0", "7.", ".5", "12d", "12f", "1e3", "NaN", "Infinity", "", "x", "+3", "9999999999", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", tolerant_int("t").alias("v")).orderBy("i").collect()]
    assert got == [12, 12, -7, 2024, 7, 0, None, None, None, None, None, None, None, 3, None, None]


def test_date_is_what_the_formats_parse(spark):
    """Against Spark's own parser, format by format."""
    from itertools import product

    from pyspark.sql import functions as F

    from occurlens import constants as C

    dates = [f"{y}-{m}-{d}" for y, m, d in product(["0000", "0001", "1900", "2019", "2020", "9999", "20200", "+2020", "-2020", "-0000", "-00000", "-20200", "-120200", "20", "020"],
                                                   ["00", "02", "2", "12", "13"], ["00", "1", "28", "29", "30", "31", "32"])]
    turned = ["/".join(reversed(x.split("-"))) for x in dates]
    times = [f"2020-02-28{sep}{t}" for sep in (" ", "T", "  ") for t in ("00:00:00", "23:59:59", "24:00:00", "12:60:00", "12:00:60", "1:00:00", "12:00", "12:00:00.0")]
    odd = ["", " ", "NULL", "2020-02-28 ", " 2020-02-28", "2020-02-28\n", "28/02/2020\n", "28/02/2020 00:00:00", "2020/02/28", "28-02-2020",
           "２０２０-02-28", "2020-02-28Z", "2020-02", "2020", None]
    df = spark.createDataFrame([(x,) for x in dates + turned + times + odd], "x string")
    old = F.coalesce(*[F.try_to_date("x", f) for f in C.DATE_FORMATS])
    rows = df.select("x", FN.parse_date("x").cast("string").alias("got"), old.cast("string").alias("want")).collect()
    assert [r for r in rows if r["got"] != r["want"]] == []
    assert sum(r["got"] is not None for r in rows) > 30


def test_brand_is_what_the_patterns_match(spark):
    from pyspark.sql import functions as F

    from occurlens import constants as C

    values = ["apple", " iPhone 12", "i-phone", "I PHONE", "i  phone", "iphon", "phone", "Galaxy", "samsung", "motorola", "Moto G", "MOTO", "moto-g", "motog",
              "LG", "lg k10", "LGK10", "lgé", "algo", "x lg", "xiaomi", "POSITIVO", "lenovo", "asus", "nokia", "huawei", "tcl", "realme", "oppo",
              "multilaser", "APPLE (capa samsung)", "ıphone", "K", "", None]
    df = spark.createDataFrame([(x,) for x in values], "x string")
    want = F.lit(C.BRAND_OTHER)
    for pattern, label in reversed(C.BRAND_RULES):
        want = F.when(F.upper(F.trim("x")).rlike(pattern), label).otherwise(want)
    rows = df.select("x", FN.brand("x").alias("got"), want.alias("want")).collect()
    assert [r for r in rows if r["got"] != r["want"]] == []


def test_clean_stages_are_compiled(spark):
    """The limit on generated methods holds in a session that has no settings of its own."""
    from occurlens.operators.clean import clean
    from occurlens.schema import RAW_COLUMNS

    own = spark.newSession()
    own.conf.unset("spark.sql.codegen.hugeMethodLimit")
    clean(own.createDataFrame([], ", ".join(f"{c} string" for c in RAW_COLUMNS)))
    assert own.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"

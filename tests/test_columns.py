"""Column rules on hand-made rows: one case per semantic point of the
conformed layer (repairs, integer division, date parsing, code maps)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakestar.functions import columns as C


def _rows(spark, data, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*exprs).collect()]


def test_repairs_read_raw_columns(spark):
    # (sales, qty, price) -> (amount, price); both rules read the raw inputs.
    data = [
        (None, 2, 10),      # missing amount -> qty * |price|
        (-5, 2, -10),       # negative amount -> 20; negative price -> raw -5 div 2 = -2
        (30, 2, None),      # price unknown: consistency test unknown, amount kept; price 30 div 2
        (25, 2, 10),        # inconsistent amount -> 20
        (21, 0, None),      # zero quantity: price = 21 div NULLIF(0, 0) = null
        (20, None, 10),     # null quantity: comparison unknown, amount kept
        (20, 2, 10),        # clean row untouched
    ]
    got = _rows(spark, data, "s int, q int, p int",
                C.repair_amount("s", "q", "p"), C.repair_price("p", "s", "q"))
    assert got == [(20, 10), (20, -2), (30, 15), (20, 10), (21, None), (20, 10), (20, 10)]


def test_integer_division_truncates_toward_zero(spark):
    got = _rows(spark, [(-7, 2), (7, 2), (7, -2), (7, 0), (None, 2)], "a int, b int",
                C.truncating_div("a", "b"))
    assert got == [(-3,), (3,), (-3,), (None,), (None,)]


def test_parse_int_date(spark):
    vals = [0, 32154, 20130229, 20120229, 20131301, 20130100, -1234567, 99999999, None,
            10000101, 20130431, 20130430, 100000000]
    got = [r[0] for r in _rows(spark, [(v,) for v in vals], "d int", C.parse_int_date("d"))]
    assert got == [None, None, None, dt.date(2012, 2, 29), None, None, None, None, None,
                   dt.date(1000, 1, 1), None, dt.date(2013, 4, 30), None]


def test_parse_int_date_strict(spark):
    import pytest

    ok = _rows(spark, [(0,), (20120229,), (123,)], "d int", C.parse_int_date("d", strict=True))
    assert ok == [(None,), (dt.date(2012, 2, 29),), (None,)]
    with pytest.raises(Exception):
        _rows(spark, [(20139999,)], "d int", C.parse_int_date("d", strict=True))


def test_parse_int_date_matches_text_parse(spark):
    df = spark.range(0, 400).select((F.lit(20120000) + F.col("id") * 3).cast("int").alias("d"))
    text = F.col("d").cast("string")
    lenient = F.when((F.col("d") == 0) | (F.length(text) != 8), None).otherwise(F.try_to_date(text, "yyyyMMdd"))
    assert df.where(~C.parse_int_date("d").eqNullSafe(lenient)).count() == 0


def test_standardize_codes(spark):
    data = [("S",), (" m",), ("M ",), ("x",), ("",), (None,)]
    got = [r[0] for r in _rows(spark, data, "c string", C.standardize_code("c", C.MARITAL_STATUS))]
    assert got == ["Single", "Married", "Married", "n/a", "n/a", "n/a"]
    erp = [r[0] for r in _rows(spark, [("female",), ("Male ",), ("F",), ("",), (None,)], "c string",
                                C.standardize_code("c", C.ERP_GENDER))]
    assert erp == ["Female", "Male", "Female", "n/a", "n/a"]


def test_country_rules(spark):
    data = [("DE",), ("US ",), ("USA",), (" ",), (None,), (" France ",)]
    got = [r[0] for r in _rows(spark, data, "c string", C.standardize_country("c"))]
    assert got == ["Germany", "United States", "United States", "n/a", "n/a", "France"]


def test_key_rules(spark):
    got = _rows(spark, [("CO-PE-P00000001",), ("AC-HE-P00000002",)], "k string",
                C.category_id("k"), C.category_id("k", C.CATEGORY_KEY_FIXES), C.product_number("k"))
    assert got == [("CO_PE", "CO_PD", "P00000001"), ("AC_HE", "AC_HE", "P00000002")]
    got = _rows(spark, [("NASAW0001",), ("AW0002",), (None,)], "c string",
                C.strip_prefix("c", "NAS"), C.remove_chars("c", "-"))
    assert got == [("AW0001", "NASAW0001"), ("AW0002", "AW0002"), (None, None)]


def test_check_predicates_with_nulls(spark):
    data = [(dt.date(2020, 1, 1), dt.date(2019, 1, 1), dt.date(2021, 1, 1)),
            (None, dt.date(2019, 1, 1), dt.date(2021, 1, 1)),
            (dt.date(2020, 1, 1), None, None)]
    got = [r[0] for r in _rows(spark, data, "a date, b date, c date",
                                F.coalesce(C.dates_out_of_order("a", "b", "c"), F.lit(False)))]
    assert got == [True, False, False]
    m = _rows(spark, [(20, 2, 10), (21, 2, 10), (None, 2, 10), (-2, -1, 2)], "s int, q int, p int",
              C.invalid_measure("s", "q", "p"))
    assert [r[0] for r in m] == [False, True, True, True]


def test_format_g12(spark):
    vals = [1061.36338986, 3182485324.0, 0.0, 1500.5, 1e20, 0.5, 1588.19790089, 29356250.0]
    got = [r[0] for r in _rows(spark, [(v,) for v in vals], "x double", C.format_g12("x"))]
    assert got == [format(v, ".12g") for v in vals]


def test_month_start(spark):
    got = _rows(spark, [(dt.date(2013, 5, 17),), (None,)], "d date", C.month_start("d"))
    assert got == [(dt.date(2013, 5, 1),), (None,)]

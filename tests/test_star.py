"""Cleaning and star rules on hand-made rows (representative product and
category rows, customers that exercise the gender and country fallbacks)."""

from __future__ import annotations

import datetime as dt

import pytest

from lakestar.operators import conform, star
from lakestar.schemas import RAW

TS = dt.datetime


@pytest.fixture(scope="module")
def products_raw(spark):
    rows = [
        (210, "CO-RF-FR-R92B-58", "HL Road Frame - Black- 58", None, "R ", TS(2003, 7, 1), None),
        (211, "CO-RF-FR-R92R-58", "HL Road Frame - Red- 58", None, "R ", TS(2003, 7, 1), None),
        (212, "AC-HE-HL-U509-R", "Sport-100 Helmet- Red", 12, "S ", TS(2011, 7, 1), TS(2007, 12, 28)),
        (213, "AC-HE-HL-U509-R", "Sport-100 Helmet- Red", 14, "S ", TS(2012, 7, 1), TS(2008, 12, 27)),
        (214, "AC-HE-HL-U509-R", "Sport-100 Helmet- Red", 13, "S ", TS(2013, 7, 1), None),
        (300, "CO-PE-PD-M282", "Pedal", 5, None, TS(2012, 1, 1), None),
    ]
    return spark.createDataFrame(rows, RAW["crm_prd_info"])


@pytest.fixture(scope="module")
def categories(spark):
    rows = [("AC_HE", "Accessories", "Helmets", "Yes"), ("CO_RF", "Components", "Road Frames", "No"),
            ("CO_PD", "Components", "Pedals", "No")]
    return conform.clean_categories(spark.createDataFrame(rows, RAW["erp_px_cat_g1v2"]))


def test_clean_products(products_raw):
    got = {r.prd_id: r for r in conform.clean_products(products_raw).collect()}
    # End dates come from the next version's start, never from the raw column.
    assert [got[i].prd_end_dt for i in (212, 213, 214)] == [dt.date(2012, 6, 30), dt.date(2013, 6, 30), None]
    assert got[210].prd_end_dt is None and got[211].prd_end_dt is None
    assert (got[210].cat_id, got[210].prd_key, got[210].prd_cost, got[210].prd_line) == (
        "CO_RF", "FR-R92B-58", 0, "Road")
    assert got[212].prd_line == "Other Sales" and got[300].prd_line == "n/a"
    assert got[300].cat_id == "CO_PD"  # CRM spelling CO_PE harmonised
    assert conform.clean_products(products_raw, category_fixes=None).where("prd_id = 300").first().cat_id == "CO_PE"


def test_dim_products(products_raw, categories):
    dim = star.dim_products(conform.clean_products(products_raw), categories)
    rows = dim.orderBy("product_key").collect()
    # Active versions only (no end date), keyed by (start_date, product_number).
    assert [(r.product_key, r.product_id) for r in rows] == [(1, 210), (2, 211), (3, 300), (4, 214)]
    assert rows[0].category == "Components" and rows[0].subcategory == "Road Frames"
    assert rows[2].category == "Components" and rows[2].maintenance == "No"


@pytest.fixture(scope="module")
def customer_inputs(spark):
    cust = spark.createDataFrame([
        (1, "AW00000001", " Ann ", "Lee ", "S", "F", dt.date(2020, 1, 1)),
        (2, "AW00000002", "Bo", "Ng", "M", "", dt.date(2020, 1, 2)),      # unknown CRM gender -> ERP
        (3, "AW00000003", "Cy", "Om", None, None, dt.date(2020, 1, 3)),   # null CRM gender, no ERP row
        (3, "AW00000003", "Cy", "Om", "m", "M", dt.date(2019, 1, 3)),     # older version, dropped
        (None, "AW00000009", "Nu", "Ll", "S", "F", dt.date(2020, 1, 9)),  # null id, dropped
    ], RAW["crm_cust_info"])
    demo = spark.createDataFrame([
        ("NASAW00000001", dt.date(1980, 5, 1), "Male"),
        ("AW00000002", dt.date(2999, 1, 1), "female "),
    ], RAW["erp_cust_az12"])
    loc = spark.createDataFrame([("AW-00000001", "DE"), ("AW-00000002", " ")], RAW["erp_loc_a101"])
    return cust, demo, loc


def test_dim_customers_fallbacks(customer_inputs):
    cust, demo, loc = customer_inputs
    ci = conform.clean_customers(cust)
    ca = conform.clean_demographics(demo, dt.date(2026, 1, 1))
    la = conform.clean_locations(loc)
    rows = {r.customer_id: r for r in star.dim_customers(ci, ca, la).collect()}
    assert sorted(rows) == [1, 2, 3]
    assert (rows[1].first_name, rows[1].last_name, rows[1].marital_status) == ("Ann", "Lee", "Single")
    assert rows[1].gender == "Female"                 # CRM wins over ERP "Male"
    assert rows[2].gender == "Female"                 # CRM unknown -> ERP
    assert rows[3].gender == "n/a"                    # neither known
    assert rows[3].marital_status == "n/a" and rows[3].create_date == dt.date(2020, 1, 3)
    assert rows[1].country == "Germany" and rows[2].country == "n/a"
    assert rows[3].country is None                    # no location row: no coalesce
    assert rows[1].birthdate == dt.date(1980, 5, 1) and rows[2].birthdate is None  # future -> null
    assert sorted(r.customer_key for r in rows.values()) == [1, 2, 3]


def test_fact_sales_keeps_unmatched_keys_null(spark, products_raw, categories, customer_inputs):
    cust, demo, loc = customer_inputs
    dim_c = star.dim_customers(conform.clean_customers(cust), conform.clean_demographics(demo, "2026-01-01"),
                               conform.clean_locations(loc))
    dim_p = star.dim_products(conform.clean_products(products_raw), categories)
    sales = conform.clean_sales(spark.createDataFrame([
        ("SO1", "FR-R92B-58", 1, 20130105, 20130112, 20130117, 20, 2, 10),
        ("SO2", "NO-SUCH", 99, 0, 20130112, 20130117, None, 1, 7),
    ], RAW["crm_sales_details"]))
    rows = {r.order_number: r for r in star.fact_sales(sales, dim_p, dim_c).collect()}
    assert rows["SO1"].product_key == 1 and rows["SO1"].customer_key is not None
    assert rows["SO2"].product_key is None and rows["SO2"].customer_key is None
    assert rows["SO2"].order_date is None and rows["SO2"].sales_amount == 7

"""Cleaning rules of the conformed layer (one function per source table).

Each function maps a raw-layer DataFrame to its conformed shape with
built-in expressions only. Repairs that read several raw columns are done in
one ``select``, so no rule ever sees another rule's output.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import CONFORMED
from .dedupe import latest_per_key, validity_end_dates


def _shape(df: DataFrame, table: str) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in CONFORMED[table].fields])


def clean_customers(raw: DataFrame) -> DataFrame:
    """Drop null ids, keep the newest version per id, trim names, decode codes."""
    latest = latest_per_key(
        raw.where(F.col("cst_id").isNotNull()), "cst_id", "cst_create_date",
        tie_breakers=["cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr"],
    )
    out = latest.select(
        "cst_id",
        "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        C.standardize_code("cst_marital_status", C.MARITAL_STATUS).alias("cst_marital_status"),
        C.standardize_code("cst_gndr", C.CUSTOMER_GENDER).alias("cst_gndr"),
        "cst_create_date",
    )
    return _shape(out, "crm_cust_info")


def clean_products(raw: DataFrame, category_fixes=C.CATEGORY_KEY_FIXES) -> DataFrame:
    """Split the compound key, default the cost, decode the line, and derive
    each version's end date from the next version's start (raw end dates are
    not usable). Versions are grouped by the *raw* compound key."""
    base = raw.select(
        "prd_id",
        C.category_id("prd_key", category_fixes).alias("cat_id"),
        C.product_number("prd_key").alias("_number"),
        F.col("prd_key").alias("_raw_key"),
        F.trim("prd_nm").alias("prd_nm"),
        F.coalesce(F.col("prd_cost"), F.lit(0)).alias("prd_cost"),
        C.standardize_code("prd_line", C.PRODUCT_LINE).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
    )
    dated = validity_end_dates(base, "_raw_key", "prd_start_dt", "prd_end_dt", tie_breakers=["prd_id"])
    return _shape(dated.withColumnRenamed("_number", "prd_key"), "crm_prd_info")


def clean_sales(raw: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Parse the three integer dates and repair amount and price from the
    raw columns. ``strict_dates``: an 8-digit non-date fails the load
    instead of becoming null."""
    out = raw.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        C.parse_int_date("sls_order_dt", strict_dates).alias("sls_order_dt"),
        C.parse_int_date("sls_ship_dt", strict_dates).alias("sls_ship_dt"),
        C.parse_int_date("sls_due_dt", strict_dates).alias("sls_due_dt"),
        C.repair_amount("sls_sales", "sls_quantity", "sls_price").alias("sls_sales"),
        "sls_quantity",
        C.repair_price("sls_price", "sls_sales", "sls_quantity").alias("sls_price"),
    )
    return _shape(out, "crm_sales_details")


def clean_demographics(raw: DataFrame, as_of: _dt.date | str) -> DataFrame:
    """Strip the ``NAS`` id prefix, null out birthdates after ``as_of``,
    decode gender."""
    as_of_col = F.lit(str(as_of)).cast("date")
    out = raw.select(
        C.strip_prefix("cid", "NAS").alias("cid"),
        F.when(F.col("bdate") > as_of_col, F.lit(None)).otherwise(F.col("bdate")).alias("bdate"),
        C.standardize_code("gen", C.ERP_GENDER).alias("gen"),
    )
    return _shape(out, "erp_cust_az12")


def clean_locations(raw: DataFrame) -> DataFrame:
    """Remove ``-`` from ids; decode country codes; blank or missing -> ``n/a``."""
    out = raw.select(
        C.remove_chars("cid", "-").alias("cid"),
        C.standardize_country("cntry").alias("cntry"),
    )
    return _shape(out, "erp_loc_a101")


def clean_categories(raw: DataFrame) -> DataFrame:
    """Trim the four lookup columns."""
    return _shape(raw.select(*C.trim_all(["id", "cat", "subcat", "maintenance"])), "erp_px_cat_g1v2")

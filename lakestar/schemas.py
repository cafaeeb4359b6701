"""Declared table schemas for the raw and conformed layers.

Fixed values: the column names and types below are the tables' contract (ids are 64 bits wide).
Every column is nullable and typed up front; nothing is inferred. The
conformed tables additionally carry ``dwh_create_date`` (the load stamp),
which is added when a layer is written, not by the cleaning rules.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_I = T.IntegerType()
_L = T.LongType()
_D = T.DateType()
_TS = T.TimestampNTZType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


# ---- raw layer: one table per source extract ---------------------------------
RAW = {
    "crm_cust_info": _schema(
        ("cst_id", _L), ("cst_key", _S), ("cst_firstname", _S), ("cst_lastname", _S),
        ("cst_marital_status", _S), ("cst_gndr", _S), ("cst_create_date", _D),
    ),
    "crm_prd_info": _schema(
        ("prd_id", _L), ("prd_key", _S), ("prd_nm", _S), ("prd_cost", _I), ("prd_line", _S),
        ("prd_start_dt", _TS), ("prd_end_dt", _TS),
    ),
    "crm_sales_details": _schema(
        ("sls_ord_num", _S), ("sls_prd_key", _S), ("sls_cust_id", _L), ("sls_order_dt", _I),
        ("sls_ship_dt", _I), ("sls_due_dt", _I), ("sls_sales", _I), ("sls_quantity", _I), ("sls_price", _I),
    ),
    "erp_cust_az12": _schema(("cid", _S), ("bdate", _D), ("gen", _S)),
    "erp_loc_a101": _schema(("cid", _S), ("cntry", _S)),
    "erp_px_cat_g1v2": _schema(("id", _S), ("cat", _S), ("subcat", _S), ("maintenance", _S)),
}

# ---- conformed layer (column order is the insert order) ----------------------
CONFORMED = {
    "crm_cust_info": _schema(
        ("cst_id", _L), ("cst_key", _S), ("cst_firstname", _S), ("cst_lastname", _S),
        ("cst_marital_status", _S), ("cst_gndr", _S), ("cst_create_date", _D),
    ),
    "crm_prd_info": _schema(
        ("prd_id", _L), ("cat_id", _S), ("prd_key", _S), ("prd_nm", _S), ("prd_cost", _I),
        ("prd_line", _S), ("prd_start_dt", _D), ("prd_end_dt", _D),
    ),
    "crm_sales_details": _schema(
        ("sls_ord_num", _S), ("sls_prd_key", _S), ("sls_cust_id", _L), ("sls_order_dt", _D),
        ("sls_ship_dt", _D), ("sls_due_dt", _D), ("sls_sales", _I), ("sls_quantity", _I), ("sls_price", _I),
    ),
    "erp_cust_az12": _schema(("cid", _S), ("bdate", _D), ("gen", _S)),
    "erp_loc_a101": _schema(("cid", _S), ("cntry", _S)),
    "erp_px_cat_g1v2": _schema(("id", _S), ("cat", _S), ("subcat", _S), ("maintenance", _S)),
}

LOAD_STAMP = "dwh_create_date"

# ---- star schema column lists -------------------------------------------------
DIM_CUSTOMERS = [
    "customer_key", "customer_id", "customer_number", "first_name", "last_name", "country",
    "marital_status", "gender", "birthdate", "create_date",
]
DIM_PRODUCTS = [
    "product_key", "product_id", "product_number", "product_name", "category_id", "category",
    "subcategory", "maintenance", "cost", "product_line", "start_date",
]
FACT_SALES = [
    "order_number", "product_key", "customer_key", "order_date", "shipping_date", "due_date",
    "sales_amount", "quantity", "price",
]

QUALITY_REPORT = _schema(("check_name", _S), ("severity", _S), ("failed_rows", T.LongType()))

"""Star schema: customer and product dimensions around the sales fact.

Dimensions get dense surrogate keys (see :mod:`.keys`); build them once per
snapshot and let the fact read the materialised dimensions, so keys in the
fact and in the dimensions always agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schemas import DIM_CUSTOMERS, DIM_PRODUCTS, FACT_SALES
from .keys import dense_key


def dim_customers(customers: DataFrame, demographics: DataFrame, locations: DataFrame, collation: str | None = None) -> DataFrame:
    """CRM customers enriched with ERP demographics and location (left joins
    on the business key, under ``collation``). CRM gender wins unless unknown, then ERP gender."""
    key = lambda name: C.collated(name, collation)
    ci = customers.alias("ci")
    ca = demographics.alias("ca")
    la = locations.alias("la")
    joined = (ci.join(ca, key("ci.cst_key") == key("ca.cid"), "left")
                .join(la, key("ci.cst_key") == key("la.cid"), "left"))
    rows = joined.select(
        F.col("ci.cst_id").alias("customer_id"),
        F.col("ci.cst_key").alias("customer_number"),
        F.col("ci.cst_firstname").alias("first_name"),
        F.col("ci.cst_lastname").alias("last_name"),
        F.col("la.cntry").alias("country"),
        F.col("ci.cst_marital_status").alias("marital_status"),
        F.when(F.col("ci.cst_gndr") != F.lit(C.UNKNOWN), F.col("ci.cst_gndr"))
        .otherwise(F.coalesce(F.col("ca.gen"), F.lit(C.UNKNOWN))).alias("gender"),
        F.col("ca.bdate").alias("birthdate"),
        F.col("ci.cst_create_date").alias("create_date"),
    )
    # customer_id is unique after cleaning; the other columns complete the
    # order when the enrichment joins fan out.
    order = ["customer_id", "customer_number", "country", "gender", "birthdate"]
    return dense_key(rows, order, "customer_key").select(*DIM_CUSTOMERS)


def active_products(products: DataFrame) -> DataFrame:
    """Current versions only: those without an end date."""
    return products.where(F.col("prd_end_dt").isNull())


def dim_products(products: DataFrame, categories: DataFrame, collation: str | None = None) -> DataFrame:
    """Active product versions with their category (left lookup, under ``collation``)."""
    pn = active_products(products).alias("pn")
    pc = categories.alias("pc")
    rows = pn.join(pc, C.collated("pn.cat_id", collation) == C.collated("pc.id", collation), "left").select(
        F.col("pn.prd_id").alias("product_id"),
        F.col("pn.prd_key").alias("product_number"),
        F.col("pn.prd_nm").alias("product_name"),
        F.col("pn.cat_id").alias("category_id"),
        F.col("pc.cat").alias("category"),
        F.col("pc.subcat").alias("subcategory"),
        F.col("pc.maintenance").alias("maintenance"),
        F.col("pn.prd_cost").alias("cost"),
        F.col("pn.prd_line").alias("product_line"),
        F.col("pn.prd_start_dt").alias("start_date"),
    )
    order = [F.col("start_date").asc_nulls_first(), F.col("product_number").asc_nulls_first(),
             F.col("product_id").asc_nulls_first(), F.col("category").asc_nulls_first()]
    return dense_key(rows, order, "product_key").select(*DIM_PRODUCTS)


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame, collation: str | None = None) -> DataFrame:
    """Sales lines with dimension surrogate keys attached (product numbers under ``collation``); unmatched -> null."""
    pr = products.select("product_number", "product_key").alias("pr")
    cu = customers.select("customer_id", "customer_key").alias("cu")
    sd = sales.alias("sd")
    joined = (sd.join(pr, C.collated("sd.sls_prd_key", collation) == C.collated("pr.product_number", collation), "left")
                .join(cu, F.col("sd.sls_cust_id") == F.col("cu.customer_id"), "left"))
    return joined.select(
        F.col("sd.sls_ord_num").alias("order_number"),
        F.col("pr.product_key").alias("product_key"),
        F.col("cu.customer_key").alias("customer_key"),
        F.col("sd.sls_order_dt").alias("order_date"),
        F.col("sd.sls_ship_dt").alias("shipping_date"),
        F.col("sd.sls_due_dt").alias("due_date"),
        F.col("sd.sls_sales").alias("sales_amount"),
        F.col("sd.sls_quantity").alias("quantity"),
        F.col("sd.sls_price").alias("price"),
    ).select(*FACT_SALES)

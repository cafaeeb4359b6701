"""Raw-shaped source extracts derived from the driver's tables.

The warehouse expects six CRM/ERP extracts. The driver ships TPC-H-like
tables instead, so these functions derive the six extracts from them,
deterministically, with the same kinds of dirt the real extracts carry
(null and duplicate ids, padded text, coded values, bad integer dates,
amounts and prices to repair, prefixed and punctuated keys, a category key
that needs harmonising). Each extract is a lazy DataFrame over parquet, so
its size grows with the driver tables and Catalyst prunes unused columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The category lookup extract (id, cat, subcat, maintenance).
CATEGORY_ROWS = [
    ("AC_HE", "Accessories", "Helmets", "Yes"),
    ("BI_RB", "Bikes", "Road Bikes", "Yes"),
    ("BI_MB", "Bikes", "Mountain Bikes", "Yes"),
    ("CL_SO", "Clothing", "Socks", "No"),
    ("CO_PD", "Components", "Pedals", "No"),
    ("CO_BR", "Components", "Brakes", "Yes"),
]

# Part type -> compound-key prefix of the product extract
# (anything else maps to BI-MB). PROMO deliberately gets the CRM spelling
# CO-PE, which the conformed layer harmonises to the ERP id CO_PD.
PART_TYPE_PREFIX = [
    ("ECONOMY", "AC-HE"),
    ("LARGE", "BI-RB"),
    ("MEDIUM", "CL-SO"),
    ("PROMO", "CO-PE"),
    ("SMALL", "CO-BR"),
]
DEFAULT_PREFIX = "BI-MB"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(value: Column, pairs, default=None) -> Column:
    """Simple ``CASE value WHEN k THEN v ... END`` over literal pairs."""
    out = None
    for key, result in pairs:
        out = (F.when(value == F.lit(key), F.lit(result)) if out is None
               else out.when(value == F.lit(key), F.lit(result)))
    return out.otherwise(F.lit(default))


def _padded(key: Column, prefix: str) -> Column:
    """``prefix`` and the key with at least eight digits; longer keys keep all of theirs (``lpad`` alone would cut them)."""
    digits = key.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(8), F.length(digits)), "0"))


def _shape(df: DataFrame, table: str) -> DataFrame:
    """Project to the declared raw schema (order and types)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW[table].fields])


def crm_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    # Version 0 for every customer; a newer version 1 for some of them (the
    # dedupe must keep it). Generated per row from one scan of the table.
    has_newer = (k % 37 == 5) & (k % 401 != 7)
    versions = c.withColumn("_v", F.explode(F.when(has_newer, F.array(F.lit(0), F.lit(1)))
                                            .otherwise(F.array(F.lit(0)))))
    newer = F.col("_v") == 1
    out = versions.select(
        F.when(newer, k).when(k % 401 == 7, F.lit(None)).otherwise(k).cast("bigint").alias("cst_id"),
        _padded(k, "AW").alias("cst_key"),
        F.when(newer, F.col("c_name"))
        .when(k % 3 == 0, F.concat(F.lit("  "), "c_name")).otherwise(F.col("c_name")).alias("cst_firstname"),
        F.when(newer, F.col("c_mktsegment"))
        .when(k % 4 == 0, F.concat("c_mktsegment", F.lit(" "))).otherwise(F.col("c_mktsegment")).alias("cst_lastname"),
        F.when(newer, F.lit("M")).otherwise(_case(k % 4, [(0, "S"), (1, " m"), (2, "M ")])).alias("cst_marital_status"),
        F.when(newer, F.lit(None)).otherwise(_case(k % 5, [(0, "F"), (1, "m "), (2, "M"), (3, "")])).alias("cst_gndr"),
        F.when(newer, F.date_add(F.lit("2022-06-01").cast("date"), (k % 30).cast("int")))
        .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (k % 700).cast("int"))).alias("cst_create_date"),
    )
    return _shape(out, "crm_cust_info")


def crm_prd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    # 1 to 3 versions per part: version v in 0..(partkey % 3), generated per row.
    versions = p.withColumn("v", F.explode(F.sequence(F.lit(0), (k % 3).cast("int"))))
    v = F.col("v")
    prefix = _case(F.col("p_type"), PART_TYPE_PREFIX, DEFAULT_PREFIX)
    out = versions.select(
        (k.cast("bigint") * 3 + v).alias("prd_id"),
        F.concat(prefix, F.lit("-"), _padded(k, "P")).alias("prd_key"),
        F.concat("p_name", F.lit(" ")).alias("prd_nm"),
        F.when(k % 97 == 3, F.lit(None)).otherwise(F.floor("p_retailprice") + v).cast("int").alias("prd_cost"),
        _case(F.col("p_size") % 5, [(0, "M "), (1, "r"), (2, "S "), (3, "T")]).alias("prd_line"),
        F.date_add(F.lit("2011-07-01").cast("date"), (v * 366 + k % 60).cast("int")).alias("prd_start_dt"),
        F.lit(None).cast("timestamp_ntz").alias("prd_end_dt"),
    )
    return _shape(out, "crm_prd_info")


def _yyyymmdd(ts: Column) -> Column:
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def crm_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    # What comes of a line alone is worked out before the join, so that small numbers are shuffled instead of keys, amounts and timestamps.
    partsupp, qty = F.col("l_partkey") + F.col("l_suppkey"), F.col("l_quantity")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", F.floor(F.col("l_extendedprice") / qty).alias("_unit"), _yyyymmdd(F.col("l_shipdate")).alias("_ship"),
        F.when(partsupp % 509 == 4, 1).when(partsupp % 521 == 5, 2).otherwise(0).alias("_fault"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")  # the load filters nothing
    ok, pk, unit, ship = F.col("l_orderkey"), F.col("l_partkey"), F.col("_unit"), F.col("_ship")
    out = j.select(
        F.concat(F.lit("SO"), ok.cast("string")).alias("sls_ord_num"),
        _padded(pk, "P").alias("sls_prd_key"),
        F.col("o_custkey").cast("bigint").alias("sls_cust_id"),
        F.when(ok % 211 == 1, F.lit(0)).when(ok % 223 == 2, F.lit(32154))
        .otherwise(_yyyymmdd(F.col("o_orderdate"))).cast("int").alias("sls_order_dt"),
        ship.cast("int").alias("sls_ship_dt"),
        # A year later, on the 28th at most.
        (ship + 10000 - F.greatest(ship % 100 - 28, F.lit(0))).cast("int").alias("sls_due_dt"),
        F.when(F.col("_fault") == 1, F.lit(None))
        .when(F.col("_fault") == 2, F.lit(-10))
        .when(pk % 401 == 6, qty * unit + 1)
        .otherwise(qty * unit).cast("int").alias("sls_sales"),
        qty.cast("int").alias("sls_quantity"),
        F.when(ok % 307 == 8, F.lit(None)).when(ok % 311 == 9, -unit).otherwise(unit).cast("int").alias("sls_price"),
    )
    return _shape(out, "crm_sales_details")


def erp_cust_az12(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    out = c.select(
        F.concat(F.when(k % 2 == 0, F.lit("NAS")).otherwise(F.lit("")), _padded(k, "AW")).alias("cid"),
        F.when(k % 101 == 3, F.lit("2999-01-01").cast("date"))
        .when(k % 103 == 4, F.lit("1900-01-01").cast("date"))
        .otherwise(F.date_add(F.lit("1950-01-01").cast("date"), ((k * 29) % 18000).cast("int"))).alias("bdate"),
        _case(k % 6, [(0, "F"), (1, "Male "), (2, "female"), (3, "M"), (4, "")]).alias("gen"),
    )
    return _shape(out, "erp_cust_az12")


def erp_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # No hint: Spark broadcasts the nation table from its file statistics
    # (a few KB) and falls back to a sort-merge join above the threshold.
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    nk = F.col("c_nationkey") % 6
    out = j.select(
        _padded(F.col("c_custkey"), "AW-").alias("cid"),
        F.when(nk == 0, F.lit("DE")).when(nk == 1, F.lit("US ")).when(nk == 2, F.lit("USA"))
        .when(nk == 3, F.lit(" ")).when(nk == 4, F.lit(None)).otherwise(F.col("n_name")).alias("cntry"),
    )
    return _shape(out, "erp_loc_a101")


def erp_px_cat_g1v2(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """The category lookup as a local relation (``VALUES``): planned and
    evaluated in the JVM, no Python worker, one small partition."""
    rows = F.array(*[F.struct(*[F.lit(v) for v in row]) for row in CATEGORY_ROWS])
    names = RAW["erp_px_cat_g1v2"].fieldNames()
    return _shape(spark.range(0, 1, 1, 1).select(F.inline(rows)).toDF(*names), "erp_px_cat_g1v2")


EXTRACTS = {
    "crm_cust_info": crm_cust_info,
    "crm_prd_info": crm_prd_info,
    "crm_sales_details": crm_sales_details,
    "erp_cust_az12": erp_cust_az12,
    "erp_loc_a101": erp_loc_a101,
    "erp_px_cat_g1v2": erp_px_cat_g1v2,
}

"""Independent audit: the nineteen warehouse metrics recomputed from the raw
extracts with the same rules, plus the pieces they are built from.

It re-derives the star schema's numbers by a different route (raw sales with
column rules instead of the published fact; latest product version instead
of the open-ended one), so agreement with the warehouse is evidence, not
tautology. Every metric is a distributed aggregate; only the final one-row
frames are stacked into ``(metric, value)`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .dedupe import latest_per_key
from .joins import semi_count
from .kpi import monthly_revenue_filled

# The metrics, in report order.
METRICS = (
    "raw_crm_customer_rows",
    "raw_crm_product_rows",
    "raw_crm_sales_rows",
    "raw_customer_null_ids",
    "raw_customer_duplicate_id_excess",
    "silver_customer_rows",
    "silver_product_rows",
    "gold_active_product_rows",
    "gold_fact_sales_rows",
    "sales_amount_rows_repaired",
    "sales_price_rows_repaired",
    "sales_missing_order_date_rows",
    "active_product_category_matches_before_harmonization",
    "active_product_category_matches_after_harmonization",
    "total_revenue",
    "distinct_orders",
    "distinct_customers_in_fact",
    "average_order_value",
    "average_revenue_per_customer",
)


def latest_product_versions(raw_products: DataFrame) -> DataFrame:
    """Last version per raw compound key by start date (ties: highest id)."""
    versions = raw_products.select("prd_id", "prd_key", F.col("prd_start_dt").cast("date").alias("start_date"))
    return latest_per_key(versions, "prd_key", "start_date", tie_breakers=["prd_id"])


def category_matches(latest: DataFrame, categories: DataFrame, harmonised: bool) -> DataFrame:
    """Active products whose category id (raw or harmonised) is a lookup id."""
    fixes = C.CATEGORY_KEY_FIXES if harmonised else None
    ids = categories.select(F.trim("id").alias("_id"))
    keyed = latest.select(C.category_id("prd_key", fixes).alias("_cat"))
    return semi_count(keyed, ids, "_cat", "_id").withColumnRenamed("matches", "n")


def _repair_count_columns() -> list:
    return [
        F.count_if(C.amount_needs_repair("sls_sales", "sls_quantity", "sls_price")).alias("sales_amount_rows_repaired"),
        F.count_if(C.price_needs_repair("sls_price")).alias("sales_price_rows_repaired"),
        F.count_if(C.parse_int_date("sls_order_dt").isNull()).alias("sales_missing_order_date_rows"),
    ]


def _repaired_amount():
    return C.repair_amount("sls_sales", "sls_quantity", "sls_price").cast("bigint")


def repair_counts(raw_sales: DataFrame) -> DataFrame:
    """Rows whose amount / price the conformed layer repairs, and rows
    whose order date does not parse."""
    return raw_sales.agg(*_repair_count_columns())


def sales_metrics(raw_sales: DataFrame) -> DataFrame:
    """The raw sales' metrics as one row, from one scan and one shuffle: grouping sets by order and by customer give the groups' sums,
    and the order groups, which hold every row, the totals."""
    by = {"sls_ord_num": "average_order_value", "sls_cust_id": "average_revenue_per_customer"}
    counts = _repair_count_columns()
    groups = raw_sales.groupingSets([[k] for k in by], *by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_repaired_amount()).alias("amount"), *counts, F.grouping_id().alias("g"))
    order, customer = F.col("g") == 1, F.col("g") == 2
    own = {"sls_ord_num": order & F.col("sls_ord_num").isNotNull(), "sls_cust_id": customer & F.col("sls_cust_id").isNotNull()}
    total = lambda c: F.coalesce(F.sum(F.when(order, F.col(c))), F.lit(0))
    return groups.agg(
        total("n").alias("raw_crm_sales_rows"),
        *[total(c).alias(c) for c in ("sales_amount_rows_repaired", "sales_price_rows_repaired", "sales_missing_order_date_rows")],
        F.sum(F.when(order, F.col("amount"))).alias("total_revenue"),
        F.count_if(own["sls_ord_num"]).alias("distinct_orders"),
        F.count_if(own["sls_cust_id"]).alias("distinct_customers_in_fact"),
        *[F.avg(F.when(own[k], F.col("amount").cast("double"))).alias(name) for k, name in by.items()])


def audit_metrics(raw: dict[str, DataFrame], conformed: dict[str, DataFrame],
                  star: dict[str, DataFrame]) -> DataFrame:
    """``(metric, value)``: nineteen rows, value formatted like ``'.12g'``."""
    cust, prd, sales = raw["crm_cust_info"], raw["crm_prd_info"], raw["crm_sales_details"]
    latest = latest_product_versions(prd)
    # One pass per table: every metric of a table is one aggregate of it.
    one_row = [
        cust.agg(F.count(F.lit(1)).alias("raw_crm_customer_rows"),
                 F.count_if(F.col("cst_id").isNull()).alias("raw_customer_null_ids"),
                 (F.count("cst_id") - F.count_distinct("cst_id")).alias("raw_customer_duplicate_id_excess")),
        prd.agg(F.count(F.lit(1)).alias("raw_crm_product_rows")),
        conformed["crm_cust_info"].agg(F.count(F.lit(1)).alias("silver_customer_rows")),
        conformed["crm_prd_info"].agg(F.count(F.lit(1)).alias("silver_product_rows")),
        latest.agg(F.count(F.lit(1)).alias("gold_active_product_rows")),
        star["fact_sales"].agg(F.count(F.lit(1)).alias("gold_fact_sales_rows")),
        category_matches(latest, raw["erp_px_cat_g1v2"], False)
        .withColumnRenamed("n", "active_product_category_matches_before_harmonization"),
        category_matches(latest, raw["erp_px_cat_g1v2"], True)
        .withColumnRenamed("n", "active_product_category_matches_after_harmonization"),
        sales_metrics(sales),
    ]
    stacked = None
    for frame in one_row:
        long = frame.unpivot([], frame.columns, "metric", "num") if len(frame.columns) > 1 else \
            frame.select(F.lit(frame.columns[0]).alias("metric"), F.col(frame.columns[0]).alias("num"))
        long = long.select("metric", F.col("num").cast("double").alias("num"))
        stacked = long if stacked is None else stacked.unionByName(long)
    order = F.array_position(F.array(*[F.lit(m) for m in METRICS]), F.col("metric"))
    return stacked.select("metric", C.format_g12("num").alias("value")).orderBy(order)


class InvariantError(AssertionError):
    """A warehouse grain or completeness invariant does not hold."""


# The invariants, in report order.
INVARIANTS = (
    "customer_id_null_or_not_unique",
    "product_number_null_or_not_unique",
    "product_category_missing",
    "fact_dimension_key_missing",
    "fact_measure_missing",
    "fact_rows_differ_from_raw_sales",
    "fact_revenue_differs_from_raw_sales",
    "filled_months_differ_from_range",
)


def invariants(raw: dict[str, DataFrame], conformed: dict[str, DataFrame],
               star: dict[str, DataFrame]) -> DataFrame:
    """``(invariant, failures, holds)``: the audit's grain and completeness
    assertions as distributed counts. ``failures`` is the number of offending
    rows or keys, or the absolute difference of two totals that must agree.

    Each table is read once; the two reconciliations are signed totals from
    both sides, unioned and summed by name (a handful of rows).
    """
    cust, products, fact = conformed["crm_cust_info"], star["dim_products"], star["fact_sales"]
    sales = raw["crm_sales_details"]
    one = F.lit(1)
    months = monthly_revenue_filled(fact)
    span = F.months_between(F.max("order_month"), F.min("order_month")).cast("bigint") + 1
    frames = [
        months.agg((F.count(one) - F.coalesce(span, F.lit(0))).alias("filled_months_differ_from_range")),
        cust.agg((F.count(one) - F.count_distinct("cst_id")).alias("customer_id_null_or_not_unique")),
        products.agg((F.count(one) - F.count_distinct("product_number")).alias("product_number_null_or_not_unique"),
                     F.count_if(C.any_null("category", "subcategory", "maintenance")).alias("product_category_missing")),
        fact.agg(F.count_if(C.any_null("customer_key", "product_key")).alias("fact_dimension_key_missing"),
                 F.count_if(C.any_null("sales_amount", "price")).alias("fact_measure_missing"),
                 F.count(one).alias("fact_rows_differ_from_raw_sales"),
                 F.sum(F.col("sales_amount").cast("bigint")).alias("fact_revenue_differs_from_raw_sales")),
        sales.agg((-F.count(one)).alias("fact_rows_differ_from_raw_sales"),
                  (-F.sum(_repaired_amount())).alias("fact_revenue_differs_from_raw_sales")),
    ]
    longs = [f.unpivot([], f.columns, "invariant", "failures") if len(f.columns) > 1 else
             f.select(F.lit(f.columns[0]).alias("invariant"), F.col(f.columns[0]).alias("failures"))
             for f in frames]
    stacked = longs[0]
    for part in longs[1:]:
        stacked = stacked.unionByName(part)
    totals = stacked.groupBy("invariant").agg(F.abs(F.sum(F.coalesce(F.col("failures").cast("bigint"), F.lit(0))))
                                             .alias("failures"))
    order = F.array_position(F.array(*[F.lit(n) for n in INVARIANTS]), F.col("invariant"))
    return totals.select("invariant", "failures", (F.col("failures") == 0).alias("holds")).orderBy(order)


def assert_invariants(report: DataFrame) -> None:
    """Raise :class:`InvariantError` listing every invariant that fails
    (the report has one row per invariant, so the collect is bounded)."""
    broken = report.where(~F.col("holds")).collect()
    if broken:
        raise InvariantError("warehouse invariants failed: " +
                             ", ".join(f"{r.invariant}={r.failures}" for r in broken))

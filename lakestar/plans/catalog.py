"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through the raw extracts and the
materialised layers Spark derives from them), so its work grows with the
data. Computed columns carry explicit names that the oracle SQL repeats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import audit, conform, dedupe, joins, kpi, quality, star
from ..schemas import RAW
from ..session import scratch_dir
from ..sources import csv_io, extracts
from .build import CONFORMED_RULES, STAR_TABLES, Warehouse, warehouse_for

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return warehouse_for(spark, sf_dir)


def _star(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: wh.star(name) for name in STAR_TABLES}


def _conformed(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: wh.conformed(name) for name in CONFORMED_RULES}


def _raw(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: wh.raw(name) for name in CONFORMED_RULES}


# ---- layer tables -------------------------------------------------------------
def _conformed_table(name: str) -> Query:
    return lambda spark, sf_dir: _wh(spark, sf_dir).conformed(name)


def conform_part_categories(spark, sf_dir):
    """The category rule on category rows derived from the parts: padded ids, types, brands and maintenance codes."""
    p = extracts.read_table(spark, sf_dir, "part").select("p_type", "p_brand", "p_size")
    pad = lambda c: F.concat(F.lit(" "), c, F.lit("  "))
    raw = p.select(pad(F.upper(F.substring("p_type", 1, 5))).alias("id"), pad(F.col("p_type")).alias("cat"), pad(F.col("p_brand")).alias("subcat"),
                   F.when(F.col("p_size") % 2 == 0, " Yes").otherwise("No ").alias("maintenance")).distinct()
    return conform.clean_categories(raw)


def _star_table(name: str) -> Query:
    return lambda spark, sf_dir: _wh(spark, sf_dir).star(name)


def bronze_row_counts(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return kpi.row_counts({f"bronze.{n}": df for n, df in _raw(wh).items()})


def bronze_csv_roundtrip_products(spark, sf_dir):
    """Raw product extract landed as CSV, then ingested with the declared
    schema (the full-refresh CSV path of the raw layer)."""
    landing = scratch_dir(spark, "landing")
    csv_io.write_csv(extracts.crm_prd_info(spark, sf_dir), f"{landing}/crm_prd_info")
    loaded = csv_io.ingest(spark, {"crm_prd_info": f"{landing}/crm_prd_info"}, scratch_dir(spark, "raw"))
    return loaded["crm_prd_info"]


def bronze_csv_null_tokens(spark, sf_dir):
    """The raw product extract landed as CSV with ``NA`` for its nulls, in number and date columns too, and read back."""
    landing = scratch_dir(spark, "landing")
    csv_io.write_csv(extracts.crm_prd_info(spark, sf_dir), landing, null_token="NA")
    return csv_io.read_csv_with_null_tokens(spark, landing, RAW["crm_prd_info"])


def bronze_tolerated_rejects(spark, sf_dir):
    """The demographics landed as CSV lines, some of them broken by rule (a date that is none, a field too many, a field too few), and loaded
    with tolerance: what was loaded and what was kept apart."""
    landing = scratch_dir(spark, "landing")
    people = extracts.erp_cust_az12(spark, sf_dir)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("cid", "bdate", "gen")]
    kind = F.right(F.col("cid"), F.lit(2))
    line = (F.when(kind == "07", F.concat_ws(",", fields[0], F.lit("soon"), fields[2])).when(kind == "18", F.concat_ws(",", *fields, F.lit("more")))
            .when(kind == "29", F.concat_ws(",", *fields[:2])).otherwise(F.concat_ws(",", *fields)))
    csv_io.write_lines(people.select(line), "cid,bdate,gen", landing)
    rows, rejects = csv_io.split_load(spark, landing, RAW["erp_cust_az12"], scratch_dir(spark, "raw"), max_rejects=1_000_000_000, quote="")
    loaded = rows.select(F.lit("loaded").alias("kind"), F.concat_ws(",", *fields).alias("line"))
    return loaded.unionByName(rejects.select(F.lit("rejected").alias("kind"), "line"))


def metrics_csv_roundtrip(spark, sf_dir):
    """The audit metrics as written to their CSV file and read back."""
    path = scratch_dir(spark, "metrics")
    csv_io.write_metrics_csv(metrics_audit(spark, sf_dir), path)
    return csv_io.read_metrics_csv(spark, path)


def gold_row_counts(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return kpi.row_counts({f"gold.{n}": df for n, df in _star(wh).items()})


# ---- KPIs ---------------------------------------------------------------------
def kpi_summary(spark, sf_dir):
    return kpi.summary_of(_wh(spark, sf_dir).rollups())


def kpi_average_order_value(spark, sf_dir):
    """Revenue per distinct order, ``DECIMAL(19,2)`` (null without orders)."""
    return kpi.summary_of(_wh(spark, sf_dir).rollups()).select("average_order_value")


def kpi_monthly_revenue(spark, sf_dir):
    return kpi.monthly_revenue_of(_wh(spark, sf_dir).rollups())


def kpi_yearly_activity(spark, sf_dir):
    """Years rolled up from the months' bitmaps: distinct orders and customers are merged, not added."""
    return kpi.yearly_activity(_wh(spark, sf_dir).rollups())


def kpi_revenue_by_country(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return kpi.revenue_by_country(wh.star("fact_sales"), wh.star("dim_customers"))


def kpi_revenue_by_product_line(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return kpi.revenue_by_product_line(wh.star("fact_sales"), wh.star("dim_products"))


def kpi_category_performance(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return kpi.category_performance(wh.star("fact_sales"), wh.star("dim_products"))


def kpi_category_by_month(spark, sf_dir):
    """Revenue by category in each month of the year 1996, from that year's partitions of the fact."""
    wh = _wh(spark, sf_dir)
    some = wh.sales_by_month().where("order_month >= DATE'1996-01-01' AND order_month < DATE'1997-01-01'")
    per_key = some.groupBy("order_month", "product_key").agg(kpi.revenue().alias("revenue"))
    joined = per_key.join(wh.star("dim_products").select("product_key", "category"), "product_key")
    return joined.groupBy("order_month", "category").agg(F.sum("revenue").cast("bigint").alias("revenue"))


def kpi_order_date_range(spark, sf_dir):
    return kpi.order_date_range(_wh(spark, sf_dir).star("fact_sales"))


def kpi_revenue_share_by_category(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return kpi.revenue_share(kpi.revenue_by(wh.star("fact_sales"), wh.star("dim_products"),
                                            "product_key", "category"), "category")


def kpi_revenue_share_by_product_line(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return kpi.revenue_share(kpi.revenue_by_product_line(wh.star("fact_sales"), wh.star("dim_products")),
                             "product_line")


def trend_monthly_filled(spark, sf_dir):
    return kpi.monthly_revenue_filled(_wh(spark, sf_dir).star("fact_sales"))


def trend_customer_months_filled(spark, sf_dir):
    """Each customer's months from the first to the last with revenue; most have gaps, which are filled with 0."""
    return kpi.monthly_revenue_filled_by(_wh(spark, sf_dir).star("fact_sales"), "customer_key")


def ordered_monthly_revenue(spark, sf_dir):
    return kpi.with_position(kpi_monthly_revenue(spark, sf_dir), ["order_month"])


def ordered_revenue_by_country(spark, sf_dir):
    return kpi.with_position(kpi_revenue_by_country(spark, sf_dir), [F.desc("revenue"), "country"])


def ordered_quality_report(spark, sf_dir):
    """The conformed layer's report with each row's place: errors first, then by name."""
    return kpi.with_position(dq_silver_report(spark, sf_dir), quality.report_order())


def metric_average_revenue(spark, sf_dir):
    """Mean revenue per order and per customer (two-level aggregates), as
    ``(metric, value)`` rows."""
    fact = _wh(spark, sf_dir).star("fact_sales")
    wide = kpi.means_of_group_sums(fact, {"avg_revenue_per_order": "order_number",
                                          "avg_revenue_per_customer": "customer_key"}, "sales_amount")
    return wide.unpivot([], wide.columns, "metric", "value")


def metric_duplicate_excess(spark, sf_dir):
    raw = _wh(spark, sf_dir).raw("crm_cust_info")
    return raw.agg(F.count_if(F.col("cst_id").isNull()).alias("null_ids"),
                   (F.count("cst_id") - F.count_distinct("cst_id")).alias("duplicate_excess"))


def metric_repair_counts(spark, sf_dir):
    return audit.repair_counts(_wh(spark, sf_dir).raw("crm_sales_details"))


def metric_category_matches(spark, sf_dir):
    """Active products whose category id is a lookup id, before and after
    harmonising the CRM key, as ``(metric, value)`` rows."""
    wh = _wh(spark, sf_dir)
    latest = audit.latest_product_versions(wh.raw("crm_prd_info"))
    cats = wh.raw("erp_px_cat_g1v2")
    parts = [audit.category_matches(latest, cats, harmonised).select(F.lit(name).alias("metric"),
                                                                      F.col("n").alias("value"))
             for name, harmonised in (("matches_before_harmonization", False),
                                      ("matches_after_harmonization", True))]
    return parts[0].unionByName(parts[1])


def metrics_audit(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return audit.audit_metrics(_raw(wh), _conformed(wh), _star(wh))


def audit_invariants(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return audit.invariants(_raw(wh), _conformed(wh), _star(wh))


# ---- SQL over the layer namespaces (bronze / silver / gold) ---------------------
def _sql(spark, sf_dir, text: str) -> DataFrame:
    _wh(spark, sf_dir).register_catalog()
    return spark.sql(text)


def sql_repeat_customers(spark, sf_dir):
    """SQL over ``gold``: customers by the number of their orders, with what they spent."""
    return _sql(spark, sf_dir, """
        WITH per_customer AS (
          SELECT d.country, f.customer_key, count(DISTINCT f.order_number) AS orders, sum(f.sales_amount) AS spent
          FROM gold.fact_sales f JOIN gold.dim_customers d USING (customer_key)
          GROUP BY ALL)
        SELECT country, orders, count(*) AS customers, sum(spent) AS revenue
        FROM per_customer GROUP BY ALL""")


def sql_versions_by_layer(spark, sf_dir):
    """SQL over all three namespaces: product versions of each category as loaded, conformed, and active in the star."""
    return _sql(spark, sf_dir, """
        SELECT c.cat AS category, count(DISTINCT b.prd_id) AS loaded, count(DISTINCT s.prd_id) AS conformed,
               count(DISTINCT g.product_id) AS active
        FROM silver.crm_prd_info s
        JOIN bronze.crm_prd_info b USING (prd_id)
        JOIN silver.erp_px_cat_g1v2 c ON c.id = s.cat_id
        LEFT JOIN gold.dim_products g ON g.product_id = s.prd_id
        GROUP BY c.cat""")


def sql_layer_row_counts(spark, sf_dir):
    """Row counts of every registered table in the three namespaces."""
    wh = _wh(spark, sf_dir)
    tables = wh.register_catalog()
    return spark.sql("\nUNION ALL\n".join(
        f"SELECT '{t}' AS object_name, COUNT(*) AS row_count FROM {t}" for t in tables))


# ---- generic operators on other driver tables ---------------------------------
def latest_product_version(spark, sf_dir):
    return audit.latest_product_versions(_wh(spark, sf_dir).raw("crm_prd_info"))


def latest_event_per_user(spark, sf_dir):
    events = extracts.read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return dedupe.latest_per_key(events, "user_id", "ts", tie_breakers=["event_id"], drop_null_keys=True)


def order_validity_ranges(spark, sf_dir):
    orders = extracts.read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("valid_from"))
    return dedupe.validity_end_dates(orders, "o_custkey", "valid_from", "valid_to", tie_breakers=["o_orderkey"])


def join_checked_many_to_one(spark, sf_dir):
    """Conformed sales enriched with customer country; the customer side is
    verified unique on its key before joining."""
    wh = _wh(spark, sf_dir)
    customers = wh.star("dim_customers").select("customer_id", "country")
    sales = wh.conformed("crm_sales_details").select("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_sales")
    joined = joins.checked_join(sales, customers, ["sls_cust_id"], ["customer_id"], "left", "many_to_one")
    return joined.select("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_sales", "country")


def join_checked_one_to_one(spark, sf_dir):
    """Demographics and locations of the same customers, both sides verified unique."""
    wh = _wh(spark, sf_dir)
    people, places = wh.conformed("erp_cust_az12"), wh.conformed("erp_loc_a101").withColumnRenamed("cid", "place_cid")
    joined = joins.checked_join(people, places, ["cid"], ["place_cid"], "inner", "one_to_one")
    return joined.select("cid", "bdate", "gen", "cntry")


def parse_int_dates(spark, sf_dir):
    """Parse statistics of the three integer-coded sales dates."""
    raw = _wh(spark, sf_dir).raw("crm_sales_details")
    cols = ["sls_order_dt", "sls_ship_dt", "sls_due_dt"]
    parsed = raw.select(*[C.parse_int_date(c).alias(c) for c in cols])
    parts = [parsed.agg(F.lit(c).alias("column_name"),
                        F.count(c).alias("parsed_rows"),
                        F.count_if(F.col(c).isNull()).alias("null_rows"),
                        F.min(c).alias("min_date"), F.max(c).alias("max_date")) for c in cols]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def repair_measures(spark, sf_dir):
    """Sales lines whose amount or price the conformed layer repairs."""
    raw = _wh(spark, sf_dir).raw("crm_sales_details")
    bad = C.amount_needs_repair("sls_sales", "sls_quantity", "sls_price") | C.price_needs_repair("sls_price")
    return raw.where(bad).select(
        "sls_ord_num", "sls_prd_key", "sls_quantity",
        F.col("sls_sales").alias("raw_sales"), F.col("sls_price").alias("raw_price"),
        C.repair_amount("sls_sales", "sls_quantity", "sls_price").alias("sales_amount"),
        C.repair_price("sls_price", "sls_sales", "sls_quantity").alias("price"))


def standardize_codes(spark, sf_dir):
    """Every distinct raw code with its standardised value and row count."""
    wh = _wh(spark, sf_dir)
    cust, prd, demo, loc = (wh.raw(n) for n in ("crm_cust_info", "crm_prd_info", "erp_cust_az12", "erp_loc_a101"))
    marital, gender = (C.standardize_code(c, m) for c, m in (("cst_marital_status", C.MARITAL_STATUS), ("cst_gndr", C.CUSTOMER_GENDER)))
    # Both customer codes in one pass over the customers: a row for each, then one count.
    codes = cust.select(F.explode(F.array(*[
        F.struct(F.lit(kind).alias("code_kind"), F.col(raw).alias("raw_code"), std.alias("standardized"))
        for kind, raw, std in (("marital_status", "cst_marital_status", marital), ("customer_gender", "cst_gndr", gender))])).alias("c"))
    out = codes.select("c.*").groupBy("code_kind", "raw_code", "standardized").agg(F.count(F.lit(1)).alias("rows"))
    for kind, df, col, std in [("product_line", prd, "prd_line", C.standardize_code("prd_line", C.PRODUCT_LINE)),
                               ("erp_gender", demo, "gen", C.standardize_code("gen", C.ERP_GENDER)),
                               ("country", loc, "cntry", C.standardize_country("cntry"))]:
        counted = df.groupBy(F.col(col).alias("raw_code"), std.alias("standardized")).agg(F.count(F.lit(1)).alias("rows"))
        out = out.unionByName(counted.select(F.lit(kind).alias("code_kind"), "raw_code", "standardized", "rows"))
    return out


# ---- quality -------------------------------------------------------------------
def dq_silver_report(spark, sf_dir):
    """Row checks as counted while the tables were written; key and lookup checks read the tables."""
    wh = _wh(spark, sf_dir)
    tables = _conformed(wh)
    return quality.quality_report(quality.conformed_checks(wh.as_of), tables, wh.row_counts())


def dq_gold_report(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    tables = _star(wh)
    return quality.quality_report(quality.star_checks(), tables, wh.row_counts())


def _both_layers(spark, sf_dir) -> dict[str, DataFrame]:
    """Both layers' reports, unsorted: a result that unions them has no order to keep."""
    wh = _wh(spark, sf_dir)
    conformed, tables = _conformed(wh), _star(wh)
    return {"silver": quality.run_checks(quality.conformed_checks(wh.as_of), conformed, wh.row_counts()),
            "gold": quality.run_checks(quality.star_checks(), tables, wh.row_counts())}


def dq_all_layers(spark, sf_dir):
    rank = F.when(F.col("severity") == quality.ERROR, 1).otherwise(2)
    return quality.tag_layers(_both_layers(spark, sf_dir)).orderBy("layer", rank, "check_name")


def dq_errors_only(spark, sf_dir):
    return quality.failing_errors(_both_layers(spark, sf_dir)).orderBy("layer", "check_name")


def dq_dirty_conformed(spark, sf_dir):
    """The conformed checks on conformed tables with dirt added by rule, so that checks which clean data pass count rows."""
    wh = _wh(spark, sf_dir)
    tables = _conformed(wh)
    cust, prd = tables["crm_cust_info"], tables["crm_prd_info"]
    padded = cust.withColumn("cst_key", F.when(F.col("cst_id") % 7 == 0, F.concat(F.lit(" "), "cst_key")).otherwise(F.col("cst_key")))
    unsure = prd.select(F.col("cat_id").alias("id"), F.lit("Unsorted").alias("cat"), F.col("prd_line").alias("subcat"),
                        F.col("prd_line").alias("maintenance")).distinct()
    ended = F.when(F.col("prd_id") % 13 == 0, F.date_sub("prd_start_dt", 1)).otherwise(F.col("prd_end_dt"))
    dirty = tables | {
        "crm_cust_info": padded.unionByName(cust.where("cst_id % 5 = 1")),
        "crm_prd_info": prd.unionByName(prd.where("prd_id % 11 = 0")).withColumn("prd_end_dt", ended)
        .withColumn("prd_cost", F.when(F.col("prd_id") % 17 == 0, -F.col("prd_cost")).otherwise(F.col("prd_cost"))),
        "erp_px_cat_g1v2": tables["erp_px_cat_g1v2"].unionByName(unsure),
    }
    return quality.quality_report(quality.conformed_checks(wh.as_of), dirty)


def dq_dirty_star(spark, sf_dir):
    """The star checks on star tables with repeated and null keys, products without a category, and facts that miss their customer."""
    tables = _star(_wh(spark, sf_dir))
    cust, prd, fact = tables["dim_customers"], tables["dim_products"], tables["fact_sales"]
    bare = F.when(F.col("product_key") % 10 != 0, F.col("category"))
    dirty = {
        "dim_customers": cust.where("customer_key % 19 <> 3").unionByName(cust.where("customer_key % 9 = 0"))
        .unionByName(cust.where("customer_key % 50 = 1").withColumn("customer_id", F.lit(None).cast("bigint"))),
        "dim_products": prd.unionByName(prd.where("product_key % 8 = 2")).withColumn("category", bare),
        "fact_sales": fact,
    }
    return quality.quality_report(quality.star_checks(), dirty)


def dq_duplicate_keys(spark, sf_dir):
    """Key checks on the raw (not yet deduplicated) extracts."""
    wh = _wh(spark, sf_dir)
    checks = [
        quality.keys("raw_customer_key_null_or_duplicate", quality.ERROR, "crm_cust_info", "cst_id"),
        quality.keys("raw_product_key_null_or_duplicate", quality.ERROR, "crm_prd_info", "prd_id"),
        quality.keys("raw_order_line_key_null_or_duplicate", quality.ERROR, "crm_sales_details", "sls_ord_num"),
    ]
    return quality.quality_report(checks, _raw(wh))


COLLATION = "UTF8_LCASE_RTRIM"


def _respelled(key: str):
    """Some values of a key column in lower case and with trailing spaces."""
    c = F.col(key)
    return F.when(c.endswith("3"), F.lower(c)).when(c.endswith("5"), F.concat(c, F.lit("  "))).when(c.endswith("7"), F.concat(F.lower(c), F.lit(" "))).otherwise(c)


def star_collated_keys(spark, sf_dir):
    """Dimensions and facts from tables that spell keys differently, joined under a collation that ignores case and trailing spaces."""
    wh = _wh(spark, sf_dir)
    respelled = lambda table, key: wh.conformed(table).withColumn(key, _respelled(key))
    customers = star.dim_customers(wh.conformed("crm_cust_info"), respelled("erp_cust_az12", "cid"), respelled("erp_loc_a101", "cid"), COLLATION)
    products = star.dim_products(wh.conformed("crm_prd_info"), wh.conformed("erp_px_cat_g1v2").withColumn("id", F.lower("id")), COLLATION)
    fact = star.fact_sales(respelled("crm_sales_details", "sls_prd_key"), products, customers, COLLATION)
    joined = fact.join(products.select("product_key", "category"), "product_key", "left").join(customers.select("customer_key", "gender", "country"), "customer_key", "left")
    return joined.groupBy("category", "gender", "country").agg(F.count(F.lit(1)).alias("sales"), F.sum("sales_amount").alias("revenue"))


def dq_collated_keys(spark, sf_dir):
    """Key and lookup checks, binary and under the collation, on customers of which some come twice, spelled differently."""
    wh = _wh(spark, sf_dir)
    customers = wh.conformed("crm_cust_info").select("cst_key")
    tables = {"customers": customers.unionByName(customers.where(F.col("cst_key").rlike("[3578]$")).withColumn("cst_key", _respelled("cst_key"))),
              "people": wh.conformed("erp_cust_az12").select(_respelled("cid").alias("cid"))}
    checks = []
    for name, collation in (("binary", None), ("collated", COLLATION)):
        checks += [quality.keys(f"customer_key_null_or_duplicate_{name}", quality.ERROR, "customers", "cst_key", collation),
                   quality.unmatched(f"customer_without_demographics_{name}", quality.WARNING, "customers", "cst_key", "people", "cid", collation)]
    reports = [quality.run_checks([c for c in checks if c.name.endswith(n)], tables) for n in ("binary", "collated")]
    return reports[0].unionByName(reports[1])


def latest_customer_collated(spark, sf_dir):
    """The newest version of each customer key, with keys that differ in case and trailing spaces as one."""
    raw = _wh(spark, sf_dir).raw("crm_cust_info").select(_respelled("cst_key").alias("cst_key"), "cst_create_date", "cst_firstname")
    older = _wh(spark, sf_dir).raw("crm_cust_info").select("cst_key", F.date_sub("cst_create_date", 10).alias("cst_create_date"), "cst_firstname")
    return dedupe.latest_per_key(raw.unionByName(older), "cst_key", "cst_create_date", tie_breakers=["cst_firstname"], collation=COLLATION)


def dq_unmatched_category(spark, sf_dir):
    """Product versions without a category, before and after harmonising
    the CRM category key."""
    wh = _wh(spark, sf_dir)
    tables = {
        # Only the category id matters here: derive it from the raw key
        # without the harmonisation, and compare with the conformed table.
        "before": wh.raw("crm_prd_info").select(C.category_id("prd_key").alias("cat_id")),
        "after": wh.conformed("crm_prd_info"),
        "categories": wh.conformed("erp_px_cat_g1v2"),
    }
    checks = [
        quality.unmatched("crm_product_unmatched_category_before_harmonization", quality.ERROR,
                          "before", "cat_id", "categories", "id"),
        quality.unmatched("crm_product_unmatched_category", quality.ERROR, "after", "cat_id", "categories", "id"),
    ]
    return quality.quality_report(checks, tables)


def dq_orphan_keys(spark, sf_dir):
    checks = [c for c in quality.star_checks() if c.kind == "orphans"]
    return quality.quality_report(checks, _star(_wh(spark, sf_dir)))


def _pick(spark, sf_dir, names: set[str], raw_checks=()) -> DataFrame:
    """A report of some checks; only the tables that they name are built."""
    wh = _wh(spark, sf_dir)
    checks = [c for c in quality.conformed_checks(wh.as_of) + quality.star_checks() if c.name in names] + list(raw_checks)
    table = lambda n: (wh.star(n) if n in STAR_TABLES else wh.raw(n[4:]) if n.startswith("raw_") else wh.conformed(n))
    wanted = {t for c in checks for t in (c.table, c.lookup, *[d for d, _ in c.dims]) if t}
    return quality.quality_report(checks, {n: table(n) for n in wanted})


def dq_date_sequence(spark, sf_dir):
    return _pick(spark, sf_dir, {"crm_sales_invalid_date_sequence", "fact_sales_invalid_date_sequence",
                                 "crm_sales_missing_order_date", "fact_sales_missing_order_date"})


def dq_measures(spark, sf_dir):
    raw = quality.rows("raw_sales_invalid_measure", quality.ERROR, "raw_crm_sales_details",
                       lambda: C.invalid_measure("sls_sales", "sls_quantity", "sls_price"))
    return _pick(spark, sf_dir, {"crm_sales_invalid_measure", "fact_sales_invalid_measure"}, [raw])


def dq_birthdate(spark, sf_dir):
    as_of = _wh(spark, sf_dir).as_of
    lit = lambda: F.lit(str(as_of)).cast("date")
    raw = quality.rows("raw_erp_customer_implausible_birthdate", quality.WARNING, "raw_erp_cust_az12",
                       lambda: (F.col("bdate") < F.add_months(lit(), -110 * 12)) | (F.col("bdate") > lit()))
    return _pick(spark, sf_dir, {"erp_customer_implausible_birthdate"}, [raw])


def dq_raw_domains(spark, sf_dir):
    """Domain checks applied to the raw, still-coded values (they fail)."""
    checks = [
        quality.rows("raw_customer_invalid_marital_status", quality.ERROR, "raw_crm_cust_info",
                     lambda: C.outside_domain("cst_marital_status", ["Single", "Married", C.UNKNOWN])),
        quality.rows("raw_product_invalid_line", quality.ERROR, "raw_crm_prd_info",
                     lambda: C.outside_domain("prd_line", ["Mountain", "Road", "Other Sales", "Touring", C.UNKNOWN])),
        quality.rows("raw_product_invalid_cost", quality.ERROR, "raw_crm_prd_info",
                     lambda: F.col("prd_cost").isNull() | (F.col("prd_cost") < 0)),
    ]
    return _pick(spark, sf_dir, set(), checks)


QUERIES: dict[str, Query] = {
    "silver_crm_cust_info": _conformed_table("crm_cust_info"),
    "silver_crm_prd_info": _conformed_table("crm_prd_info"),
    "silver_crm_sales_details": _conformed_table("crm_sales_details"),
    "silver_erp_cust_az12": _conformed_table("erp_cust_az12"),
    "silver_erp_loc_a101": _conformed_table("erp_loc_a101"),
    "conform_part_categories": conform_part_categories,
    "gold_dim_customers": _star_table("dim_customers"),
    "gold_dim_products": _star_table("dim_products"),
    "gold_fact_sales": _star_table("fact_sales"),
    "bronze_row_counts": bronze_row_counts,
    "bronze_csv_roundtrip_products": bronze_csv_roundtrip_products,
    "bronze_csv_null_tokens": bronze_csv_null_tokens,
    "bronze_tolerated_rejects": bronze_tolerated_rejects,
    "metrics_csv_roundtrip": metrics_csv_roundtrip,
    "gold_row_counts": gold_row_counts,
    "kpi_summary": kpi_summary,
    "kpi_average_order_value": kpi_average_order_value,
    "kpi_monthly_revenue": kpi_monthly_revenue,
    "kpi_yearly_activity": kpi_yearly_activity,
    "kpi_revenue_by_country": kpi_revenue_by_country,
    "kpi_revenue_by_product_line": kpi_revenue_by_product_line,
    "kpi_category_performance": kpi_category_performance,
    "kpi_category_by_month": kpi_category_by_month,
    "kpi_order_date_range": kpi_order_date_range,
    "kpi_revenue_share_by_category": kpi_revenue_share_by_category,
    "kpi_revenue_share_by_product_line": kpi_revenue_share_by_product_line,
    "trend_monthly_filled": trend_monthly_filled,
    "trend_customer_months_filled": trend_customer_months_filled,
    "ordered_monthly_revenue": ordered_monthly_revenue,
    "ordered_revenue_by_country": ordered_revenue_by_country,
    "ordered_quality_report": ordered_quality_report,
    "metric_average_revenue": metric_average_revenue,
    "metric_duplicate_excess": metric_duplicate_excess,
    "metric_repair_counts": metric_repair_counts,
    "metric_category_matches": metric_category_matches,
    "metrics_audit": metrics_audit,
    "audit_invariants": audit_invariants,
    "sql_repeat_customers": sql_repeat_customers,
    "sql_versions_by_layer": sql_versions_by_layer,
    "sql_layer_row_counts": sql_layer_row_counts,
    "latest_product_version": latest_product_version,
    "latest_event_per_user": latest_event_per_user,
    "order_validity_ranges": order_validity_ranges,
    "join_checked_many_to_one": join_checked_many_to_one,
    "join_checked_one_to_one": join_checked_one_to_one,
    "parse_int_dates": parse_int_dates,
    "repair_measures": repair_measures,
    "standardize_codes": standardize_codes,
    "dq_silver_report": dq_silver_report,
    "dq_gold_report": dq_gold_report,
    "dq_all_layers": dq_all_layers,
    "dq_errors_only": dq_errors_only,
    "dq_dirty_conformed": dq_dirty_conformed,
    "dq_dirty_star": dq_dirty_star,
    "star_collated_keys": star_collated_keys,
    "latest_customer_collated": latest_customer_collated,
    "dq_collated_keys": dq_collated_keys,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_unmatched_category": dq_unmatched_category,
    "dq_orphan_keys": dq_orphan_keys,
    "dq_date_sequence": dq_date_sequence,
    "dq_measures": dq_measures,
    "dq_birthdate": dq_birthdate,
    "dq_raw_domains": dq_raw_domains,
}

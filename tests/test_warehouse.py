"""End-to-end build over the sf0.01 driver tables: every layer, KPI and
quality count against the expected values (as_of 2026-01-01)."""

from __future__ import annotations

import contextlib
import os

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakestar.operators import kpi, quality
from lakestar.plans import catalog
from lakestar.plans.build import CONFORMED_RULES, STAR_TABLES
from conftest import SF001

EXPECTED_CHECKS = {
    "crm_customer_key_null_or_duplicate": ("error", 0),
    "crm_customer_key_whitespace": ("error", 0),
    "crm_customer_invalid_marital_status": ("error", 0),
    "crm_customer_unknown_gender": ("warning", 623),
    "crm_product_key_null_or_duplicate": ("error", 0),
    "crm_product_unmatched_category": ("error", 0),
    "crm_product_invalid_cost": ("error", 0),
    "crm_product_invalid_line": ("error", 0),
    "crm_product_invalid_date_range": ("error", 0),
    "crm_sales_missing_order_date": ("warning", 557),
    "crm_sales_invalid_date_sequence": ("error", 28901),
    "crm_sales_invalid_measure": ("error", 2),
    "erp_customer_implausible_birthdate": ("warning", 15),
    "erp_customer_unknown_gender": ("warning", 500),
    "erp_location_unknown_country": ("warning", 470),
    "erp_category_key_null_or_duplicate": ("error", 0),
    "erp_category_invalid_maintenance_value": ("error", 0),
    "dim_customer_surrogate_key_null_or_duplicate": ("error", 0),
    "dim_customer_natural_key_null_or_duplicate": ("error", 0),
    "dim_customer_unknown_gender": ("warning", 208),
    "dim_customer_unknown_country": ("warning", 469),
    "dim_product_surrogate_key_null_or_duplicate": ("error", 0),
    "dim_product_natural_key_null_or_duplicate": ("error", 0),
    "dim_product_missing_category_enrichment": ("error", 0),
    "fact_sales_missing_dimension_key": ("error", 106),
    "fact_sales_orphan_dimension_key": ("error", 106),
    "fact_sales_missing_order_date": ("warning", 557),
    "fact_sales_invalid_date_sequence": ("error", 28901),
    "fact_sales_invalid_measure": ("error", 2),
}


def test_layer_row_counts(wh01):
    raw = {n: wh01.raw(n).count() for n in CONFORMED_RULES}
    assert raw == {"crm_cust_info": 1541, "crm_prd_info": 3999, "crm_sales_details": 60000,
                   "erp_cust_az12": 1500, "erp_loc_a101": 1500, "erp_px_cat_g1v2": 6}
    assert wh01.conformed("crm_cust_info").count() == 1496
    assert wh01.conformed("crm_prd_info").count() == 3999
    assert wh01.conformed("crm_sales_details").count() == 60000
    assert {n: wh01.star(n).count() for n in STAR_TABLES} == {
        "dim_customers": 1496, "dim_products": 2000, "fact_sales": 60000}


def test_conformed_schemas_and_load_stamp(wh01):
    from lakestar.schemas import CONFORMED, LOAD_STAMP

    for name, schema in CONFORMED.items():
        assert wh01.conformed(name).columns == schema.fieldNames()
        stamped = wh01.conformed(name, stamped=True)
        assert stamped.columns[-1] == LOAD_STAMP


def test_raw_customer_dirt(spark, wh01):
    row = catalog.metric_duplicate_excess(spark, SF001).first()
    assert (row.null_ids, row.duplicate_excess) == (4, 41)


def test_newest_customer_version_wins(wh01):
    # Customers with key % 37 == 5 get a newer version (2022) with status 'M'.
    c = wh01.conformed("crm_cust_info").where((F.col("cst_id") % 37 == 5) & (F.col("cst_id") % 401 != 7))
    assert c.where(F.year("cst_create_date") != 2022).count() == 0
    assert c.where(F.col("cst_marital_status") != "Married").count() == 0


def test_repairs(spark, wh01):
    row = catalog.metric_repair_counts(spark, SF001).first()
    assert (row.sales_amount_rows_repaired, row.sales_price_rows_repaired) == (353, 372)


def test_summary_kpis(wh01):
    row = kpi.summary(wh01.star("fact_sales")).first()
    assert (row.total_revenue, row.distinct_orders, row.distinct_customers) == (3182485324, 14743, 1496)


def test_revenue_breakdowns(wh01):
    fact, products = wh01.star("fact_sales"), wh01.star("dim_products")
    by_cat = {r.category: r.revenue for r in kpi.category_performance(fact, products).collect()}
    assert by_cat == {"Bikes": 1088649856, "Components": 1040020601, "Clothing": 558542640,
                      "Accessories": 495272227}
    by_line = {r.product_line: r.revenue for r in kpi.revenue_by_product_line(fact, products).collect()}
    assert by_line == {"Touring": 687167556, "Other Sales": 641826543, "Mountain": 633399739,
                       "n/a": 609798126, "Road": 610293360}
    ordered = [r.revenue for r in kpi.revenue_by_product_line(fact, products).collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_months_and_date_range(wh01):
    fact = wh01.star("fact_sales")
    assert kpi.monthly_revenue(fact).count() == 80
    assert kpi.monthly_revenue_filled(fact).count() == 80
    row = kpi.order_date_range(fact).first()
    assert (row.first_order_date, row.last_order_date) == (dt.date(1995, 1, 1), dt.date(2001, 8, 1))


def test_customer_dimension(wh01):
    dim = wh01.star("dim_customers")
    assert {r.gender: r["count"] for r in dim.groupBy("gender").count().collect()} == {
        "Female": 497, "Male": 791, "n/a": 208}
    assert wh01.conformed("erp_cust_az12").where(F.col("bdate").isNull()).count() == 15
    keys = dim.agg(F.min("customer_key"), F.max("customer_key"), F.count_distinct("customer_key")).first()
    assert tuple(keys) == (1, 1496, 1496)


def test_quality_reports(spark, wh01):
    report = catalog.dq_all_layers(spark, SF001).collect()
    got = {r.check_name: (r.severity, r.failed_rows) for r in report}
    assert got == EXPECTED_CHECKS
    silver = [r.check_name for r in catalog.dq_silver_report(spark, SF001).collect()]
    severities = [EXPECTED_CHECKS[n][0] for n in silver]
    assert severities == sorted(severities)  # errors first
    assert len(silver) == 17


def test_quality_gate_fails_on_errors(spark, wh01):
    reports = {"silver": catalog.dq_silver_report(spark, SF001), "gold": catalog.dq_gold_report(spark, SF001)}
    with pytest.raises(quality.QualityError, match="fact_sales_invalid_date_sequence"):
        quality.quality_gate(reports)


def test_error_checks_fire_on_dirty_input(spark, wh01):
    dirty = {r.check_name: r.failed_rows for r in catalog.dq_raw_domains(spark, SF001).collect()}
    assert all(v > 0 for v in dirty.values())
    keys = {r.check_name: r.failed_rows for r in catalog.dq_duplicate_keys(spark, SF001).collect()}
    assert keys["raw_customer_key_null_or_duplicate"] == 42  # 41 duplicated ids + the null key
    unmatched = {r.check_name: r.failed_rows for r in catalog.dq_unmatched_category(spark, SF001).collect()}
    assert unmatched["crm_product_unmatched_category_before_harmonization"] > 0
    assert unmatched["crm_product_unmatched_category"] == 0


def test_metrics_audit(spark, wh01):
    rows = catalog.metrics_audit(spark, SF001).collect()
    got = {r.metric: r.value for r in rows}
    assert len(rows) == 19
    assert got["total_revenue"] == "3182485324"
    assert got["distinct_orders"] == "14743"
    assert got["silver_customer_rows"] == "1496"
    assert got["gold_active_product_rows"] == "2000"
    assert got["active_product_category_matches_after_harmonization"] == "2000"


def test_published_run_is_readable(spark, wh01):
    from lakestar.plans.build import open_published

    wh01.publish()
    again = open_published(spark, SF001)
    assert again.run_dir == wh01.run_dir
    assert again.star("fact_sales").count() == 60000


def test_invariants(spark, wh01):
    from lakestar.operators import audit

    report = catalog.audit_invariants(spark, SF001)
    got = {r.invariant: (r.failures, r.holds) for r in report.collect()}
    assert set(got) == set(audit.INVARIANTS)
    assert got["customer_id_null_or_not_unique"] == (0, True)
    assert got["fact_rows_differ_from_raw_sales"] == (0, True)
    assert got["fact_revenue_differs_from_raw_sales"] == (0, True)
    assert got["fact_dimension_key_missing"] == (106, False)
    with pytest.raises(audit.InvariantError, match="fact_dimension_key_missing=106"):
        audit.assert_invariants(report)


def test_sql_over_layer_namespaces(spark, wh01):
    tables = wh01.register_catalog()
    assert "gold.fact_sales" in tables and "bronze.crm_sales_details" in tables
    row = spark.sql("SELECT SUM(CAST(sales_amount AS BIGINT)) AS r FROM gold.fact_sales").first()
    assert row.r == 3182485324
    stamped = spark.table("silver.crm_cust_info").columns
    assert stamped[-1] == "dwh_create_date"
    by_country = spark.sql(
        "SELECT c.country, SUM(CAST(f.sales_amount AS BIGINT)) AS revenue FROM gold.fact_sales AS f "
        "JOIN gold.dim_customers AS c ON f.customer_key = c.customer_key GROUP BY c.country").collect()
    assert sum(r.revenue for r in by_country) <= 3182485324


@pytest.mark.parametrize("attribute,dim,key", [("country", "dim_customers", "customer_key"),
                                               ("category", "dim_products", "product_key")])
def test_revenue_by_plans_agree(spark, wh01, attribute, dim, key):
    fact, d = wh01.star("fact_sales"), wh01.star(dim)
    extra = {"units": F.sum(F.col("quantity").cast("bigint"))}
    small = kpi.revenue_by(fact, d, key, attribute, extra).collect()
    with no_broadcast(spark):
        assert small == kpi.revenue_by(fact, d, key, attribute, extra).collect()


def test_rebuild_is_deterministic(spark, wh01):
    """A second, independent run (other folder, other slice count) produces
    identical layers, surrogate keys included."""
    from lakestar.plans.build import Warehouse

    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        again = Warehouse(spark, SF001).build()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert again.run_dir != wh01.run_dir
    for name in ("crm_cust_info", "crm_prd_info", "crm_sales_details"):
        a, b = wh01.conformed(name), again.conformed(name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    for name in STAR_TABLES:
        a, b = wh01.star(name), again.star(name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_hot_keys_end_to_end(spark, wh01):
    """One customer and one product carry over a third of all sales lines:
    the build and the breakdowns stay exact (partial aggregation, skew-safe
    joins), checked against direct computations on the same input."""
    from lakestar.plans.build import Warehouse

    raw = wh01.raw("crm_sales_details")
    hot_customer = wh01.conformed("crm_cust_info").agg(F.min("cst_id")).first()[0]
    hot_product = wh01.star("dim_products").orderBy("product_key").first().product_number
    skewed = raw.select(
        "sls_ord_num",
        F.when(F.crc32("sls_ord_num") % 3 == 0, F.lit(hot_product)).otherwise(F.col("sls_prd_key")).alias("sls_prd_key"),
        F.when(F.crc32(F.concat("sls_ord_num", "sls_prd_key")) % 2 == 0, F.lit(hot_customer))
        .otherwise(F.col("sls_cust_id")).alias("sls_cust_id"),
        "sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_quantity", "sls_price")
    frames = {n: wh01.raw(n) for n in CONFORMED_RULES}
    frames["crm_sales_details"] = skewed
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        hot = Warehouse(spark, SF001, raw_frames=frames).build()
        fact = hot.star("fact_sales")
        assert fact.count() == 60000
        share = fact.where(F.col("customer_key") == 1).count() / 60000
        assert share > 0.33
        got = {r.country: r.revenue for r in kpi.revenue_by_country(fact, hot.star("dim_customers")).collect()}
        exp = {r.country: r.revenue for r in fact.join(hot.star("dim_customers"), "customer_key")
               .groupBy("country").agg(F.sum(F.col("sales_amount").cast("bigint")).alias("revenue")).collect()}
        assert got == exp
        orphans = quality.count_orphans(fact, [(hot.star("dim_customers"), "customer_key"),
                                               (hot.star("dim_products"), "product_key")]).first()[0]
        assert orphans == fact.where(F.col("customer_key").isNull() | F.col("product_key").isNull()).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_sort_merge_joins_agree_and_split_hot_keys(spark, wh01):
    """Above the broadcast threshold the star builder takes sort-merge joins: same rows, and AQE splits the hot key's partition."""
    from lakestar.operators import joins, star

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    sales = wh01.conformed("crm_sales_details")
    dim_p, dim_c = wh01.star("dim_products"), wh01.star("dim_customers")
    hot = sales.withColumn("sls_cust_id", F.when(F.crc32("sls_ord_num") % 2 == 0, F.lit(5).cast("bigint")).otherwise(F.col("sls_cust_id")))
    hot = hot.unionByName(hot).unionByName(hot)
    expected = star.fact_sales(hot, dim_p, dim_c)
    left, right = sales.select("sls_ord_num", "sls_cust_id"), dim_c.select("customer_id", "country")
    checked = joins.checked_join(left, right, ["sls_cust_id"], ["customer_id"])
    sizes = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    with no_broadcast(spark, sizes):
        got = star.fact_sales(hot, dim_p, dim_c)
        got.write.format("noop").mode("overwrite").save()
        ran = got.select("*")
        ran.collect()
        final = ran._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final
        assert "skew=true" in final
        assert same(got, expected)
        assert same(joins.checked_join(left, right, ["sls_cust_id"], ["customer_id"]), checked)


@contextlib.contextmanager
def no_broadcast(spark, more=()):
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} | dict(more)
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_long_keys_stay_apart(spark, tmp_path):
    """Keys of 9 and 11 digits and beyond 32 bits: one dimension row for each, by DuckDB's joins too."""
    import duckdb

    from lakestar.plans.build import SOURCE_TABLES, Warehouse
    from lakestar.plans.oracle import PREFIX

    from conftest import SF0001

    shift = 123456780 * 37  # customers and parts keep their rules by key modulo small numbers, roughly; all that counts is that they differ
    con = duckdb.connect()
    for t in SOURCE_TABLES:
        change = {"customer": "REPLACE (c_custkey + k AS c_custkey)", "orders": "REPLACE (o_custkey + k AS o_custkey)",
                  "part": "REPLACE (p_partkey + k AS p_partkey)", "lineitem": "REPLACE (l_partkey + k AS l_partkey)"}.get(t, "")
        wide = f"CASE WHEN {{0}} % 2 = 0 THEN 123456780 ELSE {shift * 10} END"
        key = {"customer": "c_custkey", "orders": "o_custkey", "part": "p_partkey", "lineitem": "l_partkey"}.get(t, "0")
        con.execute(f"COPY (SELECT * EXCLUDE (k) FROM (SELECT * {change} FROM (SELECT *, CAST({wide.format(key)} AS BIGINT) AS k "
                    f"FROM read_parquet('{SF0001}/{t}.parquet')) x) y) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{tmp_path}/{t}.parquet')")
    wh = Warehouse(spark, str(tmp_path)).build()
    for name, key in (("dim_customers", "customer_id"), ("dim_products", "product_number")):
        rows = sorted(wh.star(name).collect())
        expected = sorted(con.sql(f"{PREFIX} SELECT {', '.join(wh.star(name).columns)} FROM g_{name}").fetchall(), key=lambda r: r[0])
        assert [tuple(r) for r in rows] == expected and len({r[key] for r in rows}) == len(rows) > 50
    assert wh.star("dim_customers").agg(F.max("customer_id")).first()[0] > 2 ** 32
    assert wh.star("fact_sales").where("product_key IS NOT NULL").count() > 0


def test_a_failed_write_can_be_tried_again(spark, wh01, monkeypatch):
    from lakestar.operators import conform
    from lakestar.plans import build

    clean, calls = conform.clean_sales, []

    def fails_once(raw):
        calls.append(1)
        if len(calls) > 1:
            return clean(raw)
        return clean(raw).withColumn("sls_sales", F.raise_error(F.lit("a transient fault")).cast("int"))

    monkeypatch.setitem(build.CONFORMED_RULES, "crm_sales_details", lambda raw, as_of: fails_once(raw))
    wh = build.Warehouse(spark, SF001)
    with pytest.raises(Exception, match="transient|not begun|cancel"):
        wh.build()
    wh.build()
    for name in STAR_TABLES:
        a, b = wh01.star(name), wh.star(name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_a_published_run_keeps_its_date(spark, tmp_path):
    import datetime as dt

    from lakestar.plans.build import Warehouse, open_published

    from conftest import SF0001

    with pytest.raises(FileNotFoundError):
        open_published(spark, root=str(tmp_path))
    wh = Warehouse(spark, SF0001, as_of=dt.date(1980, 1, 1))
    wh.publish()
    again = open_published(spark)
    assert again.as_of == dt.date(1980, 1, 1) and again.run_dir == wh.run_dir
    assert again.star("fact_sales").count() == wh.star("fact_sales").count()


def test_a_changed_source_is_noticed(spark, tmp_path):
    import shutil

    from lakestar.plans.build import SOURCE_TABLES, warehouse_for

    from conftest import SF0001

    for t in SOURCE_TABLES:
        shutil.copyfile(f"{SF0001}/{t}.parquet", tmp_path / f"{t}.parquet")
    one = warehouse_for(spark, str(tmp_path))
    assert warehouse_for(spark, str(tmp_path)) is one
    shutil.copyfile("/root/testdata/sf0.01/nation.parquet", tmp_path / "nation.parquet")
    os.utime(tmp_path / "nation.parquet", (1, 1))
    assert warehouse_for(spark, str(tmp_path)) is not one


@pytest.fixture
def own_store(monkeypatch, tmp_path):
    """A shared folder of the test's own."""
    from lakestar import session
    from lakestar.plans import build

    for module in (session, build):
        monkeypatch.setattr(module, "shared_root", lambda spark: str(tmp_path / "store"))
    return f"{tmp_path}/store/lakestar/warehouse"


def test_another_process_goes_on_with_a_failed_build(spark, own_store, monkeypatch):
    from lakestar.plans import build

    from conftest import SF0001

    def fails(raw, as_of):
        raise ValueError("killed")

    with monkeypatch.context() as m:
        m.setitem(build.CONFORMED_RULES, "erp_loc_a101", fails)
        first = build.Warehouse(spark, SF0001)
        with pytest.raises(ValueError, match="killed"):
            first.build(parallelism=1)
    done = dict(first._paths)
    assert done and ("star", "fact_sales") not in done
    # Nothing is shared with the first but the store: another reference date or other sources are other runs.
    assert build.Warehouse.resume(spark, SF0001, as_of=dt.date(1980, 1, 1)).run_dir != first.run_dir
    assert build.Warehouse.resume(spark, "/root/testdata/sf0.01").run_dir != first.run_dir
    second = build.Warehouse.resume(spark, SF0001).build()
    assert second.run_dir == first.run_dir and {k: second._paths[k] for k in done} == done
    for name in build.STAR_TABLES:
        want = build.Warehouse(spark, SF0001).star(name)
        assert second.star(name).schema == want.schema and second.star(name).exceptAll(want).count() == 0
    second.publish()
    assert build.Warehouse.resume(spark, SF0001).run_dir != second.run_dir  # a published run is done


def test_retire_keeps_the_newest_runs_and_those_in_grace(spark, own_store):
    import os.path

    from lakestar.plans import build

    from conftest import SF0001

    def run():
        wh = build.Warehouse(spark, SF0001)
        wh.raw("erp_px_cat_g1v2")
        wh.build = lambda: wh  # one table is enough here
        wh.publish()
        return wh

    runs = [run() for _ in range(4)]
    left = build.Warehouse(spark, SF0001)  # never published
    left.raw("erp_px_cat_g1v2")
    there = lambda: [os.path.isdir(r.run_dir) for r in [*runs, left]]
    assert build.retire(spark, keep=2) == [] and there() == [True] * 5  # all have changed within a day
    reader = build.open_published(spark)
    gone = build.retire(spark, keep=2, grace=dt.timedelta(0))
    assert sorted(gone) == sorted([runs[0].run_dir, runs[1].run_dir, left.run_dir]) and there() == [False, False, True, True, False]
    assert reader.raw("erp_px_cat_g1v2").count() == 6 and build.open_published(spark).run_dir == runs[3].run_dir
    assert [p["run_dir"] for p in build._pointers(spark, own_store)] == [runs[2].run_dir, runs[3].run_dir]


def test_csv_run_tolerates_and_lists_bad_rows(spark, own_store, tmp_path):
    from lakestar.plans import build
    from lakestar.schemas import RAW
    from lakestar.sources import csv_io

    root = tmp_path / "datasets"
    for table, rel in csv_io.SOURCE_FILES.items():
        (root / rel).parent.mkdir(parents=True, exist_ok=True)
        (root / rel).write_text(",".join(RAW[table].fieldNames()) + "\n")
    (root / csv_io.SOURCE_FILES["erp_loc_a101"]).write_text("cid,cntry\nAW-1,DE\nAW-2\nAW-3,US,x\n")
    wh = build.Warehouse.from_csv(spark, str(root), max_rejects=10)
    assert [r.cid for r in wh.conformed("erp_loc_a101").collect()] == ["AW1"]
    assert sorted((r.table_name, r.line) for r in wh.rejects().collect()) == [("erp_loc_a101", "AW-2"), ("erp_loc_a101", "AW-3,US,x")]
    again = build.Warehouse.resume(spark, str(root), make=build.Warehouse.from_csv, max_rejects=10)
    assert again.run_dir == wh.run_dir and again.rejects().count() == 2
    with pytest.raises(csv_io.RejectError):
        build.Warehouse.from_csv(spark, str(root), max_rejects=1).raw("erp_loc_a101")


def test_row_checks_are_counted_while_tables_are_written(spark, own_store, monkeypatch):
    from lakestar.operators import quality
    from lakestar.plans import build

    from conftest import SF0001

    wh = build.Warehouse(spark, SF0001)
    # The sales' first write fails in its second task, after rows were counted; what counts is the write that succeeds.
    rule = build.CONFORMED_RULES["crm_sales_details"]
    broken = F.when(F.col("sls_quantity") < 0, F.lit(0)).otherwise(F.raise_error("half way")).cast("int")

    def fails(raw, as_of):
        half = F.spark_partition_id() == 1
        return rule(raw, as_of).repartition(2).withColumn("sls_quantity", F.when(half, broken).otherwise(F.col("sls_quantity")))

    with monkeypatch.context() as m:
        m.setitem(build.CONFORMED_RULES, "crm_sales_details", fails)
        with pytest.raises(Exception, match="half way"):
            wh.conformed("crm_sales_details")
    assert not any(k.startswith("crm_sales") for k in wh.row_counts())
    wh.build()
    conformed, star = {n: wh.conformed(n) for n in build.CONFORMED_RULES}, {n: wh.star(n) for n in build.STAR_TABLES}
    for checks, tables in ((quality.conformed_checks(wh.as_of), conformed), (quality.star_checks(), star)):
        rows = [c.name for c in checks if c.kind == "rows"]
        assert set(rows) <= set(wh.row_counts())
        seen, read = (quality.run_checks(checks, tables, known) for known in (wh.row_counts(), None))
        assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, read.collect()))
        only = quality.run_checks([c for c in checks if c.kind == "rows"], tables, wh.row_counts())
        assert "parquet" not in only._jdf.queryExecution().executedPlan().toString().lower()
    wh.publish()
    assert build.open_published(spark).row_counts() == wh.row_counts() == build.Warehouse(spark, SF0001).build().row_counts()


def test_a_month_is_a_partition(spark, wh01):
    months = wh01.sales_by_month()
    assert months.drop("order_month").exceptAll(wh01.star("fact_sales")).count() == 0
    one = months.where("order_month = DATE'1996-03-01'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert one.select(F.input_file_name()).distinct().count() == 1
    assert one.count() == wh01.star("fact_sales").where("year(order_date) = 1996 and month(order_date) = 3").count()
    assert months.where("order_month IS NULL").count() == wh01.star("fact_sales").where("order_date IS NULL").count() > 0


def test_a_rewritten_file_in_a_table_folder_is_noticed(spark, tmp_path):
    from lakestar.plans import build

    path = tmp_path / "t.parquet"
    spark.range(3).coalesce(1).write.parquet(str(path))
    before, stamp = build._status(spark, str(path)), os.stat(path)
    part = next(path.glob("part-*"))
    part.write_bytes(part.read_bytes() + b" ")
    os.utime(path, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    assert build._status(spark, str(path)) != before


def test_catalog_never_replaces_managed_tables(spark, wh01):
    from lakestar.plans import build
    from lakestar.session import new_run_dir

    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS guarded LOCATION '{new_run_dir(spark, 'guarded')}'")
    spark.sql("DROP TABLE IF EXISTS guarded.fact_sales")
    spark.range(3).write.saveAsTable("guarded.fact_sales")  # a managed table someone else owns
    try:
        build._CATALOG_OWNER.clear()
        with pytest.raises(RuntimeError, match="MANAGED"):
            wh01.register_catalog({"guarded": "star"})
        assert spark.table("guarded.fact_sales").count() == 3
        assert not spark.catalog.tableExists("guarded.dim_customers")  # nothing changed
    finally:
        spark.sql("DROP TABLE IF EXISTS guarded.fact_sales")
        spark.sql("DROP NAMESPACE IF EXISTS guarded CASCADE")
        build._CATALOG_OWNER.clear()

"""Physical-plan properties that the scale design relies on, read from
``explain()`` output: pushdown and pruning at the scan, no single-task
window over rows, bounded broadcasts, one aggregate pass per table."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import functions as F

from lakestar.operators import dedupe, keys, kpi, quality


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_monthly_revenue_prunes_and_pushes_down(wh01):
    text = plan(kpi.monthly_revenue(wh01.star("fact_sales")))
    scan = text[text.index("Scan parquet"):]
    assert "PushedFilters: [IsNotNull(order_date)]" in scan
    read = [set(f.split(":")[0] for f in x.split(",")) for x in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    assert read == [{"customer_key", "order_date", "sales_amount"}, {"order_number", "order_date"}]


def test_dense_key_has_no_global_row_number(wh01):
    dim = wh01.conformed("crm_cust_info")
    text = plan(keys.dense_key(dim, ["cst_id"], "k"))
    assert "row_number" not in text
    # The only single-partition exchange carries the per-partition counts.
    assert text.count("SinglePartition") == 1
    assert "BroadcastHashJoin" in text


def test_lead_windows_the_index_of_starts_only(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"),
                                  F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"))
    df.write.parquet(f"{tmp_path}/rows")
    text = plan(dedupe.next_value_within_key(spark.read.parquet(f"{tmp_path}/rows"), "k", "d", ["t"], out="n"))
    # Rows are reduced to distinct starts before the index is shuffled and windowed, and no copy of them is written.
    assert text.index("partial_max") < text.index("lead(")
    assert text.count("lead(") and len(re.findall(r"^\(\d+\) Window", text, re.M)) == 1
    assert all(f"{tmp_path}/rows" in x for x in re.findall(r"Location: ([^\n]*)", text))


def test_distinct_counts_multiply_no_rows(wh01):
    for frame in (kpi.summary(wh01.star("fact_sales")), kpi.monthly_revenue(wh01.star("fact_sales"))):
        assert "Expand" not in plan(frame)
    # From the stored rollups the fact isn't read at all.
    for frame in (kpi.summary_of(wh01.rollups()), kpi.monthly_revenue_of(wh01.rollups()), kpi.yearly_activity(wh01.rollups())):
        assert scans(plan(frame), "sales_amount") == 0


def test_checked_join_is_one_plan(wh01):
    from lakestar.operators import joins

    left, right = wh01.conformed("crm_sales_details").select("sls_cust_id", "sls_sales"), wh01.star("dim_customers").select("customer_id", "country")
    text = plan(joins.checked_join(left, right, ["sls_cust_id"], ["customer_id"]))
    assert "raise_error" in text and len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 2


def test_slices_of_a_range_shuffle_are_bounded(spark, monkeypatch):
    from lakestar import session

    monkeypatch.setattr(session, "input_bytes", lambda df: 17 << 40)
    assert session.slices_for(spark.range(1)) == session.MAX_SLICES


def test_latest_per_key_aggregates_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(dedupe.latest_per_key(df, "k", "v"))
    assert "partial_max" in text


def test_row_checks_fold_into_one_pass(wh01):
    checks = [c for c in quality.star_checks() if c.kind == "rows" and c.table == "fact_sales"]
    assert len(checks) >= 4
    text = plan(quality.run_checks(checks, {"fact_sales": wh01.star("fact_sales")}))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1


def test_breakdown_shuffles_keys_not_rows(wh01):
    text = plan(kpi.category_performance(wh01.star("fact_sales"), wh01.star("dim_products")))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # The fact is reduced by surrogate key before it is joined.
    assert text.index("keys [1]: [product_key") < text.index("BroadcastHashJoin Inner") or "partial_sum" in text
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) <= 3


def scans(text: str, column: str) -> int:
    """Scans of the plan that read ``column``."""
    return len([x for x in re.findall(r"ReadSchema: struct<([^\n]*)>", text) if column in x])


def test_reports_and_audit_read_the_sales_once(spark, wh01):
    from lakestar.operators import audit
    from lakestar.plans.build import CONFORMED_RULES, STAR_TABLES

    gold = plan(quality.run_checks(quality.star_checks(), {n: wh01.star(n) for n in STAR_TABLES}))
    assert scans(gold, "sales_amount") == 1
    layers = [{n: getattr(wh01, layer)(n) for n in names} for layer, names in
              (("raw", CONFORMED_RULES), ("conformed", CONFORMED_RULES), ("star", STAR_TABLES))]
    assert scans(plan(audit.audit_metrics(*layers)), "sls_sales") == 1


def test_revenue_share_total_is_a_scalar_subquery(spark):
    groups = spark.range(5000).select(F.col("id").cast("string").alias("g"), (F.col("id") % 97).alias("revenue"))
    text = plan(kpi.revenue_share(groups, "g"))
    assert "Subquery" in text
    assert "Window" not in text and "Join" not in text

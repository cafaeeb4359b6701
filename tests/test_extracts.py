"""The six raw extracts against their test-input specification (the
fixture SQL, run by DuckDB on the same driver tables)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from lakestar.plans import oracle
from lakestar.sources import extracts
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("table", sorted(extracts.EXTRACTS))
def test_extract_matches_fixture_sql(spark, con, table):
    df = extracts.EXTRACTS[table](spark, SF0001)
    sql = oracle.PREFIX + f"SELECT * FROM fx_{table}"
    if table == "crm_prd_info":
        # The raw column is a timestamp; the fixture text produces a date and no end date.
        df = df.select(*[F.col(c).cast("date").alias(c) if c == "prd_start_dt" else F.col(c)
                         for c in df.columns if c != "prd_end_dt"])
    result = compare(df, con, sql)
    assert result["ok"], result


def test_sales_lines_are_narrow_before_their_shuffle(spark):
    plan = extracts.crm_sales_details(spark, SF0001)._jdf.queryExecution().optimizedPlan()
    shuffled = plan.children().apply(0).children().apply(0).output().mkString(",")
    assert "_unit" in shuffled
    assert not any(c in shuffled for c in ("l_suppkey", "l_extendedprice", "l_shipdate"))


def test_due_dates_end_on_the_28th(spark, tmp_path):
    days = ["2020-02-29", "2021-12-31", "2022-01-28", "2022-03-01", None]
    spark.createDataFrame([(i, 1, 1, 2.0, 10.0, d) for i, d in enumerate(days)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, d string") \
        .selectExpr("*", "cast(d as timestamp) l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    rows = extracts.crm_sales_details(spark, str(tmp_path)).orderBy("sls_ord_num").collect()
    assert [(r.sls_ship_dt, r.sls_due_dt) for r in rows] == [(20200229, 20210228), (20211231, 20221228), (20220128, 20230128), (20220301, 20230301), (None, None)]


def test_sales_are_written_with_zstd(wh01):
    from lakestar.session import entries

    for layer, name in (("raw", "crm_sales_details"), ("conformed", "crm_sales_details"), ("star", "fact_sales")):
        files = [f for f, _, _ in entries(wh01.spark, wh01.path(layer, name)) if f.endswith(".parquet")]
        assert files and all(".zstd." in f for f in files)

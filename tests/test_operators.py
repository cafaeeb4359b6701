"""Distributed operators against their single-task SQL definitions, on
inputs with a hot key (a third of all rows), null keys and null dates."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestar.operators import dedupe, joins, keys, kpi, quality


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30000
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 97 == 5, F.lit(None))
        .otherwise(F.col("id") % 700).alias("k"),
        F.when(F.col("id") % 113 == 7, F.lit(None))
        .otherwise(F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 7919 % 3000).cast("int"))).alias("d"),
        F.col("id").alias("t"),
        (F.col("id") % 11).alias("v"),
    )


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_latest_per_key_matches_row_number(skewed):
    got = dedupe.latest_per_key(skewed, "k", "d", tie_breakers=["t"])
    w = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_last(), F.col("t").desc_nulls_last())
    exp = skewed.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert got.columns == skewed.columns
    assert _same(got, exp)


def test_latest_per_key_default_ties(skewed):
    w = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in skewed.columns if c not in "kd"])
    exp = skewed.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert _same(dedupe.latest_per_key(skewed, "k", "d"), exp)  # ties by all other columns


@pytest.mark.parametrize("parts", [3, 8, 17])
def test_next_value_within_key_matches_lead(skewed, parts):
    got = dedupe.next_value_within_key(skewed, "k", "d", ["t"], out="nxt", partitions=parts)
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_first(), F.col("t").asc_nulls_first())
    exp = skewed.withColumn("nxt", F.lead("d").over(w))
    assert _same(got.select(*exp.columns), exp)


def test_validity_end_dates(spark):
    rows = [("A", dt.date(2011, 7, 1), 212), ("A", dt.date(2012, 7, 1), 213), ("A", dt.date(2013, 7, 1), 214),
            ("B", dt.date(2003, 7, 1), 210)]
    df = spark.createDataFrame(rows, "key string, start date, id int")
    got = {r.id: r.end for r in dedupe.validity_end_dates(df, "key", "start", "end", ["id"]).collect()}
    assert got == {212: dt.date(2012, 6, 30), 213: dt.date(2013, 6, 30), 214: None, 210: None}


@pytest.mark.parametrize("parts", [1, 8, 13])
def test_dense_key_matches_row_number(skewed, parts):
    order = [F.col("d").asc_nulls_first(), F.col("t").asc_nulls_first()]
    got = keys.dense_key(skewed, order, "sk", partitions=parts)
    exp = skewed.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("sk"), *skewed.columns)
    assert dict(got.dtypes)["sk"] == "bigint"
    assert _same(got, exp)
    assert got.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first() == (1, 30000, 30000)


def test_count_bad_keys_counts_keys_not_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,), (3,)], "k int")
    assert quality.count_bad_keys(df, "k").first()[0] == 2  # key 1 and the null key


def test_count_orphans_equals_left_join_definition(spark):
    # (2, 12): customer 2 has two dimension rows and the product is missing,
    # so the two left joins emit (and count) two rows.
    fact = spark.createDataFrame([(1, 10), (1, 10), (2, 11), (None, 10), (3, 12), (4, None), (2, 12)],
                                 "ck int, pk int")
    dim_c = spark.createDataFrame([(1,), (2,), (2,), (4,)], "ck int")     # 2 is duplicated (fan-out)
    dim_p = spark.createDataFrame([(10,), (11,)], "pk int")
    got = quality.count_orphans(fact, [(dim_c, "ck"), (dim_p, "pk")]).first()[0]
    f, c, p = fact.alias("f"), dim_c.alias("c"), dim_p.alias("p")
    exp = (f.join(c, F.col("f.ck") == F.col("c.ck"), "left").join(p, F.col("f.pk") == F.col("p.pk"), "left")
           .where(F.col("c.ck").isNull() | F.col("p.pk").isNull()).count())
    assert got == exp == 5


def test_checked_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, x string")
    right = spark.createDataFrame([(1, "one"), (2, "two"), (None, "none"), (None, "nil")], "k2 int, y string")
    out = joins.checked_join(left, right, ["k"], ["k2"], "left", "many_to_one")
    assert sorted((r.k or 0, r.x, r.y) for r in out.collect()) == [(0, "d", None), (0, "e", None), (1, "a", "one"), (2, "b", "two"), (2, "c", "two")]
    assert out.columns == ["k", "x", "k2", "y"]
    with pytest.raises(Exception, match=r"left side is not unique on \['k'\]: k = 2"):
        joins.checked_join(left, right, ["k"], ["k2"], "left", "one_to_one").collect()
    dup = right.unionByName(spark.createDataFrame([(7, "a"), (7, "b")], "k2 int, y string"))  # without a partner
    with pytest.raises(Exception, match="right side is not unique on .*: k2 = 7"):
        joins.checked_join(left, dup, ["k"], ["k2"], "left", "many_to_one").collect()
    ones = left.where("x <> 'c'")
    assert joins.checked_join(ones, right, ["k"], ["k2"], "left", "one_to_one").count() == 4  # null keys are no copies of each other
    assert joins.checked_join(ones, dup, ["k"], ["k2"], "inner", "one_to_many").count() == 2
    with pytest.raises(joins.CardinalityError, match="not unique"):
        joins.assert_unique(dup, ["k2"])


def test_distinct_counts_by_bitmaps(spark):
    """Against count_distinct: numbers, texts with numbers in several spaces, other texts, nulls, a hot key."""
    from lakestar.operators import distinct

    texts = F.when(F.col("id") % 3 == 0, "SO7").when(F.col("id") % 41 == 1, F.concat(F.lit("SO0"), F.col("id") % 90)) \
        .when(F.col("id") % 43 == 2, F.concat(F.lit("X"), F.col("id") % 2000)).when(F.col("id") % 47 == 3, F.lit("=SO7")) \
        .when(F.col("id") % 53 == 4, F.lit(None)).when(F.col("id") % 59 == 5, F.lit("")).when(F.col("id") % 61 == 6, F.lit("9" * 25)) \
        .otherwise(F.concat(F.lit("SO"), (F.col("id") * 7919) % 100000))
    df = spark.range(20000).select((F.col("id") % 5).alias("g"), texts.alias("t"), F.when(F.col("id") % 9 != 0, F.col("id") * 31 - 200000).alias("n"),
                                   (F.col("id") % 13).alias("m"))
    for key in ("t", "n"):
        maps = distinct.key_bitmaps(df, ["g"], key, {"total": "m"})
        one = {r.g: r.keys for r in distinct.distinct_keys(maps, ["g"], "keys", merged=False).collect()}
        assert one == {r.g: r.keys for r in df.groupBy("g").agg(F.count_distinct(key).alias("keys")).collect()}
        assert distinct.distinct_keys(maps, [], "keys").first().keys == df.agg(F.count_distinct(key)).first()[0]
        assert maps.agg(F.sum("total")).first()[0] == df.agg(F.sum("m")).first()[0]


def test_summary_of_no_and_of_null_rows(spark):
    schema = "order_number string, customer_key bigint, order_date date, sales_amount int"
    none = spark.createDataFrame([], schema)
    assert tuple(kpi.summary(none).first()) == (None, 0, 0, None) and kpi.monthly_revenue(none).count() == 0
    odd = spark.createDataFrame([(None, None, None, 5), ("SO1", None, dt.date(2020, 1, 3), None), (None, 4, dt.date(2020, 1, 9), 7)], schema)
    assert [float(x) for x in kpi.summary(odd).first()] == [12, 1, 1, 12]
    assert [tuple(r) for r in kpi.monthly_revenue(odd).collect()] == [(dt.date(2020, 1, 1), 7, 1, 1)]


def test_lead_of_equal_starts_and_of_versions_that_are_equal(spark):
    day = dt.date
    rows = [("A", day(2020, 1, 1), 1), ("A", day(2020, 1, 1), 2), ("A", day(2020, 2, 1), 1), ("A", None, 9), (None, None, 1), (None, day(2021, 1, 1), 1)]
    df = spark.createDataFrame(rows, "k string, d date, t int")
    got = {(r.k, r.d, r.t): r.n for r in dedupe.next_value_within_key(df, "k", "d", ["t"], out="n").collect()}
    assert got == {rows[0]: day(2020, 1, 1), rows[1]: day(2020, 2, 1), rows[2]: None, rows[3]: day(2020, 1, 1), rows[4]: day(2021, 1, 1), rows[5]: None}
    twice = dedupe.validity_end_dates(df.unionByName(df), "k", "d", "end", ["t"]).where("k = 'A' AND t = 2").collect()
    assert [r.end for r in twice] == [day(2020, 1, 31)] * 2


def test_keys_under_a_collation(spark):
    from lakestar.operators import star

    collation = "UTF8_LCASE_RTRIM"
    rows = spark.createDataFrame([("AW1 ", 1, "x"), ("aw1", 2, "y"), ("AW2", 1, "z"), (" aw2", 1, "w"), (None, 1, "n")], "k string, v int, p string")
    got = sorted((r.k or "", r.v) for r in dedupe.latest_per_key(rows, "k", "v", collation=collation).collect())
    assert got == [("", 1), (" aw2", 1), ("AW2", 1), ("aw1", 2)]
    assert quality.count_bad_keys(rows, "k", collations=[collation]).first()[0] == 2 and quality.count_bad_keys(rows, "k").first()[0] == 1
    look = spark.createDataFrame([("aw1  ",), ("AW2",)], "id string")
    assert quality.count_unmatched(rows, "k", look, "id", collation).first()[0] == 2
    assert quality.count_unmatched(rows, "k", look, "id").first()[0] == 4
    sales = spark.createDataFrame([("S1", "p1 ", 1), ("S2", "P1", 1), ("S3", "P3", 1)], "sls_ord_num string, sls_prd_key string, sls_cust_id int") \
        .selectExpr("*", *[f"CAST(NULL AS DATE) AS sls_{d}_dt" for d in ("order", "ship", "due")], *[f"1 AS sls_{m}" for m in ("sales", "quantity", "price")])
    products = spark.createDataFrame([("P1", 1)], "product_number string, product_key int")
    customers = spark.createDataFrame([(1, 1)], "customer_id int, customer_key int")
    keys_of = lambda c: sorted((r.order_number, r.product_key) for r in star.fact_sales(sales, products, customers, c).collect())
    assert keys_of(collation) == [("S1", 1), ("S2", 1), ("S3", None)] and keys_of(None) == [("S1", None), ("S2", 1), ("S3", None)]


def test_slices_follow_the_input_size(spark):
    from lakestar.session import input_bytes, slices_for

    small = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey")
    large = spark.read.parquet("/root/testdata/sf0.1/orders.parquet").select("o_orderkey")
    assert 0 < input_bytes(small) < input_bytes(large)
    unit = input_bytes(small)
    assert slices_for(large, unit) > slices_for(small, unit) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert slices_for(spark.createDataFrame([(1,)], "a int"), unit) == slices_for(small, unit)  # of unknown size


def test_share_of_a_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "g string, revenue bigint")
    assert [r.share_pct for r in kpi.revenue_share(df, "g").collect()] == [None, None]


def test_months_are_filled_for_each_key(spark):
    day = dt.date
    df = spark.createDataFrame([(1, day(2020, 1, 5), 10), (1, day(2020, 4, 1), 5), (2, day(2021, 2, 1), 7), (2, None, 9), (None, day(2020, 1, 1), 3)],
                               "k bigint, order_date date, sales_amount int")
    got = {(r.k, r.order_month.month): r.revenue for r in kpi.monthly_revenue_filled_by(df, "k").collect()}
    assert got == {(1, 1): 10, (1, 2): 0, (1, 3): 0, (1, 4): 5, (2, 2): 7}


def test_revenue_share_rounds_half_up(spark):
    b = spark.createDataFrame([("a", 1), ("b", 1), ("c", 6)], "g string, revenue bigint")
    got = {r.g: r.share_pct for r in kpi.revenue_share(b, "g").collect()}
    assert got == {"a": 12.5, "b": 12.5, "c": 75.0}
    b = spark.createDataFrame([("a", 1), ("b", 2)], "g string, revenue bigint")
    got = {r.g: r.share_pct for r in kpi.revenue_share(b, "g").collect()}
    assert got == {"a": 33.33, "b": 66.67}


def test_monthly_revenue_filled_closes_gaps(spark):
    fact = spark.createDataFrame(
        [(dt.date(2013, 1, 5), 10), (dt.date(2013, 1, 9), 5), (dt.date(2013, 4, 1), 7), (None, 100)],
        "order_date date, sales_amount int")
    got = [(r.order_month, r.revenue) for r in kpi.monthly_revenue_filled(fact).collect()]
    assert got == [(dt.date(2013, 1, 1), 15), (dt.date(2013, 2, 1), 0), (dt.date(2013, 3, 1), 0),
                   (dt.date(2013, 4, 1), 7)]


def test_quality_gate(spark):
    ok = spark.createDataFrame([("c1", "error", 0), ("w1", "warning", 5)], "check_name string, severity string, failed_rows bigint")
    quality.quality_gate({"silver": ok})
    bad = spark.createDataFrame([("c2", "error", 1)], "check_name string, severity string, failed_rows bigint")
    with pytest.raises(quality.QualityError, match="c2"):
        quality.quality_gate({"silver": ok, "gold": bad})


def test_means_of_group_sums_matches_single_form(spark):
    df = spark.range(2000).select((F.col("id") % 37).alias("a"),
                                  F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 53).alias("b"),
                                  (F.col("id") % 7).alias("m"))
    both = kpi.means_of_group_sums(df, {"ma": "a", "mb": "b"}, "m").first()
    def single(group):
        return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.sum("m").alias("s")).agg(F.avg("s")).first()[0]

    assert both.ma == pytest.approx(single("a"), rel=1e-12)
    assert both.mb == pytest.approx(single("b"), rel=1e-12)


def test_checks_under_server_collation(spark):
    """Binary comparison by default; with a case- and trailing-space-
    insensitive collation, 'AW1 ' has no whitespace problem and 'single',
    'N/A' are in their domains / sentinels."""
    cust = spark.createDataFrame(
        [(1, "AW1 ", "single", "N/A"), (2, " AW2", "Married", "Male"), (3, "AW3", "Single", "Female")],
        "cst_id int, cst_key string, cst_marital_status string, cst_gndr string")
    names = {"crm_customer_key_whitespace", "crm_customer_invalid_marital_status", "crm_customer_unknown_gender"}

    def counts(collation):
        checks = [c for c in quality.conformed_checks("2026-01-01", collation) if c.name in names]
        return {r.check_name: r.failed_rows for r in quality.run_checks(checks, {"crm_cust_info": cust}).collect()}

    assert counts(None) == {"crm_customer_key_whitespace": 2, "crm_customer_invalid_marital_status": 1,
                            "crm_customer_unknown_gender": 0}
    assert counts("UTF8_LCASE_RTRIM") == {"crm_customer_key_whitespace": 1,
                                          "crm_customer_invalid_marital_status": 0,
                                          "crm_customer_unknown_gender": 1}

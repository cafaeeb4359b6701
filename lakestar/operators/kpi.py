"""Business queries over the star schema: KPIs, breakdowns, trends, audit.

All measures are summed as ``bigint`` (integer inputs never overflow the
sum). Breakdowns aggregate partially before their shuffle, so a hot group
(one country with a third of the sales) costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .distinct import distinct_keys, key_bitmaps
from .keys import dense_key


def revenue() -> Column:
    """``SUM(CAST(sales_amount AS BIGINT))``."""
    return F.sum(F.col("sales_amount").cast("bigint"))


def row_counts(objects: dict[str, DataFrame]) -> DataFrame:
    """``(object_name, row_count)``, one row per named frame (``UNION ALL``)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("object_name"), "row_count")
             for name, df in objects.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sales_rollups(fact: DataFrame) -> dict[str, DataFrame]:
    """The distinct customers of each month with their revenue, and its distinct orders, as bitmaps that merge (see :mod:`.distinct`): what
    :func:`summary` and :func:`monthly_revenue` are rolled up from. Rows without a date are a month of their own (null)."""
    month = C.month_start("order_date").alias("order_month")
    return {
        "customers_by_month": key_bitmaps(fact.select(month, "customer_key", "sales_amount"), ["order_month"], "customer_key", {"revenue": "sales_amount"}),
        "orders_by_month": key_bitmaps(fact.select(month, "order_number"), ["order_month"], "order_number"),
    }


def summary_of(rollups: dict[str, DataFrame]) -> DataFrame:
    """Total revenue, distinct orders and customers, average order value, from :func:`sales_rollups`; the fact is not read."""
    counted = {name: distinct_keys(rollups[table], [], name).select(F.coalesce(name, F.lit(0)).alias(name))
               for table, name in (("orders_by_month", "distinct_orders"), ("customers_by_month", "distinct_customers"))}
    total = rollups["customers_by_month"].agg(F.sum("revenue").cast("bigint").alias("total_revenue"))
    row = total.select("total_revenue", *[frame.scalar().alias(name) for name, frame in counted.items()])
    average = F.col("total_revenue").cast("decimal(29,2)") / F.nullif(F.col("distinct_orders"), F.lit(0))
    return row.withColumn("average_order_value", average.cast("decimal(19,2)"))


def summary(fact: DataFrame) -> DataFrame:
    return summary_of(sales_rollups(fact))


def monthly_revenue_of(rollups: dict[str, DataFrame]) -> DataFrame:
    """Revenue, orders and active customers per calendar month (sparse), from :func:`sales_rollups`."""
    customers, orders = (rollups[t].where(F.col("order_month").isNotNull()) for t in ("customers_by_month", "orders_by_month"))
    active = F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits"))), F.lit(0))
    sums = customers.groupBy("order_month").agg(F.sum("revenue").cast("bigint").alias("revenue"), active.alias("active_customers"))
    counts = distinct_keys(orders, ["order_month"], "orders", merged=False)
    return (sums.join(counts, "order_month", "left")
            .select("order_month", "revenue", F.coalesce("orders", F.lit(0)).alias("orders"), "active_customers").orderBy("order_month"))


def monthly_revenue(fact: DataFrame) -> DataFrame:
    return monthly_revenue_of(sales_rollups(fact.where(F.col("order_date").isNotNull())))


def yearly_activity(rollups: dict[str, DataFrame]) -> DataFrame:
    """Revenue, distinct orders and active customers of each year (null: of rows without a date), rolled up from the months' bitmaps."""
    year = F.year("order_month").alias("order_year")
    customers, orders = (rollups[t].withColumn("order_year", year) for t in ("customers_by_month", "orders_by_month"))
    out = customers.groupBy("order_year").agg(F.sum("revenue").cast("bigint").alias("revenue"))
    for counted, name in ((distinct_keys(orders, ["order_year"], "orders"), "orders"), (distinct_keys(customers, ["order_year"], "active_customers"), "active_customers")):
        counted = counted.withColumnRenamed("order_year", "_year")
        out = out.join(counted, F.col("order_year").eqNullSafe(F.col("_year")), "left").drop("_year").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def revenue_by(fact: DataFrame, dim: DataFrame, key: str, attribute: str, extra: dict | None = None) -> DataFrame:
    """Inner fact-dimension join on the surrogate key, grouped by one
    dimension attribute; highest revenue first.

    The fact is first reduced to a row per surrogate key (with a partial
    aggregate before the shuffle), so whichever join Spark picks by the
    dimension's bytes sees distinct keys instead of fact rows, and neither a hot key nor a hot
    attribute value (a third of the sales) lands in one task as rows.
    """
    aggs = {"revenue": revenue()}
    aggs.update(extra or {})
    per_key = fact.where(F.col(key).isNotNull()).groupBy(key).agg(*[expr.alias(name) for name, expr in aggs.items()])
    joined = per_key.join(dim.select(key, attribute), key, "inner")
    out = joined.groupBy(attribute).agg(*[F.sum(name).cast("bigint").alias(name) for name in aggs])
    return out.orderBy(F.desc("revenue"), F.asc(attribute))


def revenue_by_country(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return revenue_by(fact, customers, "customer_key", "country")


def revenue_by_product_line(fact: DataFrame, products: DataFrame) -> DataFrame:
    return revenue_by(fact, products, "product_key", "product_line")


def category_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    return revenue_by(fact, products, "product_key", "category",
                      extra={"units": F.sum(F.col("quantity").cast("bigint"))})


def revenue_share(breakdown: DataFrame, attribute: str) -> DataFrame:
    """Add ``share_pct`` = revenue / total x 100, rounded half-up to 2 dp.

    The share of a zero total is null. The rounding is done exactly, in integer basis points, so no binary
    floating-point tie can flip a digit. The total is a scalar subquery (a
    global aggregate of partial sums, one value), so no task ever holds all
    groups, however many there are, and no join is needed.
    """
    total = breakdown.select(F.sum("revenue")).scalar()
    wide = F.col("revenue").cast("decimal(38,0)")
    basis_points = C.int_div(wide * 20000 + total, F.nullif(total, F.lit(0)) * 2)
    return breakdown.select(attribute, "revenue", (basis_points.cast("double") / 100).alias("share_pct")) \
        .orderBy(F.desc("revenue"), F.asc(attribute))


def order_date_range(fact: DataFrame) -> DataFrame:
    return fact.agg(F.min("order_date").alias("first_order_date"),
                    F.max("order_date").alias("last_order_date"))


def monthly_revenue_filled(fact: DataFrame) -> DataFrame:
    """Monthly revenue from the first to the last month with revenue, months
    without sales filled with 0 (a calendar spine joined to the sparse sums).

    The spine has one row per month of the date range, independent of the
    number of sales rows.
    """
    sparse = (fact.where(F.col("order_date").isNotNull())
              .groupBy(C.month_start("order_date").alias("order_month"))
              .agg(revenue().alias("revenue")))
    bounds = sparse.agg(F.min("order_month").alias("lo"), F.max("order_month").alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("order_month"))
    return (spine.join(sparse, "order_month", "left")
            .select("order_month", F.coalesce("revenue", F.lit(0)).cast("bigint").alias("revenue"))
            .orderBy("order_month"))


def monthly_revenue_filled_by(fact: DataFrame, key: str) -> DataFrame:
    """Monthly revenue of each ``key`` from its own first to its own last month with revenue, the months between filled with 0.
    A key's months are a row for each month of its range, however many sales it has."""
    sparse = (fact.where(F.col("order_date").isNotNull() & F.col(key).isNotNull())
              .groupBy(key, C.month_start("order_date").alias("order_month"))
              .agg(revenue().alias("revenue")))
    bounds = sparse.groupBy(key).agg(F.min("order_month").alias("lo"), F.max("order_month").alias("hi"))
    spine = bounds.select(key, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("order_month"))
    return (spine.join(sparse, [key, "order_month"], "left")
            .select(key, "order_month", F.coalesce("revenue", F.lit(0)).cast("bigint").alias("revenue")))


def with_position(report: DataFrame, order_by: list[Column | str]) -> DataFrame:
    """A report with each row's place (from 1) in the total order ``order_by``."""
    return dense_key(report, order_by, "position").select(*report.columns, "position")


def means_of_group_sums(df: DataFrame, groups: dict[str, str], measure: str) -> DataFrame:
    """Averages over groups of the groups' sums, for several group columns in one pass: ``GROUPING SETS`` over
    the columns computes every per-group sum with one scan and one
    shuffle; ``groups`` maps output name -> group column. Null group keys
    are excluded."""
    cols = list(groups.values())
    sums = df.groupingSets([[c] for c in cols], *cols).agg(
        F.sum(measure).alias("_s"), F.grouping_id().alias("_g"))
    out = []
    for i, (name, col) in enumerate(groups.items()):
        # grouping_id has one bit per column (first column = highest bit),
        # set when the column is aggregated away: the set [col] clears it.
        gid = (1 << len(cols)) - 1 - (1 << (len(cols) - 1 - i))
        mine = (F.col("_g") == gid) & F.col(col).isNotNull()
        out.append(F.avg(F.when(mine, F.col("_s").cast("double"))).alias(name))
    return sums.agg(*out)

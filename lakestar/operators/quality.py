"""Data-quality checks, severity-graded reports and a fail gate.

A check is data: a name, a severity, the table it reads and how it counts.

* ``rows``   -- rows matching a predicate. All row checks on one table fold
  into a single ``agg(count_if(...), ...)`` pass over that table, or are observed while it is written.
* ``keys``   -- key values that are null or occur more than once (counts
  offending *keys*, not rows): a partial aggregate per key.
* ``unmatched`` -- rows whose key has no partner in a lookup (anti join).
* ``orphans`` -- fact rows whose surrogate keys miss either dimension,
  counted exactly as two left joins would (including fan-out), weighing rows
  by dimension key copies. The row checks of the fact are counted in the same pass.

A report is ``(check_name, severity, failed_rows)``, errors first.
"""

from __future__ import annotations

import datetime as _dt
import itertools
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

ERROR, WARNING = "error", "warning"


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    table: str
    kind: str = "rows"
    predicate: Callable[[], Column] | None = None
    key: str | None = None
    lookup: str | None = None
    lookup_key: str | None = None
    dims: tuple = field(default_factory=tuple)
    collation: str | None = None


def rows(name, severity, table, predicate) -> Check:
    return Check(name, severity, table, "rows", predicate=predicate)


def keys(name, severity, table, key, collation=None) -> Check:
    """``collation``: string keys that are equal under it are one key."""
    return Check(name, severity, table, "keys", key=key, collation=collation)


def unmatched(name, severity, table, key, lookup, lookup_key, collation=None) -> Check:
    return Check(name, severity, table, "unmatched", key=key, lookup=lookup, lookup_key=lookup_key, collation=collation)


def orphans(name, severity, table, dims: Sequence[tuple[str, str]]) -> Check:
    """``dims``: (dimension table, surrogate key column shared with the fact)."""
    return Check(name, severity, table, "orphans", dims=tuple(dims))


# ---- the conformed-layer and star-layer check lists (fixed values: names, severities, domains) ---------------------------------------
def conformed_checks(as_of: _dt.date | str, collation: str | None = None) -> list[Check]:
    """The 17 conformed-layer checks; ``collation`` applies to their string
    comparisons (keys, lookups, trim difference, domains, sentinels). ``UTF8_LCASE_RTRIM`` mimics a server whose default collation ignores case
    and trailing spaces (SURVEY N3): ``'AW1 ' = 'AW1'`` and ``'n/A' = 'n/a'``; leading spaces still count."""
    as_of_col = lambda: F.lit(str(as_of)).cast("date")
    t = lambda name: C.collated(name, collation)
    return [
        keys("crm_customer_key_null_or_duplicate", ERROR, "crm_cust_info", "cst_id"),
        rows("crm_customer_key_whitespace", ERROR, "crm_cust_info",
             lambda: F.col("cst_key").isNull() | (t("cst_key") != F.trim("cst_key"))),
        rows("crm_customer_invalid_marital_status", ERROR, "crm_cust_info",
             lambda: C.outside_domain(t("cst_marital_status"), ["Single", "Married", C.UNKNOWN])),
        rows("crm_customer_unknown_gender", WARNING, "crm_cust_info", lambda: C.unknown_or_null(t("cst_gndr"))),
        keys("crm_product_key_null_or_duplicate", ERROR, "crm_prd_info", "prd_id"),
        unmatched("crm_product_unmatched_category", ERROR, "crm_prd_info", "cat_id", "erp_px_cat_g1v2", "id", collation),
        rows("crm_product_invalid_cost", ERROR, "crm_prd_info",
             lambda: F.col("prd_cost").isNull() | (F.col("prd_cost") < 0)),
        rows("crm_product_invalid_line", ERROR, "crm_prd_info",
             lambda: C.outside_domain(t("prd_line"), ["Mountain", "Road", "Other Sales", "Touring", C.UNKNOWN])),
        rows("crm_product_invalid_date_range", ERROR, "crm_prd_info",
             lambda: F.col("prd_end_dt") < F.col("prd_start_dt")),
        rows("crm_sales_missing_order_date", WARNING, "crm_sales_details", lambda: F.col("sls_order_dt").isNull()),
        rows("crm_sales_invalid_date_sequence", ERROR, "crm_sales_details",
             lambda: C.dates_out_of_order("sls_order_dt", "sls_ship_dt", "sls_due_dt")),
        rows("crm_sales_invalid_measure", ERROR, "crm_sales_details",
             lambda: C.invalid_measure("sls_sales", "sls_quantity", "sls_price")),
        rows("erp_customer_implausible_birthdate", WARNING, "erp_cust_az12",
             lambda: (F.col("bdate") < F.add_months(as_of_col(), -110 * 12)) | (F.col("bdate") > as_of_col())),
        rows("erp_customer_unknown_gender", WARNING, "erp_cust_az12", lambda: C.unknown_or_null(t("gen"))),
        rows("erp_location_unknown_country", WARNING, "erp_loc_a101", lambda: C.unknown_or_null(t("cntry"))),
        keys("erp_category_key_null_or_duplicate", ERROR, "erp_px_cat_g1v2", "id", collation),
        rows("erp_category_invalid_maintenance_value", ERROR, "erp_px_cat_g1v2",
             lambda: C.outside_domain(t("maintenance"), ["Yes", "No"])),
    ]


def star_checks(collation: str | None = None) -> list[Check]:
    """The 12 star-schema checks; ``collation`` as in :func:`conformed_checks`."""
    t = lambda name: C.collated(name, collation)
    return [
        keys("dim_customer_surrogate_key_null_or_duplicate", ERROR, "dim_customers", "customer_key"),
        keys("dim_customer_natural_key_null_or_duplicate", ERROR, "dim_customers", "customer_id"),
        rows("dim_customer_unknown_gender", WARNING, "dim_customers", lambda: C.unknown_or_null(t("gender"))),
        rows("dim_customer_unknown_country", WARNING, "dim_customers", lambda: C.unknown_or_null(t("country"))),
        keys("dim_product_surrogate_key_null_or_duplicate", ERROR, "dim_products", "product_key"),
        keys("dim_product_natural_key_null_or_duplicate", ERROR, "dim_products", "product_number", collation),
        rows("dim_product_missing_category_enrichment", ERROR, "dim_products",
             lambda: C.any_null("category", "subcategory", "maintenance")),
        rows("fact_sales_missing_dimension_key", ERROR, "fact_sales",
             lambda: C.any_null("customer_key", "product_key")),
        orphans("fact_sales_orphan_dimension_key", ERROR, "fact_sales",
                [("dim_customers", "customer_key"), ("dim_products", "product_key")]),
        rows("fact_sales_missing_order_date", WARNING, "fact_sales", lambda: F.col("order_date").isNull()),
        rows("fact_sales_invalid_date_sequence", ERROR, "fact_sales",
             lambda: C.dates_out_of_order("order_date", "shipping_date", "due_date")),
        rows("fact_sales_invalid_measure", ERROR, "fact_sales",
             lambda: C.invalid_measure("sales_amount", "quantity", "price")),
    ]


# ---- counting ---------------------------------------------------------------------------
def count_bad_keys(df: DataFrame, *keys_: str, collations: Sequence[str | None] = ()) -> DataFrame:
    """One row: for each of ``keys_`` the number of its values that are null or repeated. One scan: grouping sets. ``collations``: of each key, None for a
    binary comparison."""
    df = df.select([C.collated(k, c).alias(k) for k, c in itertools.zip_longest(keys_, collations)])
    if len(keys_) == 1:
        per_key = df.groupBy(keys_[0]).agg(F.count(F.lit(1)).alias("_n")).withColumn("_g", F.lit(0))
    else:
        per_key = df.groupingSets([[k] for k in keys_], *keys_).agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_g"))
    full = (1 << len(keys_)) - 1
    counts = []
    for i, k in enumerate(keys_):
        own = F.col("_g") == (0 if len(keys_) == 1 else full ^ (1 << (len(keys_) - 1 - i)))
        counts.append(F.count_if(own & (F.col(k).isNull() | (F.col("_n") > 1))).alias(k))
    return per_key.agg(*counts)


def count_unmatched(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, collation: str | None = None) -> DataFrame:
    ids = lookup.select(C.collated(lookup_key, collation).alias("_id")).distinct()
    return df.join(ids, C.collated(df[key], collation) == ids["_id"], "left_anti").agg(F.count(F.lit(1)).alias("failed"))


def count_orphans(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], extra: Sequence[Column] = ()) -> DataFrame:
    """``failed``: rows of ``fact LEFT JOIN d1 ... LEFT JOIN dn`` where some dimension
    key found no match (a fan-out from duplicated dimension keys counts as
    the joins would emit it), without materialising the joined rows: each
    dimension is reduced to ``key -> copies``, unique by key, so each fact row stays one row.
    ``extra``: further aggregates of the fact's rows, counted in the same pass.
    """
    rows_, missing, weight = fact, F.lit(False), F.lit(1).cast("bigint")
    for i, (dim, k) in enumerate(dims):
        copies = dim.where(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias(f"_c{i}"))
        rows_ = rows_.join(copies, k, "left")
        missing = missing | F.col(f"_c{i}").isNull()
        weight = weight * F.coalesce(F.col(f"_c{i}"), F.lit(1))
    return rows_.agg(F.coalesce(F.sum(F.when(missing, weight)), F.lit(0)).alias("failed"), *extra)


def row_counts_of(checks: Iterable[Check], table: str) -> list[Column]:
    """The aggregates that count the row checks of a table, each named like its check: to be observed while the table is written."""
    return [F.count_if(c.predicate()).alias(c.name) for c in checks if c.table == table and c.kind == "rows"]


def run_checks(checks: Iterable[Check], tables: dict[str, DataFrame], known: Mapping[str, int] | None = None) -> DataFrame:
    """Evaluate ``checks`` against ``tables``; one row per check. A table is read once for its row (and orphan) checks and
    once for its key checks. ``known``: row checks that were counted when their table was written, by name; they read nothing."""
    checks = list(checks)
    counted = [c for c in checks if c.kind == "rows" and c.name in (known or {})]
    checks = [c for c in checks if c not in counted]
    of = lambda table, kind: [c for c in checks if c.table == table and c.kind == kind]
    parts: list[DataFrame] = []

    def add(wide: DataFrame, counted: dict[str, Check]) -> None:
        """``counted``: the check of each column of the one-row ``wide``."""
        named = wide.select(*[F.col(f"`{c}`").cast("bigint").alias(chk.name) for c, chk in counted.items()])
        names = [chk.name for chk in counted.values()]
        long = named.unpivot([], names, "check_name", "failed_rows")
        severity = C.map_values("check_name", {chk.name: chk.severity for chk in counted.values()})
        parts.append(long.select("check_name", severity.alias("severity"), "failed_rows"))

    if counted:
        spark = tables[counted[0].table].sparkSession
        rows_ = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"),
                                   F.lit(known[c.name]).cast("bigint").alias("failed_rows")) for c in counted])
        parts.append(spark.range(0, 1, 1, 1).select(F.inline(rows_)))
    for table in dict.fromkeys(c.table for c in checks):
        df, rows_, orphans_ = tables[table], of(table, "rows"), of(table, "orphans")
        counts = [F.count_if(c.predicate()).alias(c.name) for c in rows_]
        if orphans_:
            wide = count_orphans(df, [(tables[d], k) for d, k in orphans_[0].dims], counts)
            add(wide, {"failed": orphans_[0]} | {c.name: c for c in rows_})
        elif rows_:
            add(df.agg(*counts), {c.name: c for c in rows_})
        for chk in orphans_[1:]:
            add(count_orphans(df, [(tables[d], k) for d, k in chk.dims]), {"failed": chk})
        if of(table, "keys"):
            counted = {c.key: c for c in of(table, "keys")}
            add(count_bad_keys(df, *counted, collations=[c.collation for c in counted.values()]), counted)
        for chk in of(table, "unmatched"):
            add(count_unmatched(df, chk.key, tables[chk.lookup], chk.lookup_key, chk.collation), {"failed": chk})
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report


def report_order() -> list[Column | str]:
    """Errors before warnings, then by name."""
    return [F.when(F.col("severity") == F.lit(ERROR), 1).otherwise(2), "check_name"]


def ordered(report: DataFrame) -> DataFrame:
    return report.orderBy(*report_order())


def quality_report(checks: Iterable[Check], tables: dict[str, DataFrame], known: Mapping[str, int] | None = None) -> DataFrame:
    return ordered(run_checks(checks, tables, known))


def tag_layers(reports: dict[str, DataFrame]) -> DataFrame:
    """Concatenate layer reports with a ``layer`` column."""
    tagged = [r.withColumn("layer", F.lit(layer)) for layer, r in reports.items()]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    return out


def failing_errors(reports: dict[str, DataFrame]) -> DataFrame:
    return tag_layers(reports).where((F.col("severity") == F.lit(ERROR)) & (F.col("failed_rows") > 0))


class QualityError(AssertionError):
    pass


def quality_gate(reports: dict[str, DataFrame]) -> None:
    """Raise :class:`QualityError` if any error-severity check failed.

    A report has one row per check (29 at most here), so collecting the
    failures is bounded.
    """
    failures = failing_errors(reports).collect()
    if failures:
        lines = "\n".join(f"  [{r.layer}] {r.check_name}: {r.failed_rows}" for r in failures)
        raise QualityError(f"warehouse quality errors:\n{lines}")

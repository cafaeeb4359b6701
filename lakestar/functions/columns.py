"""Column rules: ``Column -> Column`` building blocks of the cleaning layer.

All rules are built-in Spark expressions, so they stay inside whole-stage
codegen and null handling follows SQL three-valued logic: a ``when`` whose
condition is unknown falls through to ``otherwise``, exactly like ``CASE``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "n/a"

# Code maps of the conformed layer (key is the trimmed,
# upper-cased source code).
MARITAL_STATUS = {"S": "Single", "M": "Married"}
CUSTOMER_GENDER = {"F": "Female", "M": "Male"}
ERP_GENDER = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}
# CRM spells Components / Pedals as CO_PE, the ERP lookup as CO_PD.
CATEGORY_KEY_FIXES = {"CO_PE": "CO_PD"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collated(c: Column | str, collation: str | None) -> Column:
    """A string column compared under ``collation`` (as it is when None): ``UTF8_LCASE_RTRIM`` ignores case and trailing spaces, like a server's
    default collation. Equality, grouping and joins of such columns are by collation key."""
    return F.collate(_col(c), collation) if collation else _col(c)


def map_values(c: Column | str, mapping: Mapping[str, str], default: Column | str | None = UNKNOWN) -> Column:
    """``CASE c WHEN k THEN v ... ELSE default END`` over a literal mapping."""
    c = _col(c)
    out = None
    for key, value in mapping.items():
        cond = c == F.lit(key)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if out is None else out.otherwise(fallback)


def standardize_code(c: Column | str, mapping: Mapping[str, str], default: str | None = UNKNOWN) -> Column:
    """Trim + upper-case a source code, then look it up; unmatched -> ``default``."""
    return map_values(F.upper(F.trim(_col(c))), mapping, default)


def standardize_country(c: Column | str) -> Column:
    """Trimmed country; known codes decoded; blank or missing -> ``n/a``."""
    raw = _col(c)
    country = F.trim(raw)
    decoded = map_values(country, COUNTRY, default=None)
    return (F.when(decoded.isNotNull(), decoded)
            .when((country == F.lit("")) | raw.isNull(), F.lit(UNKNOWN))
            .otherwise(country))


def trim_all(cols: Iterable[str]) -> list[Column]:
    return [F.trim(F.col(c)).alias(c) for c in cols]


def strip_prefix(c: Column | str, prefix: str) -> Column:
    """Drop a leading ``prefix`` when present (``LIKE 'NAS%'`` + substring)."""
    c = _col(c)
    return F.when(c.startswith(prefix), c.substr(F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def remove_chars(c: Column | str, chars: str) -> Column:
    """Remove every occurrence of each character in ``chars``."""
    return F.translate(_col(c), chars, "")


def category_id(prd_key: Column | str, fixes: Mapping[str, str] | None = None) -> Column:
    """First five characters of the compound product key, ``-`` -> ``_``,
    then known cross-system spellings harmonised (``fixes``; None = raw)."""
    raw = F.translate(F.substring(_col(prd_key), 1, 5), "-", "_")
    if not fixes:
        return raw
    return map_values(raw, fixes, default=raw)


def product_number(prd_key: Column | str) -> Column:
    """The product part of the compound key: characters 7 onwards."""
    c = _col(prd_key)
    return c.substr(F.lit(7), F.length(c))


def parse_int_date(c: Column | str, strict: bool = False) -> Column:
    """``yyyymmdd`` integer -> DATE; 0, wrong length or non-dates -> null.

    Integer arithmetic instead of a text formatter (about 4x cheaper per
    value): an 8-digit positive integer lies in [10000101, 99991231]; year,
    month and day are split off and checked against the calendar before
    ``make_date`` runs, so ANSI mode never sees an invalid date (``CASE``
    branches are evaluated lazily). Same results as parsing the text with
    pattern ``yyyyMMdd`` leniently.

    ``strict=True`` keeps 0 and wrong lengths as null but makes an 8-digit
    value that is not a calendar date (``20139999``) fail the job, like the
    reference's SQL load; it relies on ANSI mode (Spark's default).
    """
    c = _col(c)
    if strict:
        text = c.cast("string")
        return F.when((c == 0) | (F.length(text) != 8), F.lit(None).cast("date")).otherwise(
            F.to_date(text, "yyyyMMdd"))
    y = int_div(c, F.lit(10000)).cast("int")
    m = (int_div(c, F.lit(100)) % 100).cast("int")
    d = (c % 100).cast("int")
    plausible = c.between(10000101, 99991231) & m.between(1, 12) & (d >= 1)
    month_end = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
    return F.when(plausible, F.when(d <= month_end, F.make_date(y, m, d)))


def truncating_div(a: Column | str, b: Column | str) -> Column:
    """Integer division truncating toward zero, as an ``int``; null when
    ``b`` is 0 or null (``a / NULLIF(b, 0)`` on integers)."""
    return int_div(a, F.nullif(_col(b), F.lit(0))).cast("int")


def int_div(a: Column | str, b: Column | str) -> Column:
    """SQL ``a div b``: integral division truncating toward zero (bigint);
    null when ``b`` is 0 or null."""
    return F.call_function("div", _col(a), _col(b))


def amount_needs_repair(amount: Column | str, qty: Column | str, price: Column | str) -> Column:
    amount, qty, price = _col(amount), _col(qty), _col(price)
    return amount.isNull() | (amount <= 0) | (amount != qty * F.abs(price))


def price_needs_repair(price: Column | str) -> Column:
    price = _col(price)
    return price.isNull() | (price <= 0)


def repair_amount(amount: Column | str, qty: Column | str, price: Column | str) -> Column:
    """Missing, non-positive or inconsistent amount -> quantity x |price|.

    Reads the *raw* price (never a repaired one). With a null price the
    consistency test is unknown, so a positive amount is kept.
    """
    amount, qty, price = _col(amount), _col(qty), _col(price)
    return F.when(amount_needs_repair(amount, qty, price), qty * F.abs(price)).otherwise(amount)


def repair_price(price: Column | str, amount: Column | str, qty: Column | str) -> Column:
    """Missing or non-positive price -> *raw* amount div quantity (null if 0)."""
    price, amount, qty = _col(price), _col(amount), _col(qty)
    return F.when(price_needs_repair(price), truncating_div(amount, qty)).otherwise(price)


def unknown_or_null(c: Column | str, sentinel: str = UNKNOWN) -> Column:
    c = _col(c)
    return (c == F.lit(sentinel)) | c.isNull()


def outside_domain(c: Column | str, allowed: Iterable[str]) -> Column:
    c = _col(c)
    return ~c.isin(list(allowed)) | c.isNull()


def any_null(*cols: Column | str) -> Column:
    out = None
    for c in cols:
        out = _col(c).isNull() if out is None else out | _col(c).isNull()
    return out


def dates_out_of_order(first: Column | str, second: Column | str, third: Column | str) -> Column:
    """``a > b OR a > c OR b > c``; comparisons with null never fail."""
    a, b, c = _col(first), _col(second), _col(third)
    return (a > b) | (a > c) | (b > c)


def invalid_measure(amount: Column | str, qty: Column | str, price: Column | str) -> Column:
    amount, qty, price = _col(amount), _col(qty), _col(price)
    return (any_null(amount, qty, price) | (amount <= 0) | (qty <= 0) | (price <= 0)
            | (amount != qty * price))


def month_start(d: Column | str) -> Column:
    """First day of the month of a date (``DATEFROMPARTS(y, m, 1)``)."""
    d = _col(d)
    return F.make_date(F.year(d), F.month(d), F.lit(1))


def format_g12(x: Column | str) -> Column:
    """Python-style ``format(x, '.12g')`` for doubles in the usual range:
    Java's ``%.12g`` keeps trailing zeros, which Python's drops."""
    s = F.format_string("%.12g", _col(x).cast("double"))
    plain = F.regexp_replace(F.regexp_replace(s, "0+$", ""), r"\.$", "")
    scientific = F.regexp_replace(s, r"\.?0+e", "e")
    return F.when(s.contains("e"), scientific).when(s.contains("."), plain).otherwise(s)

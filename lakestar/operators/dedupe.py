"""Version-selection operators: latest row per key and validity end dates.

``latest_per_key`` is an aggregate, not a window: the maximum of a struct
is partially aggregated on the map side, so a key that holds a third of all
rows is reduced to one row per input partition *before* the shuffle, and no
task ever holds a whole group.

``validity_end_dates`` needs the next start within a key (``LEAD``). A plain window would place a hot key in one task, and range slices of
all rows need a written copy. Instead there are two levels: an index of the distinct starts of each key (with the greatest tie-breaker of each), reduced before its
shuffle, and the rows, which look up their own entry. Within equal starts the next value is the start itself, but for the last row, which
takes the index's next start. Only the index is windowed: a key with a third of all rows has a row there for each distinct start (a
calendar's days, for dates), and the join's large partitions are split by AQE. No copy of the rows is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str],
                   tie_breakers: Sequence[str] | None = None, drop_null_keys: bool = False, collation: str | None = None) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order_by`` values. ``collation``: string keys that are equal under it are one key; the
    row that is kept keeps its own spelling (of rows equal in all else the greatest).

    Ordering is descending with nulls last (a null date never beats a real
    one). Ties are broken by ``tie_breakers`` (descending, nulls last), by
    default every remaining column, which makes the pick deterministic.
    The result keeps ``df``'s columns and order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys and c not in order]
    if drop_null_keys:
        for k in keys:
            df = df.where(F.col(k).isNotNull())
    # Struct comparison is field by field with null smallest, so max() of
    # (order..., ties..., rest...) is "ORDER BY ... DESC NULLS LAST" top-1, and carries each column once.
    ranked = order + [c for c in tie_breakers if c not in order]
    rest = [c for c in df.columns if c not in keys and c not in ranked]
    if collation:
        texts = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
        by = [(C.collated(k, collation) if k in texts else F.col(k)).alias(f"_key{i}") for i, k in enumerate(keys)]
        picked = df.groupBy(*by).agg(F.max(F.struct(*[F.col(c) for c in ranked + rest + [k for k in keys if k not in ranked]])).alias("_row"))
        return picked.select(*[F.col(f"_row.{c}").alias(c) for c in df.columns])
    picked = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in ranked + rest])).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def next_value_within_key(df: DataFrame, key: str, order_col: str, tie_breakers: Sequence[str] = (),
                          out: str = "_next", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = ``LEAD(order_col) OVER (PARTITION BY key ORDER BY
    order_col, tie_breakers)`` without ever putting one key's rows in one task.

    Nulls sort first (SQL ascending order); null keys form one group, as in
    a SQL window. Rows that are equal in all of these are one version: each of them takes what the last of them would. ``partitions`` of the
    index, by default the session's.
    """
    ties = F.struct(*[F.col(t) for t in tie_breakers]) if tie_breakers else F.lit(True)
    starts = df.groupBy(F.col(key).alias("_key"), F.col(order_col).alias("_start")).agg(F.max(ties).alias("_last"))
    if partitions:
        starts = starts.repartition(partitions, "_key")
    following = Window.partitionBy("_key").orderBy(F.col("_start").asc_nulls_first())
    index = starts.withColumn("_following", F.lead("_start").over(following))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(order_col).eqNullSafe(F.col("_start"))
    value = F.when(ties.eqNullSafe(F.col("_last")), F.col("_following")).otherwise(F.col(order_col))
    return df.join(index, same, "left").select(*df.columns, value.alias(out))


def validity_end_dates(df: DataFrame, key: str, start: str, end: str = "end_date",
                       tie_breakers: Sequence[str] = ()) -> DataFrame:
    """``end`` = day before the next version's ``start`` within ``key``;
    the latest version stays open (null)."""
    with_next = next_value_within_key(df, key, start, tie_breakers, out="_next_start")
    return with_next.withColumn(end, F.date_sub(F.col("_next_start"), 1)).drop("_next_start")

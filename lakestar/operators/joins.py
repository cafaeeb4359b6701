"""Join helpers: cardinality-checked joins and semi counts.

No join here carries a broadcast hint. Spark broadcasts a side whose size in bytes is below
``spark.sql.autoBroadcastJoinThreshold`` (file sizes at planning, shuffle statistics at run time); any other join is
a sort-merge join, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

class CardinalityError(ValueError):
    """A join side that must be unique on its key is not."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (null keys excluded)."""
    nonnull = df
    for k in keys:
        nonnull = nonnull.where(F.col(k).isNotNull())
    return nonnull.groupBy(*keys).count().where(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], side: str = "right") -> None:
    """Raise :class:`CardinalityError` when ``keys`` repeat in ``df``.

    Distributed: a partial aggregate per key, and only the first offending
    key ever reaches the driver.
    """
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise CardinalityError(f"{side} side is not unique on {list(keys)}: e.g. {dup[0].asDict()}")


def _once(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """``df`` as it is, with a check in its plan: the job fails with the key when ``keys`` repeat. Rows are grouped by the keys, which is how a join
    on them shuffles them anyway; rows with a null key match nothing, so each is a group of its own."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    copies, row, tag = (f"_{side}_{x}" for x in ("copies", "row", "tag"))
    grouped = df.withColumn(tag, F.when(null, F.monotonically_increasing_id())).groupBy(*keys, tag).agg(
        F.count(F.lit(1)).alias(copies), F.first(F.struct(*[F.col(c) for c in df.columns if c not in keys] or [F.lit(0).alias("_")])).alias(row))
    name = F.concat_ws(", ", *[F.concat(F.lit(f"{k} = "), F.col(k).cast("string")) for k in keys])
    message = F.concat(F.lit(f"{side} side is not unique on {list(keys)}: "), name)
    sound = grouped.where(F.when(F.col(copies) > 1, F.raise_error(message).cast("boolean")).otherwise(True))
    return sound.select(*[F.col(c) if c in keys else F.col(f"{row}.{c}").alias(c) for c in df.columns])


def checked_join(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                 how: str = "left", validate: str = "many_to_one") -> DataFrame:
    """Equi-join that verifies the declared cardinality as it runs.

    ``validate``: ``one_to_one`` (both sides unique), ``many_to_one`` (right
    unique), ``one_to_many`` (left unique) or ``many_to_many`` (no check). Each side is read once and nothing runs before the join does; a
    repeated key, also one without a partner, fails the job with an error that names it. Keys of the result are the left side's and the right side's columns, so their
    names must differ.
    """
    if validate in ("one_to_one", "many_to_one"):
        right = _once(right, right_on, "right")
    if validate in ("one_to_one", "one_to_many"):
        left = _once(left, left_on, "left")
    cond: Column | None = None
    for lk, rk in zip(left_on, right_on):
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)


def semi_count(df: DataFrame, lookup: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """One-row frame: rows of ``df`` whose key occurs in ``lookup``."""
    keys = lookup.select(F.col(right_on).alias("_k")).distinct()
    matched = df.join(keys, df[left_on] == keys["_k"], "left_semi")
    return matched.agg(F.count(F.lit(1)).alias("matches"))

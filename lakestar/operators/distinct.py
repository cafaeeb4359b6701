"""Exact distinct counts as bitmaps that merge.

A key is a place in a key space: an integer is itself in the one space ``''``; a text that ends in a number (``SO1042``) is that number in
the space of what stands before it, if writing the number again gives the same text; any other text is a space of its own, at place -1. The distinct
keys of a group are bitmaps of 32,768 places each, in the buckets where it has keys. Counts of groups are sums of bits, and groups roll up by ``bitmap_or_agg``:
months to years or to all time, without the rows.

Building takes two shuffles, neither of rows: distinct (group, key) pairs, reduced before theirs, so a key with a third of all rows moves as a
row for each task; then these pairs by (group, bucket), where each bitmap is made whole in one task of at most 32,768 pairs a bitmap. Rows are not multiplied by the number of
distinct counts (no ``Expand``), as several distinct counts in one aggregate would.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = ("key_space", "bucket")


def place(df: DataFrame, key: str) -> tuple[Column, Column]:
    """Key space and number of a key column; null for a null key."""
    c = F.col(key)
    if df.select(key).schema[0].dataType.typeName() != "string":
        return F.when(c.isNotNull(), ""), c.cast("bigint")
    head = F.rtrim(c, F.lit("0123456789"))
    number = F.substr(c, F.length(head) + 1).try_cast("bigint")
    canonical = F.coalesce(F.concat(head, number.cast("string")) == c, F.lit(False))
    return F.when(canonical, head).otherwise(c), F.when(canonical, number).when(c.isNotNull(), -1)


def key_bitmaps(df: DataFrame, groups: Sequence[str], key: str, measures: Mapping[str, str] | None = None) -> DataFrame:
    """``groups``, key_space, bucket, bits and the sums of ``measures`` (name -> bigint column): the distinct keys of each group. Rows without a
    key have a row of their own (bucket null) that only carries sums."""
    space, number = place(df, key)
    sums = [F.sum(F.col(c).cast("bigint")).alias(name) for name, c in (measures or {}).items()]
    placed = df.select(*groups, space.alias("key_space"), F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"),
                       *(measures or {}).values())
    keys = [*groups, *BUCKET]
    pairs = placed.groupBy(*keys, "bit").agg(*sums) if sums else placed.select(*keys, "bit").distinct()
    return pairs.repartition(*[F.col(k) for k in keys]).groupBy(*keys).agg(
        F.bitmap_construct_agg("bit").alias("bits"), *[F.sum(name).alias(name) for name in measures or {}])


def distinct_keys(bitmaps: DataFrame, by: Sequence[str], name: str, merged: bool = True) -> DataFrame:
    """``by`` and ``name``: the number of distinct keys of each group, from ``key_bitmaps``. ``merged=False`` where ``by`` are all the
    groups that the bitmaps were built for, so that there is nothing to merge."""
    known = bitmaps.where(F.col("bucket").isNotNull())
    if merged:
        known = known.groupBy(*by, *BUCKET).agg(F.bitmap_or_agg("bits").alias("bits"))
    return known.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))

"""Dense surrogate keys: ``ROW_NUMBER() OVER (ORDER BY ...)`` at scale.

A window without ``PARTITION BY`` sorts the whole table in one task. The
distributed form below gives the same numbers:

1. range-partition by the (total) order and sort within each partition;
2. record each row's partition id and its position inside the partition
   (``monotonically_increasing_id`` is ``partition_id << 33 | position``);
3. cut lineage by writing the rows with their (partition, position) to a
   parquet table in the shared folder, so retries after an executor loss see
   the same positions;
4. count rows per partition -- one row per partition, far fewer than rows -- and turn the counts into start offsets with a running sum;
5. key = offset of the partition + position + 1, via a broadcast of that
   per-partition table.

The order must be total (add a unique tie-breaker); otherwise neither this nor
the SQL window is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import slices_for, write_and_read


def _order_cols(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def dense_key(df: DataFrame, order_by: Sequence[Column | str], key: str = "surrogate_key",
              partitions: int | None = None) -> DataFrame:
    """Add ``key`` (bigint, 1..n) numbering rows in ``order_by`` order. The number of partitions follows the input's size."""
    n = partitions or slices_for(df)
    order = _order_cols(order_by)
    ranged = (df.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33)))
    ranged = write_and_read(ranged, "dense-key")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # Running sum over at most `n` rows (one per partition).
    offsets = counts.withColumn(
        "_offset",
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
    ).select("_pid", F.coalesce("_offset", F.lit(0)).alias("_offset"))
    keyed = ranged.join(F.broadcast(offsets), "_pid", "inner")
    out = keyed.withColumn(key, (F.col("_offset") + F.col("_pos") + 1).cast("bigint"))
    return out.select(key, *df.columns)

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import io
import math
import os
import threading
import zipfile
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir, scratch_dir, scratch_scope

#: Session setting that drops a query's shuffle files as soon as the query has ended.
FREE_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the application's Python workers, wherever the driver was started: its modules go to
    the executors as one small archive in the shared folder, by Spark's own file distribution."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = io.BytesIO()
    with zipfile.ZipFile(found, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    archive.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
    path = f"{new_run_dir(spark, 'llm-package')}/lakestar_llm.zip"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(found.getvalue()))
    out.close()
    atexit.register(_remove, spark, os.path.dirname(path))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(spark.sparkContext.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, name: str) -> str:
    """``name``, underscored until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``df`` with the columns ``new`` at its end; columns of ``df`` with one of these names give way."""
    taken = {c.lower() for c in new}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[v.alias(k) for k, v in new.items()])


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the JVM may be gone already when the application ends
        pass


_FREEING = threading.Lock()
_FREE: dict[str, list] = {}


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of queries that end in this block are dropped as they end. The setting is the session's, so the first of several
    threads sets it and the last one puts back what was there."""
    key = spark.sparkContext.applicationId
    with _FREEING:
        if key not in _FREE:
            _FREE[key] = [0, spark.conf.get(FREE_SHUFFLE, None)]
            spark.conf.set(FREE_SHUFFLE, "true")
        _FREE[key][0] += 1
    try:
        yield
    finally:
        with _FREEING:
            _FREE[key][0] -= 1
            if not _FREE[key][0]:
                before = _FREE.pop(key)[1]
                spark.conf.unset(FREE_SHUFFLE) if before is None else spark.conf.set(FREE_SHUFFLE, before)


def written(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Cut lineage: ``df`` is written once as Parquet under the shared folder (or to ``path``) and read back.

    A lost executor's tasks then start from these files. The shuffle files of the
    writing query are dropped when it ends; the table goes with the enclosing ``scratch_scope``, else when the application ends.
    Read back, its size is known, so Spark's own broadcast threshold holds against real bytes."""
    spark = df.sparkSession
    path = path or scratch_dir(spark, f"llm-{purpose}")
    with freed_shuffles(spark):
        df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def alone(spark: SparkSession, purpose: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written; all tables that it has written on the way are removed."""
    path = scratch_dir(spark, f"llm-{purpose}")
    with scratch_scope(spark):
        return written(make(), purpose, path)


def words(text: Column) -> Column:
    """Words of a text: lower-cased runs of letters and digits; a null text has none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")


def shingles(words_: Column, k: int) -> Column:
    """64-bit hashes of all runs of ``k`` words, in order, with repeats; none when there are fewer words.
    ``words_`` must be a plain column: an expression would be evaluated again for every shingle."""
    grams = F.transform(F.sequence(F.lit(0), F.size(words_) - k),
                        lambda i: F.xxhash64(*[F.get(words_, i + j) for j in range(k)]))
    return F.when(F.size(words_) >= k, grams).otherwise(F.array().cast("array<bigint>"))


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


#: Range of the hashes by which samples are drawn.
HASHES = 1 << 40


def sample_hash(col: Column) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(HASHES))


def sample_bound(wanted: int, distinct: int) -> int:
    """Hashes below it belong to about four times the ``wanted`` of so many distinct values, so what is sorted and sent for a sample is bounded too."""
    return math.ceil(HASHES * min(1.0, 4 * wanted / max(1, distinct)))


def hash_sample(df: DataFrame, col: str, wanted: int) -> list:
    """The ``wanted`` distinct values of ``col`` with the smallest hashes (all, if there are fewer): a sample for the driver.
    Copies don't count for the bound, so they leave no fewer values."""
    h = sample_hash(F.col(col))
    values = df.select(col).where(F.col(col).isNotNull())
    low = values.where(h < sample_bound(wanted, values.select(h.alias("h")).distinct().count())).distinct()
    return [r[0] for r in low.orderBy(h, col).limit(wanted).collect()]

"""Line dedup: remove lines that stand on many sites (distinct-site spread).

A line is what stands between line feeds, trimmed of spaces. Each line hash gets a HyperLogLog sketch of its sites,
merged by aggregation (partial on the map side, so a line that is everywhere moves as one sketch for each task). Lines whose
estimate is clear of the threshold are decided by it; the others, in a band of BAND_SIGMA standard errors,
get an exact count of distinct sites. Lines on ``min_sites`` sites or more are boilerplate and leave every document.

Defined results: blank lines are never boilerplate; a null site counts as none; a null text has no lines and stays null; a text
whose lines all go becomes empty; rows of one id are treated alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spare, with_columns, written

LOG_REGISTERS = 10
BAND_SIGMA = 5


def line_hashes(text):
    """Hash of each line of a text, null for a blank one."""
    return F.transform(F.split(text, "\n", -1), lambda x: F.when(F.trim(x) != "", F.xxhash64(F.trim(x))))


def boilerplate_lines(docs: DataFrame, min_sites: int, site_col: str, text_col: str) -> DataFrame:
    """h: hashes of the lines that stand on ``min_sites`` sites or more."""
    lines = docs.select(F.col(site_col).cast("string").alias("site"),
                        F.explode(F.array_distinct(line_hashes(F.col(text_col)))).alias("h")).where("h is not null")
    sketches = lines.groupBy("h").agg(F.hll_sketch_agg("site", LOG_REGISTERS).alias("sketch"))
    spread = sketches.select("h", F.hll_sketch_estimate("sketch").alias("sites"))
    band = max(1.0, BAND_SIGMA * 1.04 / math.sqrt(2 ** LOG_REGISTERS) * min_sites)
    spread = written(spread.where(F.col("sites") >= min_sites - band), "line-spread")
    near = spread.where(F.col("sites") < min_sites + band).select("h")
    exact = lines.join(near, "h", "left_semi").groupBy("h").agg(F.count_distinct("site").alias("sites"))
    sure = spread.where(F.col("sites") >= min_sites + band).select("h")
    return written(sure.unionByName(exact.where(F.col("sites") >= min_sites).select("h")), "line-boilerplate")


def drop_boilerplate(docs: DataFrame, min_sites: int = 10, id_col: str = "doc_id", site_col: str = "source",
                     text_col: str = "text") -> DataFrame:
    """``docs`` without boilerplate lines, with ``n_lines`` and ``n_removed`` (of the text as it was)."""
    bad = boilerplate_lines(docs, min_sites, site_col, text_col)
    lines = docs.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(line_hashes(F.col(text_col)))).alias("h"))
    key, drop, row = (spare(docs, x) for x in ("line_id", "line_drop", "line_keep"))
    hits = lines.join(bad, "h").groupBy("id").agg(F.collect_set("h").alias("h")).select(F.col("id").alias(key), F.col("h").alias(drop))
    joined = docs.join(hits, F.col(id_col).eqNullSafe(F.col(key)), "left")
    kept = F.filter(F.split(F.col(text_col), "\n", -1),
                    lambda x: ~F.coalesce(F.array_contains(F.col(drop), F.xxhash64(F.trim(x))) & (F.trim(x) != ""), F.lit(False)))
    total = F.coalesce(F.size(F.split(F.col(text_col), "\n", -1)), F.lit(0))
    total = F.when(F.col(text_col).isNull(), 0).otherwise(total).cast("bigint")
    out = joined.withColumn(row, kept)
    left = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(row)).cast("bigint")
    out = with_columns(out, {"n_lines": total, "n_removed": total - left})
    return out.withColumn(text_col, F.array_join(row, "\n")).drop(key, drop, row)

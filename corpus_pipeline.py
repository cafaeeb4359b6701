"""The corpus pipeline: documents through five stages, each written as Parquet and read by the next.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. Null texts leave with
the first stage, as they have no language; any table may be empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestar.llm import decontam, lang_id, mixing, near_dup, sharding
from lakestar.llm.common import alone, table

SHARDS = 24


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly; the model learns from the labels of these documents."""
    told = lang_id.identify(docs, lang_id.fit(docs))
    return told.where("not rejected").select(*[f"`{c}`" for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates (five-word shingles, a similarity of 0.8 or more)."""
    return near_dup.keep_one_of_each(docs, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated so that each source has the same share of the bytes; in a random order."""
    return mixing.mix_sources(docs).select(*[f"`{c}`" for c in docs.columns])


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return sharding.assign_shards(docs, SHARDS).drop("size", "text_crc32", "law", "grown_shard")


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontaminate_stage),
    ("mixing", mix_stage),
    ("sharding", shard_stage),
]

#: SQL has neither zstandard nor a minimax cut; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over the documents; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = alone(spark, f"pipeline-{name}", lambda: stage(spark, docs, sf_dir))  # noqa: B023  called at once
    return STAGES[-1][1](spark, docs, sf_dir)

"""CSV sources and sinks of the raw layer.

* :func:`read_csv` -- header skipped, ``,`` separator, the declared schema
  (never inferred); ``FAILFAST`` by default, ``PERMISSIVE`` with a corrupt-
  record column as an option. Empty fields are null.
* :func:`read_csv_with_null_tokens` -- as above, but null tokens (``NA``, ``null``, ...) and empty text
  are also null (the audit's reading of the same files).
* :func:`split_load` -- a load that tolerates a stated number of bad rows and keeps them apart.
* :func:`ingest` -- full refresh of every raw table from its file: read with
  the declared schema, write parquet to a fresh folder, never the one read.
* :func:`write_metrics_csv` -- the two-column metrics file.

Files are split by Spark across tasks; nothing is read on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW
from ..session import write_and_read


def read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST",
             corrupt_column: str | None = None, quote: str | None = None) -> DataFrame:
    """Typed CSV scan. ``quote=""`` turns quote handling off (a ``"`` is then
    data, as in a plain bulk load); ``None`` keeps Spark's ``"`` quoting,
    which round-trips :func:`write_csv` output."""
    reader = (spark.read.option("header", True).option("sep", ",").option("mode", mode)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if quote is not None:
        reader = reader.option("quote", quote)
    if corrupt_column:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


#: Texts that dataframe libraries read as null by default.
NULL_TOKENS = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null")


def read_csv_with_null_tokens(spark: SparkSession, path: str, schema: T.StructType,
                              tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Columns of every type: read as text, null the tokens and empty text, then cast (a value that is
    neither a token nor of its type is an error, as under ``FAILFAST``)."""
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    df = read_csv(spark, path, text)
    nulled = lambda c: F.when(c.isin(list(tokens)) | (c == F.lit("")), F.lit(None)).otherwise(c)
    return df.select([nulled(F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


class RejectError(ValueError):
    """More bad rows than a load tolerates."""


#: Name of the column with a bad row's text.
REJECTED = "_rejected"


def split_load(spark: SparkSession, path: str, schema: T.StructType, target: str, max_rejects: int = 10, quote: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Load a CSV into ``target/rows``, and its bad rows (too many or too few fields, or a value that isn't of its type) into ``target/rejects`` with
    the line's text and file: (rows, rejects). The file is parsed once. More than ``max_rejects`` bad rows fail the load with
    :class:`RejectError`, which lists the first ones; no table is left then."""
    parsed = read_csv(spark, path, schema, "PERMISSIVE", REJECTED, quote).withColumn("source_file", F.input_file_name())
    split = write_and_read(parsed, "split-load")
    bad = split.where(F.col(REJECTED).isNotNull())
    found = bad.count()
    if found > max_rejects:
        first = [r[0] for r in bad.select(REJECTED).orderBy("source_file", REJECTED).limit(3).collect()]
        raise RejectError(f"{path}: {found} bad rows, {max_rejects} are tolerated; e.g. {first}")
    out = []
    for name, frame in (("rows", split.where(F.col(REJECTED).isNull()).select(*schema.fieldNames())),
                        ("rejects", bad.select(F.col(REJECTED).alias("line"), "source_file"))):
        frame.write.mode("errorifexists").parquet(f"{target}/{name}")
        out.append(spark.read.schema(frame.schema).parquet(f"{target}/{name}"))
    return out[0], out[1]


# The source file of each raw table, relative to the datasets
# folder of the extracts.
SOURCE_FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}


def read_sources(spark: SparkSession, datasets_dir: str, files: Mapping[str, str] = SOURCE_FILES,
                 mode: str = "FAILFAST", quote: str | None = None) -> dict[str, DataFrame]:
    """The six source extracts as typed raw frames (lazy; Spark splits each
    file across tasks). A path may also be a folder of CSV part files."""
    root = datasets_dir.rstrip("/")
    return {table: read_csv(spark, f"{root}/{rel}", RAW[table], mode, quote=quote) for table, rel in files.items()}


def write_csv(df: DataFrame, path: str, null_token: str = "") -> None:
    """Header + ``,``; text written verbatim (no whitespace trimming), nulls as ``null_token``."""
    (df.write.mode("errorifexists").option("header", True).option("nullValue", null_token)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_lines(lines: DataFrame, header: str, path: str) -> None:
    """CSV lines as they are (one text column), under ``header`` in each file: one column whose name is the header, with a separator that
    leaves commas alone."""
    (lines.toDF(header).write.mode("errorifexists").option("header", True).option("sep", "\x01").option("quote", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def ingest(spark: SparkSession, sources: Mapping[str, str], out_dir: str,
           schemas: Mapping[str, T.StructType] = RAW, max_rejects: int | None = None, quote: str | None = None) -> dict[str, DataFrame]:
    """Full-refresh raw load: each (table -> CSV path) into ``out_dir/table``.

    ``out_dir`` must be a fresh folder; the returned frames read the new
    parquet, so later layers never see a half-replaced table. ``max_rejects``: bad rows that each file may have (see :func:`split_load`); they
    are in ``out_dir/table/rejects`` then (:func:`rejects_of`). None: the first bad row fails the load.
    """
    loaded = {}
    for table, path in sources.items():
        if max_rejects is not None:
            loaded[table], _ = split_load(spark, path, schemas[table], f"{out_dir.rstrip('/')}/{table}", max_rejects, quote)
            continue
        target = f"{out_dir.rstrip('/')}/{table}"
        read_csv(spark, path, schemas[table], quote=quote).write.mode("errorifexists").parquet(target)
        loaded[table] = spark.read.parquet(target)
    return loaded


def rejects_of(spark: SparkSession, out_dir: str, tables: Iterable[str]) -> DataFrame:
    """``(table_name, line, source_file)``: the bad rows that :func:`ingest` has tolerated."""
    parts = [spark.read.schema("line string, source_file string").parquet(f"{out_dir.rstrip('/')}/{t}/rejects")
             .select(F.lit(t).alias("table_name"), "line", "source_file") for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """The metrics file as ``(metric, value)`` text."""
    return read_csv(spark, path, T.StructType([T.StructField(c, T.StringType(), True) for c in ("metric", "value")]))


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    """``(metric, value)`` as one small CSV file with a header.

    The metrics frame has a fixed, small number of rows, so one output
    partition is safe.
    """
    metrics.select("metric", "value").coalesce(1).write.mode("errorifexists").option("header", True).csv(path)

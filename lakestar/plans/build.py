"""Build the warehouse: raw -> conformed -> star, materialised per run.

Each build writes every layer under a fresh run folder in the shared root
(``spark.checkpoint.dir``) and only then publishes the run by appending a
small pointer. Readers open the published run, so a failed or half-written
build is never visible, and no job ever overwrites a path it reads.
Materialising also cuts lineage: a lost executor re-reads parquet instead of
recomputing every upstream layer, and surrogate keys are computed once per
snapshot so the fact and the dimensions agree. The raw layer is written too
(the full-refresh load of the source extracts), so the audit and the raw-data
checks read typed tables instead of re-deriving the extracts.

Each run keeps a manifest in its folder: what it is built from (source files with lengths and times, reference date, collation), and a note for each
table that has been written in full. :meth:`Warehouse.resume` goes on with the newest run of the same inputs, in any process, and
writes only what is missing. :func:`retire` removes runs that are superseded or were never published, after a grace period.

Tables that do not depend on each other are written by concurrent Spark jobs
(one driver thread per table); each table starts as soon as its own inputs
are written.
"""

from __future__ import annotations

import atexit
import datetime as _dt
import threading
import time
import uuid
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import month_start
from ..operators import conform, kpi, quality, star
from ..schemas import LOAD_STAMP, RAW
from ..session import _remove_at_exit, entries, read_note, remove, scratch_scope, shared_root, write_note
from ..sources import csv_io, extracts

DEFAULT_AS_OF = _dt.date(2026, 1, 1)

CONFORMED_RULES = {
    "crm_cust_info": lambda raw, as_of: conform.clean_customers(raw),
    "crm_prd_info": lambda raw, as_of: conform.clean_products(raw),
    "crm_sales_details": lambda raw, as_of: conform.clean_sales(raw),
    "erp_cust_az12": lambda raw, as_of: conform.clean_demographics(raw, as_of),
    "erp_loc_a101": lambda raw, as_of: conform.clean_locations(raw),
    "erp_px_cat_g1v2": lambda raw, as_of: conform.clean_categories(raw),
}
STAR_TABLES = ("dim_customers", "dim_products", "fact_sales")

ROLLUPS = ("customers_by_month", "orders_by_month")
RUN_NOTE, MANIFEST = "_run.json", "_manifest"
#: Raised whenever a rule or the layout of a layer table changes, so that no run of other code is gone on with.
FORMAT = 1

#: Of the sales tables' files, as sales are written three times (raw, conformed, star) on their way to a report. Tables that joins look up
#: keep the session's codec: Spark broadcasts by file size, and zstd would let tables of more rows through.
COMPRESSION = dict.fromkeys(("crm_sales_details", "fact_sales", "sales_by_month"), "zstd")

#: The driver tables that the extracts read.
SOURCE_TABLES = ("customer", "nation", "orders", "lineitem", "part")
#: Property of the catalog tables that this library has made.
OWNED = "lakestar.layer"


class Warehouse:
    """One snapshot of the three layers, built lazily table by table.

    ``extract(name)`` is the lazy source extract; ``raw(name)``,
    ``conformed(name)`` and ``star(name)`` are written to the run folder on
    first use and read back from there afterwards.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: _dt.date = DEFAULT_AS_OF,
                 run_dir: str | None = None, raw_frames: dict[str, DataFrame] | None = None, collation: str | None = None,
                 tolerant: dict | None = None):
        """``collation``: string keys of dimensions and facts are joined under it (binary when None). ``tolerant``: how to load CSV files
        with bad rows (see :meth:`from_csv`)."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.collation = collation
        self._tolerant = tolerant
        self.base = f"{shared_root(spark)}/lakestar/warehouse"
        self.run_dir = run_dir or f"{self.base}/runs/{uuid.uuid4().hex}"
        self._raw_frames = raw_frames or {}
        self._tables: dict[tuple[str, str], DataFrame] = {}
        self._paths: dict[tuple[str, str], str] = {}
        self._stop = threading.Event()
        self._lock = threading.Lock()
        self._begun = run_dir is not None
        self.published = False
        self._table_locks: dict[tuple[str, str], threading.Lock] = {}
        self._counts: dict[str, int] = {}

    @classmethod
    def from_csv(cls, spark: SparkSession, datasets_dir: str, as_of: _dt.date = DEFAULT_AS_OF,
                 mode: str = "FAILFAST", quote: str = "", max_rejects: int | None = None, **kwargs) -> "Warehouse":
        """A warehouse whose raw layer is loaded from the six CSV source
        extracts (``source_crm/*.csv``, ``source_erp/*.csv``) instead of being
        derived from the driver tables. Unquoted, as in a plain bulk load; ``quote='"'`` reads quoted files. ``max_rejects``: bad rows that each file may
        have; they are kept apart (:meth:`rejects`). None: the first bad row fails the load."""
        frames = csv_io.read_sources(spark, datasets_dir, mode=mode, quote=quote)
        tolerant = None if max_rejects is None else {"max_rejects": max_rejects, "quote": quote}
        return cls(spark, datasets_dir, as_of=as_of, raw_frames=frames, tolerant=tolerant, **kwargs)

    @classmethod
    def resume(cls, spark: SparkSession, sf_dir: str, as_of: _dt.date = DEFAULT_AS_OF, make=None, **kwargs) -> "Warehouse":
        """The newest run of the same inputs (source files, reference date, options) that isn't published yet, with the tables that it
        has written; else a new run. ``make``: :meth:`from_csv` for a run from CSV files. Tables are written in full or not noted, and the same inputs
        give the same tables, so it does no harm when the run's first process is still at work."""
        fresh = (make or cls)(spark, sf_dir, as_of=as_of, **kwargs)
        published = {p["run_dir"] for p in _pointers(spark, fresh.base)}
        found = []
        for path, _, _ in entries(spark, f"{fresh.base}/runs"):
            note = read_note(spark, f"{path}/{RUN_NOTE}")
            if note and note["inputs"] == fresh.inputs() and note["run_dir"] not in published:
                found.append((note["begun"], note["run_dir"]))
        if found:
            fresh.run_dir, fresh._begun = max(found)[1], True
            fresh._load_manifest()
        return fresh

    def inputs(self) -> dict:
        """What this run is built from; runs with equal inputs have equal tables."""
        if self._raw_frames:
            files = [f"{self.sf_dir.rstrip('/')}/{f}" for f in csv_io.SOURCE_FILES.values()]
        else:
            files = [f"{self.sf_dir.rstrip('/')}/{name}.parquet" for name in SOURCE_TABLES]
        return {"sources": [[f, _status(self.spark, f)] for f in files], "as_of": str(self.as_of), "collation": self.collation, "tolerant": self._tolerant,
                "format": FORMAT}

    def _begin(self) -> None:
        """Note what the run is built from, before its first table."""
        with self._lock:
            if self._begun:
                return
            self._begun = True
        write_note(self.spark, f"{self.run_dir}/{RUN_NOTE}", {"run_dir": self.run_dir, "begun": time.time(), "inputs": self.inputs()})

    def _load_manifest(self) -> None:
        """Take over the tables that are noted as written."""
        for path, _, _ in entries(self.spark, f"{self.run_dir}/{MANIFEST}"):
            note = read_note(self.spark, path) if path.endswith(".json") else None
            if note:
                key = (note["layer"], note["name"])
                self._paths[key] = note["path"]
                self._counts |= note["counts"]
                self._tables[key] = self.spark.read.schema(T.StructType.fromJson(note["schema"])).parquet(note["path"])

    # -- layers ---------------------------------------------------------------
    def extract(self, name: str) -> DataFrame:
        """The lazy source extract (not materialised)."""
        if name in self._raw_frames:
            return self._raw_frames[name]
        return extracts.EXTRACTS[name](self.spark, self.sf_dir)

    def raw(self, name: str) -> DataFrame:
        """The raw layer table: the extract as loaded into this run."""
        if self._tolerant is None:
            return self._materialise("raw", name, lambda: self.extract(name))
        source = f"{self.sf_dir.rstrip('/')}/{csv_io.SOURCE_FILES[name]}"
        return self._materialise("raw", name, lambda: None, lambda path: csv_io.split_load(
            self.spark, source, RAW[name], path, self._tolerant["max_rejects"], self._tolerant["quote"])[0])

    def rejects(self) -> DataFrame:
        """``(table_name, line, source_file)``: the bad rows of the CSV files that the raw layer was loaded without."""
        parts = []
        for name in CONFORMED_RULES:
            self.raw(name)
            folder = self.path("raw", name).removesuffix("/rows")
            parts.append(self.spark.read.schema("line string, source_file string").parquet(f"{folder}/rejects").select(F.lit(name).alias("table_name"), "*"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def conformed(self, name: str, stamped: bool = False) -> DataFrame:
        df = self._materialise("conformed", name,
                               lambda: CONFORMED_RULES[name](self.raw(name), self.as_of)
                               .withColumn(LOAD_STAMP, F.current_timestamp()))
        return df if stamped else df.drop(LOAD_STAMP)

    def star(self, name: str) -> DataFrame:
        builders = {
            "dim_customers": lambda: star.dim_customers(
                self.conformed("crm_cust_info"), self.conformed("erp_cust_az12"),
                self.conformed("erp_loc_a101"), self.collation),
            "dim_products": lambda: star.dim_products(
                self.conformed("crm_prd_info"), self.conformed("erp_px_cat_g1v2"), self.collation),
            "fact_sales": lambda: star.fact_sales(
                self.conformed("crm_sales_details"), self.star("dim_products"), self.star("dim_customers"), self.collation),
        }
        return self._materialise("star", name, builders[name])

    def row_counts(self) -> dict[str, int]:
        """Row checks (under this run's date and collation) of the tables written so far, as counted while they were written."""
        return dict(self._counts)

    def sales_by_month(self) -> DataFrame:
        """The sales fact with ``order_month``, partitioned by it (rows without a date have a partition of their own): a report on some months
        reads their files only. Large months are split over tasks and small ones put together (rebalance)."""
        month = month_start("order_date").alias("order_month")
        return self._materialise("rollup", "sales_by_month", lambda: self.star("fact_sales").select("*", month).hint("rebalance", "order_month"),
                                 partition_by=("order_month",))

    def rollup(self, name: str) -> DataFrame:
        """A table of :func:`kpi.sales_rollups`: reports read it instead of the fact."""
        return self._materialise("rollup", name, lambda: kpi.sales_rollups(self.star("fact_sales"))[name])

    def rollups(self) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(max_workers=len(ROLLUPS)) as pool:
            return dict(zip(ROLLUPS, pool.map(self.rollup, ROLLUPS)))

    def build(self, parallelism: int = 9) -> "Warehouse":
        """Materialise every table, each as soon as its own inputs exist.

        All targets are submitted at once; a table's builder asks for its
        inputs, which are guarded by per-table locks, so a dimension starts
        when its three (or two) conformed inputs are written, without
        waiting for the sales chain, and the fact waits only for what it
        reads. Locks are taken in dependency order (a DAG), so there is no
        deadlock. On the first error no further table is begun, running jobs of
        this build are cancelled, and that error is raised; a later call
        resumes with the tables that are missing.
        """
        targets = [lambda n=n: self.conformed(n) for n in CONFORMED_RULES]
        targets += [lambda n=n: self.star(n) for n in STAR_TABLES]
        self._stop.clear()
        context, tag = self.spark.sparkContext, f"lakestar-build-{uuid.uuid4().hex}"

        def tagged(target):
            context.addJobTag(tag)
            try:
                return target()
            finally:
                context.removeJobTag(tag)

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            futures = [pool.submit(tagged, target) for target in targets]
            done, _ = wait(futures, return_when=FIRST_EXCEPTION)
            failed = next((f for f in done if f.exception()), None)
            if failed:
                self._stop.set()
                for future in futures:
                    future.cancel()
                context.cancelJobsWithTag(tag)
        self._stop.clear()
        if failed:
            raise failed.exception()
        return self

    def register_catalog(self, layers: dict[str, str] | None = None) -> list[str]:
        """Expose this run in the session catalog as ``bronze.*``,
        ``silver.*`` and ``gold.*`` (the reference's layer namespaces), so
        ``spark.sql("SELECT ... FROM gold.fact_sales")`` works.

        Namespaces live under the shared root; tables are external parquet
        tables over the run's files, marked with the property OWNED. A table of
        that name without the mark is someone else's and is an error; one with it is
        pointed at this run's files in one step, so readers never miss it.
        Conformed tables keep their load stamp. Returns the table names.
        """
        layers = layers or {"bronze": "raw", "silver": "conformed", "gold": "star"}
        names = {"raw": list(CONFORMED_RULES), "conformed": list(CONFORMED_RULES), "star": list(STAR_TABLES)}
        registered = [f"{ns}.{name}" for ns, layer in layers.items() for name in names[layer]]
        owner_key = (self.spark.sparkContext.applicationId, tuple(sorted(layers.items())))
        with _CATALOG_LOCK:
            if _CATALOG_OWNER.get(owner_key) == self.run_dir:
                return registered
        self.build()
        root = shared_root(self.spark)
        catalog = self.spark.catalog
        # Check every target first, change nothing on a conflict.
        exists = {table for table in registered if catalog.tableExists(table)}
        for table in exists:
            if not any(r.key == OWNED for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()):
                raise RuntimeError(f"{table} exists as a {catalog.getTable(table).tableType} table that this "
                                   "library has not made; not replacing it")
        for namespace, layer in layers.items():
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace} "
                           f"LOCATION '{root}/lakestar/catalog/{namespace}.db'")
            for name in names[layer]:
                table = f"{namespace}.{name}"
                if table in exists:
                    self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{self.path(layer, name)}'")
                    catalog.refreshTable(table)
                else:
                    self.spark.sql(f"CREATE TABLE {table} USING parquet "
                                   f"LOCATION '{self.path(layer, name)}' TBLPROPERTIES ('{OWNED}' = 'true')")
        with _CATALOG_LOCK:
            _CATALOG_OWNER[owner_key] = self.run_dir
        return registered

    def publish(self) -> str:
        """Publish this run (after :meth:`build` succeeded).

        Append-only: each publication is a new one-row parquet folder
        ``(published_at, run_dir, as_of, tables)`` under ``published/``, committed by Spark's
        output committer, so a reader sees either the previous publication or
        this one, never a missing or half-written pointer (an ``overwrite``
        would delete the old pointer first).
        """
        self.build()
        self.published = True
        pointer = f"{self.base}/published/{uuid.uuid4().hex}"
        tables = F.create_map(*[F.lit(x) for (layer, name), path in sorted(self._paths.items()) for x in (f"{layer}/{name}", path)])
        self.spark.range(1, numPartitions=1).select(
            F.current_timestamp().alias("published_at"), F.lit(self.run_dir).alias("run_dir"),
            F.lit(self.as_of).alias("as_of"), tables.alias("tables")) \
            .write.mode("errorifexists").parquet(pointer)
        return pointer

    # -- storage ----------------------------------------------------------------
    def path(self, layer: str, name: str) -> str:
        """Where a table that has been written lies."""
        return self._paths[layer, name]

    def _observed(self, layer: str, name: str, frame: DataFrame) -> tuple[DataFrame, Observation | None]:
        """``frame`` with the row checks of its table counted as it is written. The counts are those of the write's own tasks, one for each
        partition, so a task or an attempt that is repeated counts once."""
        checks = {"conformed": lambda: quality.conformed_checks(self.as_of, self.collation), "star": lambda: quality.star_checks(self.collation)}
        counts = quality.row_counts_of(checks[layer](), name) if layer in checks else []
        if not counts:
            return frame, None
        seen = Observation()
        return frame.observe(seen, *counts), seen

    def _materialise(self, layer: str, name: str, make, load=None, partition_by: tuple = ()) -> DataFrame:
        """Write ``make()`` once under ``layer/name`` and return the written
        table (``load``: writes the table itself under the path it is given, and returns it). One lock per table: different tables build concurrently, a
        second caller of the same table waits for the first write. Every
        attempt has a folder of its own and counts only once it is complete and noted in the manifest, so a
        failed write can be tried again, by another process too. Scratch tables go with the attempt."""
        key = (layer, name)
        with self._lock:
            if key in self._tables:
                return self._tables[key]
            table_lock = self._table_locks.setdefault(key, threading.Lock())
        with table_lock:
            if key not in self._tables:
                if self._stop.is_set():
                    raise RuntimeError(f"{layer}/{name} was not begun, as the build has failed")
                self._begin()
                path, counts = f"{self.run_dir}/{layer}/{name}/{uuid.uuid4().hex}", {}
                with scratch_scope(self.spark):
                    if load is not None:
                        df, path = load(path), f"{path}/rows"
                    else:
                        frame = make()
                        watched, seen = self._observed(layer, name, frame)
                        watched.write.mode("errorifexists").partitionBy(*partition_by).parquet(path, compression=COMPRESSION.get(name))
                        counts = {k: int(v) for k, v in seen.get.items()} if seen else {}
                        # The schema is known: no footer inference when reading back.
                        df = self.spark.read.schema(frame.schema).parquet(path)
                write_note(self.spark, f"{self.run_dir}/{MANIFEST}/{layer}.{name}.json",
                           {"layer": layer, "name": name, "path": path, "schema": df.schema.jsonValue(), "counts": counts})
                with self._lock:
                    self._counts |= counts
                    self._tables[key], self._paths[key] = df, path
            return self._tables[key]


POINTER = "published_at timestamp, run_dir string, as_of date, tables map<string, string>"


def _pointers(spark: SparkSession, base: str) -> list[dict]:
    """The publications, oldest first: published_at (seconds), run_dir, path; a row for each that is kept."""
    if not entries(spark, f"{base}/published"):
        return []
    rows = spark.read.schema(POINTER).parquet(f"{base}/published/*").select(
        F.unix_micros("published_at").alias("at"), "run_dir", F.col("_metadata.file_path").alias("file")).collect()
    return sorted(({"at": r["at"] / 1e6, "run_dir": r["run_dir"], "path": r["file"].rpartition("/")[0]} for r in rows), key=lambda p: (p["at"], p["run_dir"]))


def retire(spark: SparkSession, keep: int = 2, grace: _dt.timedelta = _dt.timedelta(days=1), root: str | None = None) -> list[str]:
    """Remove runs that no reader should still need, and their publications; returns their folders.

    Kept are the ``keep`` newest published runs, runs that left these less than ``grace`` ago (who opened one then can go on reading), runs that
    were never published but have written something within ``grace``, and the runs that this session's catalog and cache show."""
    base = f"{root or shared_root(spark)}/lakestar/warehouse"
    now, pointers = time.time(), _pointers(spark, base)
    order = list(dict.fromkeys(p["run_dir"] for p in reversed(pointers)))  # newest publication first
    first = {}
    for p in pointers:
        first.setdefault(p["run_dir"], p["at"])
    shown = set(_CATALOG_OWNER.values()) | {wh.run_dir for wh in _CACHE.values()} | set(order[:keep])
    gone = []
    for place, run in enumerate(order):
        # A run leaves the kept ones when the last of the ``keep`` newer ones is published.
        if run not in shown and now - max(first[newer] for newer in order[place - keep:place]) > grace.total_seconds():
            gone.append(run)
    for path, _, _ in entries(spark, f"{base}/runs"):
        run = f"{base}/runs/{path.rpartition('/')[2]}"
        if run not in first and run not in shown:
            touched = [t / 1000 for _, _, t in entries(spark, run) + entries(spark, f"{run}/{MANIFEST}")]
            if now - max(touched, default=0) > grace.total_seconds():
                gone.append(run)
    for run in gone:
        for p in pointers:
            if p["run_dir"] == run:
                remove(spark, p["path"])
        remove(spark, run)
    return gone


def open_published(spark: SparkSession, sf_dir: str = "", root: str | None = None) -> Warehouse:
    """The most recently published run, read-only."""
    base = f"{root or shared_root(spark)}/lakestar/warehouse"
    if not _status(spark, f"{base}/published"):
        raise FileNotFoundError(f"no published warehouse run under {base}")
    pointers = spark.read.schema(POINTER).parquet(f"{base}/published/*")
    latest = pointers.agg(F.max_by(F.struct("run_dir", "as_of", "tables"), F.struct("published_at", "run_dir")).alias("p")).first().p
    wh = Warehouse(spark, sf_dir, as_of=latest.as_of, run_dir=latest.run_dir)
    wh.base = base
    wh._load_manifest()  # for the counts; the publication says which tables
    for key, path in latest.tables.items():
        layer, name = key.split("/")
        wh._paths[layer, name] = path
        wh._tables[layer, name] = spark.read.parquet(path)
    return wh


def _status(spark: SparkSession, path: str) -> str:
    """Names, lengths and modification times of a table's files, in any store that Spark reads; empty if there is none."""
    return ";".join(f"{name.rpartition('/')[2]}:{length}:{changed}" for name, length, changed in entries(spark, path))


# Which run the session catalog's layer namespaces currently point at.
_CATALOG_OWNER: dict[tuple, str] = {}
_CATALOG_LOCK = threading.Lock()

_CACHE: dict[tuple, Warehouse] = {}
_CACHE_LOCK = threading.Lock()


def warehouse_for(spark: SparkSession, sf_dir: str, as_of: _dt.date = DEFAULT_AS_OF) -> Warehouse:
    """Shared per-application snapshot for ``sf_dir`` (built on demand), a new one when a source table has changed."""
    version = tuple(_status(spark, f"{sf_dir.rstrip('/')}/{name}.parquet") for name in SOURCE_TABLES)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), as_of, version)
    with _CACHE_LOCK:
        if key not in _CACHE:
            _CACHE[key] = Warehouse(spark, sf_dir, as_of)
            atexit.register(_forget, spark, _CACHE[key])
        return _CACHE[key]


def _forget(spark: SparkSession, wh: Warehouse) -> None:
    """A cached snapshot that was not published goes with the application."""
    if not wh.published:
        _remove_at_exit(spark, wh.run_dir)

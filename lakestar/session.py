"""Spark session and shared-storage helpers.

Everything that must outlive a task (materialised layers, lineage cuts) goes to
the folder the cluster names in ``spark.checkpoint.dir``. Only when that is
unset *and* Spark runs in local mode (tests, laptops) do we pick a private
folder ourselves; on a cluster an unset value is an error, because a
machine-local temporary folder is not visible to other executors.
"""

from __future__ import annotations

import atexit
import contextlib
import json
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakestar",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the local benchmark (one JVM, ``cores`` threads);
    ``conf`` adds or overrides settings."""
    builder = SparkSession.builder
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


_ROOT_LOCK = threading.Lock()
_SCOPE = threading.local()

#: Bytes of input files that one range slice should hold.
SLICE_BYTES = 128 << 20
#: Slices of one range shuffle at most: its blocks number map tasks times slices, and Spark samples a million rows at most for the bounds. Larger
#: slices are sorted with spilling.
MAX_SLICES = 2048


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, by Spark's statistics of its sources."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 62)  # a source of unknown size counts as the greatest number there is


def slices_for(df: DataFrame, slice_bytes: int = SLICE_BYTES) -> int:
    """Range partitions for ``df``: a slice for each ``slice_bytes`` of its input, MAX_SLICES at most, the session's shuffle partitions at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MAX_SLICES, -(-input_bytes(df) // slice_bytes)))


def store(spark: SparkSession, path: str) -> tuple:
    """Spark's own file system client for ``path``, and the path as it takes it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    files, target = store(spark, path)
    files.delete(target, True)


def entries(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time in ms) of a file, or of what lies in a folder; empty if there is none."""
    files, target = store(spark, path)
    if not files.exists(target):
        return []
    return sorted((x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in files.listStatus(target))


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """A small JSON file in the shared store, under its name only once it is complete; one that is there already gives way."""
    files, target = store(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(json.dumps(note).encode()))
    out.close()
    files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"{path} can't be written")


def read_note(spark: SparkSession, path: str) -> dict | None:
    """A note's content; None if there is none."""
    files, target = store(spark, path)
    if not files.exists(target):
        return None
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    stream = files.open(target)
    try:
        return json.loads(text.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the JVM may be gone by then
        pass


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Tables that :func:`write_and_read` writes in this block (and thread) go when it ends."""
    outer, _SCOPE.paths = getattr(_SCOPE, "paths", None), []
    try:
        yield
    finally:
        paths, _SCOPE.paths = _SCOPE.paths, outer
        for path in paths:
            remove(spark, path)


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Order: ``spark.checkpoint.dir`` from the session conf, then the
    SparkContext's checkpoint dir; if both are unset and the master is local,
    a fresh temporary folder (registered as the checkpoint dir); otherwise fail.
    """
    sc = spark.sparkContext
    with _ROOT_LOCK:  # builders run in threads; pick (and register) one root
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not root:
            current = sc.getCheckpointDir()
            if current:
                return current.rstrip("/")
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            root = tempfile.mkdtemp(prefix="lakestar-")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root.rstrip("/")


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder under the shared root."""
    return f"{shared_root(spark)}/lakestar/{purpose}/{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that is removed at the end of the enclosing :func:`scratch_scope`, else when the application ends."""
    path = new_run_dir(spark, purpose)
    if getattr(_SCOPE, "paths", None) is not None:
        _SCOPE.paths.append(path)
    else:
        atexit.register(_remove_at_exit, spark, path)
    return path


def write_and_read(df: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage through a written table: ``df`` is written once as parquet
    to a fresh folder under the shared root and read back with its schema.

    Used instead of an RDD ``checkpoint()`` where the rows carry their own
    bookkeeping columns (slice or partition id, position): parquet is
    columnar and compressed, and later reads prune the columns they do not
    need. Retries after an executor loss read the same files. The table is removed at the end of the enclosing
    :func:`scratch_scope`, else when the application ends.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

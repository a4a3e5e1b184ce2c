"""Session helpers: shared scratch storage and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Session setting for wide encoding projections.

    The JVM does not compile methods over 8000 bytes of bytecode. Stages whose
    generated method is larger run faster as several smaller ones.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a ``local`` master that names none;
    on a cluster a missing setting is an error, because executors on other
    hosts could not read what one of them wrote.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="wardlens-")
    return _LOCAL_SCRATCH[sc.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage on the shared folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path; everything of one application lies in one folder."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/wardlens-{app}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared scratch and read it back.

    Unlike a cached frame it survives the loss of any executor, and unlike an
    RDD checkpoint it is columnar, so later passes read only their columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, row_cells: int, task_cells: int = 2_000_000, most_cells: int = 20_000_000) -> DataFrame:
    """A written table in as many tasks as its work is worth: ``row_cells`` per row.

    The files of a table follow its bytes, which say little where a narrow row
    costs much or an iterative job reads it hundreds of times. A task gets about
    ``task_cells`` until every core has one, and up to ``most_cells`` after that,
    so tasks grow in number with the rows and stay bounded. A table that one
    task does quickly stays as it is. The file splits do not count: a file of
    one row group gives many, all but one of them empty.
    """
    cells = df.count() * max(1, row_cells)
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    tasks = max(min(-(-cells // task_cells), cores), -(-cells // most_cells))
    return df.repartition(tasks) if tasks > 1 else df


def side_by_side(df: DataFrame, row_cells: int, jobs: int, task_cells: int = 5_000_000) -> DataFrame:
    """A written table for iterative ``jobs`` that read it at the same time: ``row_cells`` of work per row.

    Its tasks fill the cores together with those of the other jobs, so more
    than a job's part of the cores only multiplies what each task ships and
    returns (a boosted fit: every node's histogram). A task gets up to
    ``task_cells``, so tasks grow in number with the rows; file splits are
    joined without a shuffle, never cut.
    """
    cells = df.count() * max(1, row_cells)
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    return df.coalesce(max(-(-cells // task_cells), -(-cores // max(1, jobs))))


def concurrently(spark: SparkSession, tasks: Sequence[Callable], parallelism: int | None = None) -> list:
    """Results of the tasks, of which ``parallelism`` (all) submit their jobs at the same time.

    Iterative fits are chains of short jobs that leave most of a cluster idle;
    several chains side by side fill it. Each has a scheduler pool of its own,
    so in a session with ``spark.scheduler.mode`` FAIR none waits for another.
    An error ends the call once the tasks that have begun are done.
    """
    if not tasks:
        return []

    def run(numbered):
        number, task = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"wardlens-{number}")
        try:
            return task()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPool(max(1, parallelism or len(tasks))) as pool:
        return pool.map(inheritable_thread_target(spark)(run), list(enumerate(tasks)), chunksize=1)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at a path, in any store that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def local_folder(spark: SparkSession, path: str) -> str | None:
    """A scratch path as Python sees it, if it lies in a mounted file system; none in other stores."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(place).toUri().getPath() if system.getUri().getScheme() == "file" else None


def release_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application.

    Frames that still read them fail afterwards, so call it once the results
    are written.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{scratch_root(spark)}/wardlens-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

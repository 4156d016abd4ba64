"""Session defaults and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
METHOD_CONF = "spark.sql.codegen.hugeMethodLimit"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a method above which the JVM never compiles it.
METHOD_BYTES = 8000


def local_session(app: str = "wavelens", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Without that setting, the folder the session checkpoints to already. A
    machine-local folder is only made up in local mode, where the driver and the
    executors are the same process, and goes when that process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="wavelens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def header_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """``(position, name)`` of a table's headers, as a relation local to the plan."""
    positions = pa.array(range(len(names)), pa.int32())
    return spark.createDataFrame(
        pa.table({"position": positions, "name": pa.array(names, pa.string())})
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it from there.

    For a small aggregated table that several branches of a query start from:
    its source is scanned once, and losing an executor does not lose the result.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table that ``stored`` wrote, when nothing reads it any more."""
    context = table.sparkSession.sparkContext
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        if "/scratch/" in folder:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs run meanwhile use no generated method so long that the JVM would only interpret it.

    For jobs over all columns of a wide table: by default Spark keeps such methods up to
    eight times that length, and they are slower than the stages it takes instead.
    """
    before = spark.conf.get(METHOD_CONF)
    spark.conf.set(METHOD_CONF, str(min(int(before), METHOD_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(METHOD_CONF, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs run meanwhile drop their shuffle files when they end, not when the driver's memory is next tidied.

    For queries of several jobs, each of which starts from stored tables.
    """
    before = spark.conf.get(CLEANUP_CONF)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that later rounds start from files."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)

"""Session settings and the shared folder for cut lineage.

A cluster names its shared folder in ``spark.checkpoint.dir``.  It is read from
the session; only where it is unset (tests, a laptop) a folder of our own is
made.  Results that several later jobs read are written there as Parquet, which
survives the loss of any executor and costs less disk than an RDD checkpoint.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}
_written: list[tuple[str, str]] = []
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, unless PYTHONPATH has it already."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    folder = tempfile.mkdtemp(prefix="termloom-py-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "termloom"), "zip", root, os.path.basename(package)))


def build_session(master: str = "local[*]", partitions: int = 8) -> SparkSession:
    """A session for tests and benches."""
    spark = (
        SparkSession.builder.master(master)
        .appName("termloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TERMLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        own = tempfile.mkdtemp(prefix="termloom-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _own_dirs[app] = "file://" + own
    return _own_dirs[app]


def materialize(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut there."""
    spark = df.sparkSession
    ship_package(spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}.parquet"
    _written.append((spark.sparkContext.applicationId, path))
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


@contextlib.contextmanager
def text_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What is run inside goes to Python in batches of at most so many rows: for columns of whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(spark: SparkSession) -> int:
    """Remove all that ``materialize`` has written in this application, once its results are no longer needed; returns how many tables."""
    mine = [p for app, p in _written if app == spark.sparkContext.applicationId]
    for p in mine:
        drop_path(spark, p)
    _written[:] = [x for x in _written if x[1] not in set(mine)]
    return len(mine)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder written by this library."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

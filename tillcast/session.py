"""Session defaults, and staging of intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_CODEC_KEY = "spark.sql.parquet.compression.codec"


def build_session(app: str = "tillcast", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    cpus = cpus or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python functions import from it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tillcast-")) / "tillcast.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    """Ship the package and set what the plans rely on; all of it works on a running session."""
    ship(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The JVM does not compile methods above 8000 bytes. Wide feature projections exceed that as one
    # generated method, and run twice as fast when Spark splits them instead.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # Feature tables are wide rows of doubles, of which zstd leaves about two thirds of what snappy does. A caller's choice holds.
    if spark.conf.get(_CODEC_KEY, None) is None:
        spark.conf.set(_CODEC_KEY, "zstd")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a scratch folder only for an unset local session."""
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_CHECKPOINT_KEY} must name a folder that every executor can reach")
    path = tempfile.mkdtemp(prefix="tillcast-")
    spark.conf.set(_CHECKPOINT_KEY, path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; it goes when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    file_system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(folder)
    file_system.deleteOnExit(folder)
    return f"{folder.toString()}/data"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    The result survives lost executors, its lineage is one scan, and its size is known to the planner:
    a join with it is broadcast only while it is below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffled beyond that.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``stage`` for a limited time: the files go at the end of the block, as a long-running stream needs."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "boardlake", cores: int | str = 8, **conf: str) -> SparkSession:
    """A session for tests and benches. On a cluster the submitted settings apply instead."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cores if str(cores).isdigit() else 8),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = pathlib.Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="boardlake-"), "boardlake.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the warehouse: both are shared by driver and executors."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """Where this application keeps its staged data."""
    return f"{shared_folder(spark)}/boardlake-{spark.sparkContext.applicationId}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any file system. Frames that still read it must not be used after."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_names(spark: SparkSession, folder: str, mark: str | None = None) -> list[str]:
    """Names of the folders in a folder, of those that hold a file ``mark`` if one is named; none if the folder is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = [entry.getPath() for entry in files.listStatus(path) if entry.isDirectory()]
    return [p.getName() for p in found if mark is None or files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, mark))]


def clear_scratch(spark: SparkSession) -> None:
    """Remove all staged data of this application."""
    remove_folder(spark, scratch_folder(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here remove their shuffle files as they end; else these stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    usual = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def staged(frame: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back, for results that several plans use."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.partitionBy(*partition_by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}
_shipped: set[str] = set()
_written: dict[str, list[str]] = {}


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC session with adaptive execution; ``conf`` uses ``_`` for ``.`` in setting names."""
    builder = (
        SparkSession.builder.appName("tsengine")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Wide tables are hundreds of Column calls; recording a stack trace for each slows the driver.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A temporary folder is used only by a local master, where driver and executors are one process; it goes when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="tsengine-")
        atexit.register(shutil.rmtree, _local_root[app], ignore_errors=True)
    return _local_root[app]


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that their functions can import it anywhere."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = f"{tempfile.mkdtemp(prefix='tsengine-code-')}/tsengine.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def shipped(run):
    """``run(spark, ...)`` after ``ship_package``."""

    @functools.wraps(run)
    def with_package(spark, *args):
        ship_package(spark)
        return run(spark, *args)

    return with_package


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Deletes the intermediates that this application has written so far. Call it when their results have been used."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        delete_folder(spark, path)


def file_system(spark: SparkSession, path: str) -> tuple:
    """(Hadoop file system, its path object) of ``path``."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def delete_folder(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none where it does not exist."""
    files, place = file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()] if files.exists(place) else []


def claim(spark: SparkSession, path: str) -> bool:
    """Creates the empty file ``path`` and tells whether this call made it: of several writers exactly one gets True."""
    files, place = file_system(spark, path)
    files.mkdirs(place.getParent())
    if files.getScheme() == "file":  # Hadoop's local file system looks first and creates then
        try:
            os.close(os.open(place.toUri().getPath(), os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    try:
        files.create(place, False).close()
    except Py4JJavaError:
        if files.exists(place):
            return False
        raise
    return True


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of a table that many jobs reuse; unlike cached blocks the files survive a lost executor.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Session set-up and lineage cutting."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "opspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    AQE chooses broadcast joins from measured sizes and splits skewed join partitions, so the
    operators carry no broadcast hint for anything that grows with the data. On a cluster leave
    ``master`` out and pass ``spark.sql.shuffle.partitions`` as a high initial value: AQE coalesces.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Sends this package to the workers once in each application, so that its functions can be unpickled there
    whatever folder the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        # Executors may ask the driver for the file at any time, so it stays until the driver ends.
        place = tempfile.TemporaryDirectory(prefix="opspark-package-")
        atexit.register(place.cleanup)
        sc.addPyFile(package_file(place.name))
        _SHIPPED.add(sc.applicationId)
    return spark


def package_file(place: str) -> str:
    """This package as a zip file in a folder."""
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(place, "opspark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder_, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder_, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is taken only in local
    mode, where every task shares the driver's disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="opspark-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


#: Folders written by ``cut_lineage`` that are still there, by application.
_INTERMEDIATE: dict[str, list[str]] = {}


def folder(spark: SparkSession, path: str):
    """The store that holds a path, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _forget_at_exit(spark: SparkSession, path: str) -> None:
    """The store deletes the folder when the driver ends, unless ``drop_intermediates`` did before."""
    store, where = folder(spark, path)
    store.deleteOnExit(where)
    _INTERMEDIATE.setdefault(spark.sparkContext.applicationId, []).append(path)


def drop_intermediates(spark: SparkSession) -> int:
    """Deletes what ``cut_lineage`` has written in this application, and returns the number of folders.

    For use between jobs: frames made before, and not yet written elsewhere, can no longer be read.
    """
    paths = _INTERMEDIATE.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        store, where = folder(spark, path)
        store.delete(where, True)
    return len(paths)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ``scratch`` that nothing reads any more."""
    store, where = folder(spark, path)
    store.delete(where, True)
    name = os.path.basename(path.rstrip("/"))
    left = [p for p in _INTERMEDIATE.get(spark.sparkContext.applicationId, []) if os.path.basename(p) != name]
    _INTERMEDIATE[spark.sparkContext.applicationId] = left


def release(*frames: DataFrame) -> None:
    """Deletes the files of frames as ``cut_lineage`` returned them, once nothing reads these any more."""
    for df in frames:
        for path in {os.path.dirname(f) for f in df.inputFiles()}:
            drop(df.sparkSession, path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder; what is written there goes when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/opspark-{name}-{uuid.uuid4().hex}"
    _forget_at_exit(spark, path)
    return path


def cut_lineage(df: DataFrame, by: str | None = None, codec: str | None = None) -> DataFrame:
    """Writes the frame to the shared checkpoint folder and reads it back.

    One computation, however many readers follow; the files outlive any executor, and later readers
    prune columns and push filters into them. ``by`` names a column of few values to partition the files by, ``codec`` another compression than the session's.
    """
    spark = df.sparkSession
    path = scratch(spark, "frame")
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])

"""Session set-up and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def build_session(app_name: str, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew-join splitting on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Without this every column expression records its place in the Python code.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once for each context.

    Functions that run in Python workers travel by name, and a worker finds them only
    where the package is installed or shipped. The sources go out as Spark ships any
    Python file, as one small archive.
    """
    context = spark.sparkContext
    if getattr(context, "_chorale_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="chorale-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "chorale.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for at, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._chorale_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it then gets a temporary
    folder for the life of the process. On a cluster a folder of one machine
    would be lost with it, so a missing setting is an error there.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="chorale-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def run_folder(spark: SparkSession) -> str:
    """The folder under the shared one that holds what this application writes for itself."""
    return f"{shared_folder(spark)}/chorale-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the run's folder, never used before."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what this application has written for itself. Call it when no result is read
    any more; tables under another path stay."""
    return _remove(spark, run_folder(spark))


def _remove(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that nothing refers to any more: it does so only
    when the driver collects its garbage, which a driver with little to do may not for long."""
    gc.collect()
    spark._jvm.System.gc()


class Workspace:
    """Tables that a job writes under the run's folder on its way to a result.

    Reading them back cuts lineage as a checkpoint does, in compressed columns and in as
    many partitions as their size asks for. A job drops what it needs no more, and so
    leaves nothing but what its result reads.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self._spark = spark
        self._folder = scratch_path(spark, name)
        self._written = 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, written and read back; ``name`` is for who looks at the folder."""
        self._written += 1
        path = f"{self._folder}/{self._written}-{name}"
        df.write.parquet(path)
        table = self._spark.read.schema(df.schema).parquet(path)
        table._chorale_path = path
        return table

    def same(self, df: DataFrame, table: DataFrame) -> DataFrame:
        """``df``, which reads ``table``, to be dropped in its place."""
        df._chorale_path = table._chorale_path
        return df

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` gave; nothing may read them any more."""
        for table in tables:
            _remove(self._spark, table._chorale_path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context a checkpoint folder if it has none yet; ``clear_scratch`` deletes it too."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{run_folder(spark)}/checkpoints")

"""Session settings the operators rely on, intermediate tables, and shipping the package to the workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even if the next aggregate must then shuffle again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a batch of long texts must fit in a worker beside the arrays made of it
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
# shuffle files go when their query ends, not when the driver happens to collect garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SHIPPED: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; static settings stay with whoever built the session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="shortlist-"), "shortlist_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("shortlist", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and written intermediates.

    A cluster names it in ``spark.checkpoint.dir``. Only a session whose executors run on this
    machine may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="shortlist-")
    elif not sc.master.startswith("local") and named.startswith(tempfile.gettempdir() + os.sep):
        raise RuntimeError(f"{named} is in this machine's temporary folder; executors elsewhere cannot read it")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def durable(df: DataFrame, *by: str) -> DataFrame:
    """Write ``df`` to shared storage, in folders by the columns ``by``, and read it back: later steps
    do not repeat the work, and a lost executor cannot change it. The table goes with ``release``, at the latest when the
    application ends."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/tables-{spark.sparkContext.applicationId}"
    path = f"{folder}/{uuid.uuid4().hex}"
    # a write is planned for itself, so nothing else can want its shuffle files again
    kept = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, kept)
    p, fs = hadoop_path(spark, folder)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._durable_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables made by ``durable`` that nothing will read again."""
    for df in tables:
        path = getattr(df, "_durable_path", None)
        if path is not None:
            p, fs = hadoop_path(df.sparkSession, path)
            fs.delete(p, True)

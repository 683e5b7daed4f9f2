"""Session settings used by tests, the bench and stand-alone jobs."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str = "local[*]", name: str = "txspark", **conf: str) -> SparkSession:
    """A session with UTC times, adaptive plans and ANSI arithmetic.

    On a cluster, leave ``master`` to spark-submit; partition numbers follow from
    the adaptive coalescing, so only the upper limit is set here.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share; below the temporary folder only on a local master without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and (not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(root or tempfile.gettempdir() + '/txspark-scratch').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written once to a new folder of ``work_folder``: it cuts lineage and survives lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that are written by now: it does so when the driver has collected the plans that made them, else only in its periodic collection."""
    gc.collect()
    spark._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once: they need it wherever it is not installed on the executors."""
    context = spark.sparkContext
    if getattr(context, "txspark_shipped", False):
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="txspark-")) / "txspark.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(here.rglob("*.py")):
            archive.write(path, path.relative_to(here.parent))
    context.addPyFile(str(target))
    context.txspark_shipped = True

"""Tables between the steps of an operator, written to the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only on a local master that names no folder, as in tests.
LOCAL_FOLDER = f"{tempfile.gettempdir()}/txspark-scratch"

#: Narrow rows (ids, keys, pairs) are broadcast up to this many, and joined by a shuffle beyond.
BROADCAST_ROWS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not (spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder or LOCAL_FOLDER


class Scratch:
    """A folder of Parquet tables that cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


    def free_shuffles(self) -> None:
        """Let Spark delete the shuffle files of tables that are written by now.

        It does so when the driver has collected the plans that made them, else only in its periodic collection.
        """
        gc.collect()
        self.spark._jvm.System.gc()


def few_rows(df: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """A narrow table, marked for broadcast if it has few rows, else for a join by shuffle: Spark's own choice goes by the size of compressed files, and the driver would hold many times that.

    ``of`` is a written table that has no fewer rows, counted in place of one that would be computed for it.
    """
    counted = df if of is None else of
    return F.broadcast(df) if counted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df.hint("merge")

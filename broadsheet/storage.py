"""Intermediate tables in the shared checkpoint folder: lineage ends there, executors may go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a temporary folder; a cluster session must
    name one, as a machine-local folder would not be visible to its executors.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="broadsheet-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(location)


class Workspace:
    """A fresh folder below the checkpoint root for the tables of one operator run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._tables = 0

    def write(self, df: DataFrame) -> DataFrame:
        """Write the rows as a parquet table and return a DataFrame that reads it back."""
        self._tables += 1
        path = f"{self.path}/{self._tables:04d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_counted(self, df: DataFrame) -> tuple[DataFrame, int]:
        """As ``write``, with the row count, which parquet keeps in its footers."""
        table = self.write(df)
        return table, table.count()

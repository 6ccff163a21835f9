"""Intermediate results written to the cluster's shared folder.

Iterative jobs write each step instead of growing the plan. Written files
survive the loss of an executor, and a step is never recomputed.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
DATABASE = "sparkloom_scratch"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    Where neither is set, a local session gets a temporary folder; on a cluster
    that is an error, since other machines would not see it.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sparkloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


class Scratch:
    """A uniquely named place under the shared folder for one job's steps."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = shared_folder(spark)
        self.name = f"{name}_{uuid.uuid4().hex[:12]}"
        self.path = f"{self.folder}/sparkloom/{self.name}"

    def write(self, df: DataFrame, step: str) -> DataFrame:
        """Write ``df`` as Parquet under ``step`` and return the written copy."""
        path = f"{self.path}/{step}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(
        self, df: DataFrame, step: str, keys: Sequence[str], buckets: int
    ) -> DataFrame:
        """Write ``df`` as a table bucketed by ``keys``: later joins on them need not move it."""
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{self.folder}/{DATABASE}'"
        )
        table = f"{DATABASE}.{self.name}_{step}"
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).saveAsTable(table)
        return self.spark.table(table)

    def drop_table(self, step: str) -> None:
        """Drop a bucketed table together with its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {DATABASE}.{self.name}_{step}")

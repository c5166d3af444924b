"""Tables written to the shared folder and read again, so that a lost executor costs a task and not the job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rowwarden.session import checkpoint_dir


class Staging:
    """A folder of one job under `spark.checkpoint.dir`; tables that are no longer read can go."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

"""Tables of one run in the shared folder; writing one cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import join_path, new_work_dir


class Store:
    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.n = spark, new_work_dir(spark, label), 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = join_path(self.root, f"{self.n:03d}-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

"""One run's intermediate tables, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marginloom.staging import shared_folder

#: Rows that Spark sends to a Python worker at once. Texts have no bound, and Spark counts rows.
TEXTS_AT_ONCE = 1000


def send_few_texts(spark: SparkSession) -> None:
    """Keeps the batches of Python functions on texts small; for queries that run such functions."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_AT_ONCE))


class Scratch:
    """Names of one run's intermediate tables."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self.count = 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.folder}/{self.count:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        schema = df.schema
        df.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

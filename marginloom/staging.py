"""Intermediate tables in the folder that all executors share.

A table is written as Parquet and read back, so later steps neither recompute it nor lose it with an
executor. The folder is ``spark.checkpoint.dir``. Only a local session, whose executors are the driver itself, may
go without: it gets a temporary folder. On a cluster a folder of the driver's own machine would be one that no other
machine can see, and a table read back from it would be empty.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


class NoSharedFolder(RuntimeError):
    """``spark.checkpoint.dir`` isn't set on a cluster."""


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise NoSharedFolder(f"set spark.checkpoint.dir to a folder that all machines of {master} can read and write")
        folder = "file://" + tempfile.mkdtemp(prefix="marginloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed now and read back from a new folder of its own."""
    path, schema = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}", df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def staged_together(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Several tables staged at once: their jobs share the executors instead of waiting for each other."""
    inherit = inheritable_thread_target(next(iter(tables.values())).sparkSession)
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = [pool.submit(inherit(staged), df, name) for name, df in tables.items()]
        return [job.result() for job in jobs]

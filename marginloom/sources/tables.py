"""Source readers and result publishing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from marginloom.sources.rules import read_by_header
from marginloom.sources.schemas import SCHEMAS
from marginloom.sources.versions import Versions


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A synced source table kept as Parquet, with its declared schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def read_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A hand-imported table (plan, manual spend ...); columns by the names in the header, types declared.

    A value that does not fit its type stops the job instead of turning into NULL.
    """
    fields = [part.strip().split(" ", 1) for part in re.split(r",\s*(?![^(]*\))", SCHEMAS[name])]
    texts = read_by_header(spark, path, [column for column, _ in fields])
    return texts.selectExpr(*[f"CAST({column} AS {kind}) AS {column}" for column, kind in fields])


def read_invoice_list(spark: SparkSession, path: str) -> DataFrame:
    """Invoice numbers, one per line; blank lines dropped, duplicates kept."""
    return spark.read.text(path).selectExpr("trim(value) AS invoice_number").where("invoice_number <> ''")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Make a result readable by name in this session; evaluated when read."""
    df.createOrReplaceTempView(name)
    return df


def published_versions(spark: SparkSession, name: str) -> Versions:
    """The versions behind a table that ``publish_table`` writes."""
    *database, table = name.split(".")
    home = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase()).locationUri
    return Versions(spark, f"{home.rstrip('/')}/{table}_published")


def _points_alike(spark: SparkSession, name: str, df: DataFrame, partition_by: list[str]) -> bool:
    """Whether the table has these columns and partitions and points to a folder."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "EXTERNAL":
        return False
    if {f.name: f.dataType for f in spark.table(name).schema.fields} != {f.name: f.dataType for f in df.schema.fields}:
        return False
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == partition_by


def publish_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Write a result as a table for other sessions, replacing an earlier one.

    The rows are complete in a folder of their own before the table is pointed to it, in one step, so that readers
    see the old table or the new one; a job that fails leaves the old one. Only where columns or partitions change
    is the table's entry made anew. Partitions are found in the folder, not listed one by one in the catalog.
    ``published_versions(...).vacuum()`` removes folders that are no longer read.
    """
    spark, parts = df.sparkSession, partition_by or []

    def write(folder: str) -> None:
        writer = df.write.format("parquet")
        (writer.partitionBy(*parts) if parts else writer).save(folder)

    folder = published_versions(spark, name).replace(write)
    if _points_alike(spark, name, df, parts):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        return
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    split = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
    tracked = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(tracked)
    spark.conf.set(tracked, "false")
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({listed}) USING parquet {split} LOCATION '{folder}'")
    finally:
        spark.conf.set(tracked, before)

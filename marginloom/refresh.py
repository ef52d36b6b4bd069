"""Refreshing sums by day after a sync: only days whose source rows have changed are summed and written again.

A table of day sums is partitioned by its day. Beside it lies a digest per day of the source rows it was made from.
A refresh computes the digests anew, compares them, sums the rows of the days that differ and overwrites those
partitions; days that have vanished from the source are removed. The digests are written last: a refresh that fails
half way is repeated by the next one, and since a day is always summed from all its rows, repeating it is harmless.

Sums, counts, minima and maxima by day merge to any longer span, so weekly, monthly and year-to-date tables read the
day sums instead of the source.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from marginloom.sources.versions import Versions
from marginloom.staging import staged
from marginloom.types import text

DIGESTS = "_digests"
#: Days that are listed in a filter, which can skip files and row groups; more are joined.
FEW_DAYS = 1000
#: What stands for rows without a day, in digests and in the names of partitions.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def row_digests(rows: DataFrame, day: str) -> DataFrame:
    """day, digest: the same for the same rows of a day in any order; it tells apart rows, columns and copies.

    Two hashes of each row are summed as wide decimals and one is combined by exclusive or, with the number of rows.
    """
    cells = [f"coalesce(to_json(struct(`{c}`)), '{{}}')" for c in rows.columns]
    whole = f"concat_ws('\\u0001', {', '.join(cells)})"
    hashed = rows.selectExpr(
        f"CAST({day} AS STRING) AS day", f"xxhash64({whole}) AS h", f"xxhash64({whole}, 'again') AS g"
    )
    digest = "concat_ws('/', count(*), sum(CAST(h AS DECIMAL(20,0))), sum(CAST(g AS DECIMAL(20,0))), bit_xor(h)) AS digest"
    return hashed.groupBy("day").agg(F.expr(digest))


def file_digests(rows: DataFrame, day: str) -> DataFrame:
    """day, digest from the names, sizes and times of the files that hold a day; no column but the day is read.

    For sources read from files that are partitioned by day, or at least hold few days each.
    """
    files = rows.selectExpr(
        f"CAST({day} AS STRING) AS day",
        "xxhash64(_metadata.file_path, _metadata.file_size, _metadata.file_modification_time) AS f",
    ).distinct()
    return files.groupBy("day").agg(F.expr("concat_ws('/', count(*), sum(CAST(f AS DECIMAL(20,0))), bit_xor(f)) AS digest"))


@dataclass(frozen=True)
class Refreshed:
    """Days that were summed again, and days that were removed."""

    written: list[str | None]
    removed: list[str | None]


class DaySums:
    """A table of sums by day at ``path``, made by ``build`` from source rows.

    ``build`` maps rows to sums and keeps the column ``day``; it must not look from one day at another.
    ``version`` names the definition: where it differs from the stored one, every day is summed again. Give it
    whatever else the sums depend on, such as a digest of the rules.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        day: str,
        build: Callable[[DataFrame], DataFrame],
        digests: Callable[[DataFrame, str], DataFrame] = row_digests,
        version: str = "1",
    ):
        self.spark, self.path, self.day = spark, path.rstrip("/"), day
        self.build, self.digests, self.version = build, digests, version
        self._stored = Versions(spark, f"{self.path}/{DIGESTS}")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def _known(self) -> DataFrame:
        folders = self._stored.folders()
        if not folders:
            return self.spark.createDataFrame([], "day STRING, digest STRING")
        return self.spark.read.schema("day STRING, digest STRING").parquet(*folders)

    def _remove(self, day: str | None) -> None:
        jvm = self.spark._jvm.org.apache.hadoop.fs
        at = jvm.Path(f"{self.path}/{self.day}={NO_DAY if day is None else day}")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def refresh(self, rows: DataFrame) -> Refreshed:
        """Brings the table up to the source ``rows`` and says which days that took.

        What comes to the driver is the list of changed days, which the calendar bounds.
        """
        marked = f"concat({text(self.version + ' ')}, digest) AS digest"
        new = self.digests(rows, self.day).selectExpr("day", marked)
        # the new digests are kept as they are now, before the rows are read again
        draft = Versions(self.spark, f"{self.path}/{DIGESTS}-draft")
        folder = draft.replace(lambda at: new.write.parquet(at))
        new = self.spark.read.schema("day STRING, digest STRING").parquet(folder)
        old = self._known().toDF("old_day", "old_digest")
        both = new.join(old, F.expr("day <=> old_day"), "full").where("NOT digest <=> old_digest")
        found = both.selectExpr("if(digest IS NULL, old_day, day) AS day", "digest IS NULL AS gone").collect()
        removed = sorted((r.day for r in found if r.gone), key=str)
        written = sorted((r.day for r in found if not r.gone), key=str)
        if written:
            sums = staged(self.build(self._of_days(rows, written)), "day-sums")
            self._write(sums)
            self._drop_empty(written, sums)
        for day in removed:
            self._remove(day)
        if written or removed:
            self._stored.replace(lambda at: new.write.parquet(at))
        draft.vacuum(keep=1, hours=0)
        return Refreshed(written, removed)

    def _of_days(self, rows: DataFrame, days: list[str | None]) -> DataFrame:
        kind = rows.schema[self.day].dataType.simpleString()
        if len(days) <= FEW_DAYS:
            listed = ", ".join(f"CAST({text(d)} AS {kind})" for d in days if d is not None) or f"CAST(NULL AS {kind})"
            none = f" OR {self.day} IS NULL" if None in days else ""
            return rows.where(f"{self.day} IN ({listed}){none}")
        changed = self.spark.createDataFrame([(d,) for d in days], "changed STRING").selectExpr(f"CAST(changed AS {kind}) AS changed")
        return rows.join(changed, F.expr(f"{self.day} <=> changed"), "left_semi")

    def _write(self, sums: DataFrame) -> None:
        writer = sums.repartition(self.day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.day).parquet(self.path)

    def _drop_empty(self, days: list[str | None], sums: DataFrame) -> None:
        """A day whose rows have changed may have no sums any more."""
        left = {r[0] for r in sums.selectExpr(f"CAST({self.day} AS STRING)").distinct().collect()}
        for day in days:
            if day not in left:
                self._remove(day)

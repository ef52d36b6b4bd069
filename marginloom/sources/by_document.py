"""Tables stored by document, so that joins and sums by document move no row.

A fact table (ledger, invoice lines) and the documents it belongs to (bridge, headers) are stored in the same number
of buckets by document id, sorted within. Joins on the id then read bucket beside bucket. A bucket can't be split, so
rows that would make one too large are kept apart: rows without an id, and documents with more rows than an even
bucket holds. There are fewer such documents than buckets, which bounds what their join has to broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from marginloom.staging import shared_folder, staged


@dataclass(frozen=True)
class ByDocument:
    """``docs``: bucketed by ``key``; ``rest``: rows without a key and of ``large`` documents (one column, the key)."""

    key: str
    buckets: int
    docs: DataFrame
    rest: DataFrame
    large: DataFrame

    def all(self) -> DataFrame:
        return self.docs.unionByName(self.rest)


def large_documents(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """Ids with more rows than an even share of a bucket: fewer than ``buckets``."""
    counts = staged(rows.where(f"`{key}` IS NOT NULL").groupBy(key).agg(F.expr("count(*) AS n")), "document-sizes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") > total / buckets).select(key)


def store_by_document(rows: DataFrame, key: str, buckets: int, large: DataFrame | None = None) -> ByDocument:
    """``rows`` in a folder of the shared storage. ``large`` is that of the fact table when its documents are stored."""
    spark = rows.sparkSession
    large = staged(large_documents(rows, key, buckets), "large-documents") if large is None else large.toDF(key)
    apart = F.broadcast(large)  # fewer than the buckets
    name = f"by_document_{uuid.uuid4().hex}"
    docs = rows.where(f"`{key}` IS NOT NULL").join(apart, key, "left_anti").select(*rows.columns)
    # one task per bucket writes one file per bucket, which is what keeps it sorted when it is read
    writer = docs.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
    writer.option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    rest = rows.join(apart, key, "left_semi").select(*rows.columns).unionByName(rows.where(f"`{key}` IS NULL"))
    return ByDocument(key, buckets, spark.table(name), staged(rest, "apart"), large)


def over_documents(
    facts: ByDocument, documents: ByDocument, of: Callable[[DataFrame, DataFrame, bool], DataFrame]
) -> DataFrame:
    """``of(facts, documents, few)`` for tables stored alike, where ``of`` joins them by document or sums by document.

    The bucketed parts meet without an exchange. The rest is met by the documents kept apart. ``few`` says that the
    documents are counted and fewer than the buckets, so that a join may broadcast them; where ``documents`` has more
    rows than that, it is left to Spark's size check.
    """
    if (facts.key, facts.buckets) != (documents.key, documents.buckets):
        raise ValueError(f"stored by {facts.key} in {facts.buckets} and by {documents.key} in {documents.buckets} buckets")
    known = documents.rest.where(f"`{documents.key}` IS NOT NULL")
    few = known.limit(facts.buckets + 1).count() <= facts.buckets
    return of(facts.docs, documents.docs, False).unionByName(of(facts.rest, known, few))

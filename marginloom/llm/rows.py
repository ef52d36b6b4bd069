"""Telling rows apart and keeping some of them, whatever their ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def row_key(doc_id: Column, text: Column) -> Column:
    """Equal for repeated rows only: the id and the SHA-256 of the text (null as empty)."""
    digest = F.sha2(F.coalesce(text, F.lit("")), 256)
    return F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("null")), digest)


def packed(rows: DataFrame, **beside: Column) -> DataFrame:
    """All columns of ``rows`` in one struct column, row, and ``beside`` it columns made from them.

    Whatever is added beside the row can't clash with the user's names; ``row.*`` gives the rows back.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    return rows.select(whole, *[value.alias(name) for name, value in beside.items()])


def keep_rows(docs: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is in the one column of ``keys``, with the columns of ``docs``.

    Of rows with the same key, which differ in other columns at most, the first by the hash of all columns stays.
    The text is shuffled once: the join and the choice of a row share the exchange.
    """
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    staying = packed(docs, key=key).join(keys.toDF("key"), "key", "left_semi").withColumn("place", place)
    return staying.where("place = 1").select("row.*")

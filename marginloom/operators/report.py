"""Report helpers: pivot with filters, first-row flag, newest-first order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from marginloom.functions.calendar import as_date
from marginloom.types import texts


def pivot_report(
    df: DataFrame,
    rows: list[str],
    column: str,
    values: list[str],
    value: str | dict[str, str],
    agg: str = "sum",
    where: str | None = None,
    date_range: tuple[str, dt.date | str, dt.date | str] | None = None,
) -> DataFrame:
    """Rows x column values; the user filters apply before the pivot.

    Giving the column values keeps the pivot to one aggregation without a pass to find them. No
    amount gets lost: a value that isn't listed stops the job. ``value`` can name several
    columns, as output name to column; then each gives a column ``<column value>_<output name>``.
    """
    if where is not None:
        df = df.where(where)
    if date_range is not None:
        name, first, last = date_range
        df = df.where(f"{name} BETWEEN {as_date(first)} AND {as_date(last)}")
    unlisted = f"raise_error(concat('no pivot column for {column} ', coalesce({column}, 'NULL')))"
    listed = f"CASE WHEN {column} IN ({texts(values)}) THEN {column} ELSE {unlisted} END"
    others = [c for c in df.columns if c != column]
    outputs = value.items() if isinstance(value, dict) else [(None, value)]
    sums = [F.expr(f"{agg}({source})" + (f" AS {name}" if name else "")) for name, source in outputs]
    return df.selectExpr(*others, f"{listed} AS {column}").groupBy(*rows).pivot(column, values).agg(*sums)


def smallest_ids(df: DataFrame, group: list[str], row_id: str, unique_by: list[str] | None = None) -> DataFrame:
    """One row per group: its columns as ``_g0``, ``_g1`` ..., and ``_smallest``, what its first row is known by.

    A group without any id is there too, with NULL. The minimum is combined on the map side, so
    no group is gathered in one task.
    """
    ranked = f"if({row_id} IS NULL, NULL, {_ranked(row_id, unique_by)})"
    keys = [f"{c} AS _g{i}" for i, c in enumerate(group)]
    return df.selectExpr(*keys, f"{ranked} AS _ranked").groupBy(*[f"_g{i}" for i in range(len(group))]).agg(
        F.expr("min(_ranked) AS _smallest")
    )


def _ranked(row_id: str, unique_by: list[str] | None) -> str:
    return f"struct({', '.join([row_id, *unique_by])})" if unique_by else row_id


def is_first(row_id: str, unique_by: list[str] | None = None) -> str:
    """1 on a row that meets its group in ``smallest_ids`` and has the smallest id, else 0."""
    return f"if({row_id} IS NOT NULL AND {_ranked(row_id, unique_by)} <=> _smallest, 1, 0)"


def same_group(group: list[str]):
    """Join condition to ``smallest_ids``; NULL group values match."""
    return F.expr(" AND ".join(f"{c} <=> _g{i}" for i, c in enumerate(group)))


def first_row_flag(df: DataFrame, group: list[str], row_id: str, out: str, unique_by: list[str] | None = None) -> DataFrame:
    """1 on the rows that hold the smallest ``row_id`` of their group, else 0; NULL ids get 0.

    Every row with the smallest id is flagged. With ``unique_by`` ties are settled by those
    columns, so one row per group is flagged if they tell its rows apart.
    """
    marked = df.join(smallest_ids(df, group, row_id, unique_by), same_group(group), "left")
    return marked.selectExpr(*[f"`{c}`" for c in df.columns], f"{is_first(row_id, unique_by)} AS {out}")


def newest_first(df: DataFrame, newest: str, *then: str) -> DataFrame:
    """Descending by ``newest``; further columns ascending, which also lets one week be cut into ranges."""
    return df.orderBy(F.desc(newest), *then)

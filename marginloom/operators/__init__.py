"""Relational building blocks: joins, next-event search, allocation, reports."""

from marginloom.operators.allocate import allocate_by_share, allocate_fixed, share_table
from marginloom.operators.asof import first_after
from marginloom.operators.joins import (
    exclude_keep_null,
    expand_seconds,
    left_join_keyed,
    left_join_lines,
    tolerance_join,
    unfilled_scaffold,
)
from marginloom.operators.report import first_row_flag, newest_first, pivot_report
from marginloom.operators.textagg import joined_distinct

__all__ = [
    "allocate_by_share",
    "allocate_fixed",
    "exclude_keep_null",
    "expand_seconds",
    "first_after",
    "first_row_flag",
    "joined_distinct",
    "left_join_keyed",
    "left_join_lines",
    "newest_first",
    "pivot_report",
    "share_table",
    "tolerance_join",
    "unfilled_scaffold",
]

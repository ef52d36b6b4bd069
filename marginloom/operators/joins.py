"""Joins that keep their shape when one key holds a large part of the rows.

Hot keys on the left of a left join need nothing special: adaptive execution splits them. Rows without a key meet
nothing, so ``left_join_keyed`` takes them past the join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from marginloom.functions.calendar import wall_micros
from marginloom.types import texts


def exclude_keep_null(col: str, values: Iterable[str]) -> str:
    """``NOT IN`` that keeps rows whose value is NULL."""
    return f"({col} NOT IN ({texts(values)}) OR {col} IS NULL)"


def _names(columns: Iterable[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def left_join_lines(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join whose right side may hold many rows of one key (header to lines).

    Adaptive execution splits a hot key on both sides of an inner join, but not on the right of a
    left join. So the matches come from an inner join, and the left rows without any from an anti
    join with the distinct keys, which are combined before they are shuffled.
    """
    unmatched = left.join(right.select(*on).distinct(), on, "left_anti")
    return left.join(right, on, "inner").unionByName(unmatched, allowMissingColumns=True)


def left_join_keyed(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join on one column that many rows of ``left`` may lack.

    Without a key they would all be shuffled to one partition, there to be sorted; they meet nothing anyway.
    """
    keyed = left.where(f"{on} IS NOT NULL").join(right, on, "left")
    return keyed.unionByName(left.where(f"{on} IS NULL"), allowMissingColumns=True)


def unfilled_scaffold(scaffold: DataFrame, facts: DataFrame, on: list[str]) -> DataFrame:
    """Scaffold rows that no fact falls on, found from the distinct fact keys."""
    return scaffold.join(facts.select(*on).distinct(), on, "left_anti")


def expand_seconds(df: DataFrame, ts: str, seconds: int = 10) -> DataFrame:
    """One copy of each row per second offset 0..seconds added to ``ts``."""
    spread = df.selectExpr("*", f"explode(sequence(0, {seconds})) AS _offset")
    shifted = [f"`{c}` + make_dt_interval(0, 0, 0, _offset) AS `{c}`" if c == ts else f"`{c}`" for c in df.columns]
    return spread.selectExpr(*shifted)


def tolerance_join(
    left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, seconds: int = 10
) -> DataFrame:
    """Inner join on ``on`` where ``left_ts`` lies 0..seconds after ``right_ts``.

    Both sides are cut into buckets as wide as the tolerance and each right row is placed
    in its own bucket and the next one, so the match is an equality join and a pair can be
    found only once. A busy key is spread over its buckets.
    """
    width = seconds * 1_000_000
    cut = left.selectExpr("*", f"{wall_micros(left_ts)} AS _l").selectExpr("*", f"_l DIV {width} AS _bucket")
    placed = right.selectExpr("*", f"{wall_micros(right_ts)} AS _r").selectExpr(
        "*", f"explode(array(_r DIV {width}, _r DIV {width} + 1)) AS _bucket"
    )
    near = f"_l BETWEEN _r AND _r + {width}"
    return cut.join(placed, [*on, "_bucket"], "inner").where(near).drop("_l", "_r", "_bucket")

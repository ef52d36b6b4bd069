"""Rules that hold from a date: joins by key and date, checks and edits of versions.

A version holds from ``valid_from`` (included) to ``valid_to`` (not included); NULL means open. A row meets the
versions of its key that hold on its day. The intervals are cut at the months, so that the join is one on equality
(key and month), which Spark can hash, sort and split, with the days compared inside a month only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from marginloom.functions.calendar import as_date
from marginloom.types import texts

FROM, TO = "valid_from", "valid_to"


def is_dated(rules: DataFrame) -> bool:
    return FROM in rules.columns and TO in rules.columns


def holds_on(day: str, first: str = FROM, last: str = TO) -> str:
    """Whether a version holds on a day, as SQL text."""
    return f"(({first} IS NULL OR {first} <= {day}) AND ({last} IS NULL OR {day} < {last}))"


def rules_on(rules: DataFrame, day: dt.date | str) -> DataFrame:
    """The versions of one day, as a table without dates."""
    return rules.where(holds_on(as_date(day))).drop(FROM, TO)


def in_force(rules: DataFrame, rows: DataFrame, day: str) -> DataFrame:
    """Versions that hold on any day of ``rows``, with open ends closed at its first and last day.

    Two dates are read from ``rows``, within the same query.
    """
    bounds = rows.agg(F.expr(f"struct(min({day}) AS lo, date_add(max({day}), 1) AS hi) AS bounds"))
    others = [f"`{c}`" for c in rules.columns if c not in (FROM, TO)]
    closed = rules.withColumn("_b", bounds.scalar()).selectExpr(
        *others, f"greatest({FROM}, _b.lo) AS {FROM}", f"least({TO}, _b.hi) AS {TO}"
    )
    return closed.where(f"{FROM} < {TO}")


def _month(day: str) -> str:
    return f"(year({day}) * 12 + month({day}))"


def join_valid(rows: DataFrame, rules: DataFrame, on: list[str], day: str, how: str = "inner", closed: bool = False) -> DataFrame:
    """``rows`` with the columns of the versions that hold on their ``day``; ``on``: columns both have.

    ``how``: inner, left, left_semi or left_anti. A row meets each version that holds, so overlapping versions
    (``overlapping_versions`` finds them) repeat it. NULL keys and days meet none. ``closed``: the versions come from
    ``in_force`` already, so the days of ``rows`` needn't be read for it.
    """
    bounded = rules if closed else in_force(rules, rows, day)
    others = [c for c in rules.columns if c not in (*on, FROM, TO)]
    months = f"explode(sequence({_month(FROM)}, {_month(f'date_sub({TO}, 1)')})) AS _month"
    keys = [f"`{c}` AS _key{i}" for i, c in enumerate(on)]
    # an empty interval would be a sequence that runs backwards
    cut = bounded.where(f"{FROM} < {TO}").selectExpr(*keys, *[f"`{c}`" for c in others], f"{FROM} AS _from", f"{TO} AS _to", months)
    same = [f"`{c}` = _key{i}" for i, c in enumerate(on)]
    met = F.expr(" AND ".join([*same, f"{_month(day)} = _month", f"{day} >= _from", f"{day} < _to"]))
    joined = rows.join(cut, met, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("_from", "_to", "_month", *[f"_key{i}" for i in range(len(on))])


def join_rules(rows: DataFrame, rules: DataFrame, on: list[str], how: str, day: str) -> DataFrame:
    """A join of rules with or without dates; dated ones come from ``in_force``."""
    return join_valid(rows, rules, on, day, how, closed=True) if is_dated(rules) else rows.join(rules, on, how)


def overlapping_versions(rules: DataFrame, key: tuple[str, ...] = ("type", "key", "channel")) -> DataFrame:
    """Versions that begin before an earlier one of the same key has ended: key, the day, when the earlier one ends.

    Empty and reversed intervals hold on no day and overlap nothing.
    """
    earlier = Window.partitionBy(*key).orderBy(F.expr(f"coalesce({FROM}, DATE'0001-01-01')"), TO).rowsBetween(Window.unboundedPreceding, -1)
    proper = rules.where(f"{FROM} IS NULL OR {TO} IS NULL OR {FROM} < {TO}")
    open_end = f"coalesce({TO}, DATE'9999-12-31')"
    ends = proper.withColumn("held_until", F.max(F.expr(open_end)).over(earlier))
    found = ends.where(f"held_until > coalesce({FROM}, DATE'0001-01-01')")
    return found.selectExpr(*key, f"{FROM} AS overlaps_from", "nullif(held_until, DATE'9999-12-31') AS held_until")


def share_sums_over_time(rules: DataFrame, types: list[str]) -> DataFrame:
    """Spans of days on which the shares of an account don't sum to one: type, key, valid_from, valid_to, total.

    Spans between two versions on which nothing holds are there too, with total 0; days before the first and after
    the last version are not. Each version adds its value on its first day and takes it back on its last: the sum of
    a day is a running sum over the days on which something changes.
    """
    listed = rules.where(f"type IN ({texts(types)}) AND ({FROM} IS NULL OR {TO} IS NULL OR {FROM} < {TO})")
    start, end = f"coalesce({FROM}, DATE'0001-01-01')", f"coalesce({TO}, DATE'9999-12-31')"
    value = "coalesce(value, 0)"
    changes = f"array(struct({start} AS day, {value} AS step), struct({end} AS day, -{value} AS step))"
    days = listed.selectExpr("type", "key", f"inline({changes})").groupBy("type", "key", "day").agg(F.sum("step").alias("step"))
    order = Window.partitionBy("type", "key").orderBy("day")
    spans = days.select(
        "type",
        "key",
        "day",
        F.lead("day").over(order).alias("until"),
        F.sum("step").over(order).alias("total"),
    )
    spans = spans.where("until IS NOT NULL AND total <> 1")
    first, last = f"nullif(day, DATE'0001-01-01') AS {FROM}", f"nullif(until, DATE'9999-12-31') AS {TO}"
    return spans.selectExpr("type", "key", first, last, "total")


def revise_rules(rules: DataFrame, changes: DataFrame, day: dt.date | str) -> DataFrame:
    """``rules`` with ``changes`` (the same columns without dates) in force from ``day`` on; earlier days keep theirs.

    For each (type, key) in ``changes`` versions that hold on the day end there, later ones go, and the changed rows
    begin. Other keys stay as they are.
    """
    start = as_date(day)
    changed = changes.selectExpr("type AS _type", "key AS _key").distinct()
    same = F.expr("type = _type AND key = _key")
    marked = rules.join(changed, same, "left")
    touched = f"_type IS NOT NULL AND ({TO} IS NULL OR {TO} > {start})"
    others = [f"`{c}`" for c in rules.columns if c not in (FROM, TO)]
    past = marked.where(f"NOT ({touched} AND {FROM} IS NOT NULL AND {FROM} >= {start})").selectExpr(
        *others, FROM, f"if({touched}, {start}, {TO}) AS {TO}"
    )
    return past.unionByName(changes.selectExpr(*others, f"{start} AS {FROM}", f"CAST(NULL AS DATE) AS {TO}"))

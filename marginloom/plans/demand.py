"""Planned demand of any closed range of days, without a row per day.

A SKU's plan is a step function: each month has a daily rate. ``plan_curve`` keeps, per SKU, its months with the
rate and the running sum of all months before; the demand up to a day is then one lookup of the last month that
has begun, and a range of days is the difference of two lookups. A curve has one entry per planned month, so its
length is bounded by the calendar, and results equal the sum over ``daily_plan`` to the last digit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from marginloom.functions.calendar import as_date
from marginloom.plans.inventory import COVERAGE_DAYS, STOCK, Day, rate_per_day
from marginloom.types import TOTAL_QUANTITY, cast


def plan_curve(plan: DataFrame) -> DataFrame:
    """Per SKU its ``curve``: planned months in order, each with its daily rate and the quantity of the months before.

    Several plan rows of one month add up; rows without a quantity plan nothing.
    """
    rates = plan.where("planned_qty IS NOT NULL AND plan_month IS NOT NULL").selectExpr(
        "sku", "trunc(plan_month, 'month') AS month", f"{rate_per_day()} AS rate"
    )
    monthly = rates.groupBy("sku", "month").agg(F.expr(f"{cast('sum(rate)', TOTAL_QUANTITY)} AS rate"))
    earlier = Window.partitionBy("sku").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    in_month = f"{cast('rate * day(last_day(month))', TOTAL_QUANTITY)} AS in_month"
    sums = monthly.selectExpr("sku", "month", "rate", in_month).withColumn("before", F.sum("in_month").over(earlier))
    entry = f"struct(month, {cast('coalesce(before, 0)', TOTAL_QUANTITY)} AS before, rate)"
    return sums.groupBy("sku").agg(F.expr(f"array_sort(collect_list({entry})) AS curve"))


def planned_until(day: str, curve: str = "curve") -> str:
    """Demand from the first planned day to the end of ``day``, as SQL text."""
    begun = f"try_element_at(filter({curve}, c -> c.month <= {day}), -1)"
    days = f"datediff(least({day}, last_day(e.month)), e.month) + 1"
    return f"coalesce(get(transform(array({begun}), e -> e.before + e.rate * ({days})), 0), 0)"


def planned_between(first: str, last: str, curve: str = "curve") -> str:
    """Demand of the days from ``first`` to ``last``, both included; zero if the range is empty or has no plan."""
    gap = f"{planned_until(last, curve)} - {planned_until(f'date_sub({first}, 1)', curve)}"
    return cast(f"if({first} <= {last}, {gap}, 0)", TOTAL_QUANTITY)


def has_plan(first: str, last: str, curve: str = "curve") -> str:
    """Whether any day of the range is planned."""
    return f"exists({curve}, c -> c.month <= {last} AND last_day(c.month) >= {first})"


def ytd_plan_of(curve: DataFrame, fy_start: dt.date | str, as_of: Day = None) -> DataFrame:
    """``ytd_plan`` from the curve: planned quantity per SKU from the start of the year to the reporting date."""
    days = as_date(fy_start), as_date(as_of)
    return curve.where(has_plan(*days)).selectExpr("sku", f"{planned_between(*days)} AS ytd_plan_qty")


def coverage_windows_of(
    stock: DataFrame, curve: DataFrame, as_of: Day = None, days: tuple[int, ...] = COVERAGE_DAYS
) -> DataFrame:
    """``coverage_windows`` from the curve: planned demand of the next days (today included) beside the stock."""
    today = as_date(as_of)
    last = {n: f"date_add({today}, {n - 1})" for n in days}
    asked = curve.where(has_plan(today, last[max(days)])).selectExpr(
        "sku", *[f"{planned_between(today, day)} AS plan_{n}d" for n, day in last.items()]
    )
    return stock.join(asked, "sku", "inner").select("sku", "item_name", *STOCK, *[f"plan_{n}d" for n in days])


def coverage_range_of(
    stock: DataFrame, curve: DataFrame, actuals: DataFrame, plan: DataFrame, first: dt.date | str, last: dt.date | str
) -> DataFrame:
    """``coverage_range_pivot`` from the curve: demand of the chosen days, stock, year-to-date figures, what is left."""
    days = as_date(first), as_date(last)
    asked = curve.where(has_plan(*days)).selectExpr("sku", f"{planned_between(*days)} AS range_plan_qty")
    joined = stock.join(asked, "sku", "inner").join(actuals, "sku", "left").join(plan, "sku", "left")
    columns = ["sku", "item_name", *STOCK, "ytd_actual_qty", "ytd_plan_qty", "range_plan_qty"]
    return joined.selectExpr(*columns, "on_hand + in_transit - range_plan_qty AS left_after_range")


def with_planned_demand(rows: DataFrame, curve: DataFrame, first: str, last: str, out: str = "planned_qty") -> DataFrame:
    """``rows`` (with a column sku) and the planned demand of each row's own range of days.

    ``first`` and ``last`` are SQL texts over the rows' columns. Two lookups a row, whatever the length of the range;
    a SKU without a plan, and a row without one of its days, has zero. The curve has one row per SKU, so the join
    never multiplies rows.
    """
    mine = curve.selectExpr("sku AS _sku", "curve AS _curve")
    joined = rows.join(mine, F.expr("sku = _sku"), "left")
    value = f"coalesce({planned_between(first, last, '_curve')}, 0)"
    return joined.selectExpr(*[f"`{c}`" for c in rows.columns], f"{cast(value, TOTAL_QUANTITY)} AS {out}")

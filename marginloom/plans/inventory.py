"""Stock, demand plan and sales per SKU."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from marginloom.functions.calendar import as_date
from marginloom.operators.report import pivot_report
from marginloom.types import QUANTITY, TOTAL_QUANTITY, cast, quantity, texts

# Order states that do not count as sales.
EXCLUDED_STATUS = ["void", "draft", "pending_approval", "approved"]
# Coverage windows in days, today included.
COVERAGE_DAYS = (28, 42, 56)

Day = dt.date | str | None
STOCK = ["on_hand", "in_transit", "external_inv"]


def _tracked(df: DataFrame, skus: list[str] | DataFrame | None) -> DataFrame:
    """Rows of the tracked SKUs: a short list is a filter at the scan, a table a semi join."""
    if skus is None:
        return df
    if isinstance(skus, DataFrame):
        return df.join(skus.select("sku").distinct(), "sku", "left_semi")
    return df.where(f"sku IN ({texts(skus)})")


def _sum_by_sku(df: DataFrame, value: str, out: str) -> DataFrame:
    return df.groupBy("sku").agg(F.expr(f"{cast(f'sum({value})', TOTAL_QUANTITY)} AS {out}"))


def sales_order_lines(
    order_items: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    skus: list[str] | DataFrame | None = None,
    excluded_status: list[str] = EXCLUDED_STATUS,
    min_year: int = 2025,
) -> DataFrame:
    """Order lines of the tracked SKUs; a line repeats for every SKU that shares its item name.

    The first year is a date bound, which the scan can use.
    """
    counted = orders.where(f"status NOT IN ({texts(excluded_status)}) AND order_date >= DATE'{min_year}-01-01'")
    products = _tracked(items, skus).select("sku", "item_name")
    return (
        order_items.join(counted, "sales_order_id", "inner")
        .join(products, "item_name", "inner")
        .selectExpr(
            "sales_order_no AS so_number",
            "status AS so_status",
            "sku",
            "item_name",
            f"{quantity('quantity')} AS quantity",
            "order_date",
        )
    )


def stock_on_hand(stock: DataFrame, skus: list[str] | DataFrame | None = None) -> DataFrame:
    """Stock per SKU and item name over all warehouses; negative stock is pre-sold."""
    sums = {"on_hand": "quantity_available", "external_inv": "external_inv", "in_transit": "transit_inv"}
    return (
        _tracked(stock, skus)
        .groupBy("sku", "item_name")
        .agg(*[F.expr(f"sum({quantity(source)}) AS {out}") for out, source in sums.items()])
    )


def sales_vs_plan(plan: DataFrame, lines: DataFrame) -> DataFrame:
    """Planned and sold quantity per SKU and plan month; months without sales show zero.

    Sales are summed to SKU and month before the join; a plan row given twice counts its
    sales twice, as the row-level join does.
    """
    monthly = lines.selectExpr("sku", "trunc(order_date, 'month') AS _month", "quantity")
    sold = monthly.groupBy("sku", "_month").agg(F.expr("sum(quantity) AS _sold"))
    planned = plan.groupBy("sku", "plan_month", "planned_qty").agg(F.expr("count(*) AS _copies"))
    return (
        planned.selectExpr("*", "trunc(plan_month, 'month') AS _month")
        .join(sold, ["sku", "_month"], "left")
        .selectExpr(
            "sku",
            "plan_month AS month",
            f"{quantity('planned_qty')} AS plan_qty",
            f"coalesce({cast('_sold * _copies', TOTAL_QUANTITY)}, 0) AS actual_qty",
        )
    )


def ytd_actuals(lines: DataFrame, fy_start: dt.date | str, as_of: Day = None) -> DataFrame:
    """Sold quantity per SKU from the start of the fiscal year to the reporting date."""
    in_year = lines.where(f"order_date BETWEEN {as_date(fy_start)} AND {as_date(as_of)}")
    return _sum_by_sku(in_year, "quantity", "ytd_actual_qty")


def sold_by_day(lines: DataFrame) -> DataFrame:
    """Sold quantity per SKU and day; days can be summed by themselves, and ``ytd_actuals`` reads them like lines."""
    return lines.groupBy("sku", "order_date").agg(F.expr(f"{cast('sum(quantity)', TOTAL_QUANTITY)} AS quantity"))


def ytd_plan(daily: DataFrame, fy_start: dt.date | str, as_of: Day = None) -> DataFrame:
    """Planned quantity per SKU from the start of the fiscal year to the reporting date."""
    in_year = daily.where(f"plan_date BETWEEN {as_date(fy_start)} AND {as_date(as_of)}")
    return _sum_by_sku(in_year, "daily_plan_qty", "ytd_plan_qty")


def next_months_plan(plan: DataFrame, as_of: Day = None, months: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Planned quantity per SKU of the coming calendar months."""
    coming = ", ".join(f"trunc(add_months({as_date(as_of)}, {n}), 'month')" for n in months)
    return _sum_by_sku(plan.where(f"trunc(plan_month, 'month') IN ({coming})"), "planned_qty", "next_plan_qty")


def rate_per_day() -> str:
    """A monthly plan row's quantity for each day of its month."""
    return cast(f"round({cast(quantity('planned_qty'), 'DOUBLE')} / day(last_day(plan_month)), 6)", QUANTITY)


def daily_plan(plan: DataFrame) -> DataFrame:
    """The monthly plan spread evenly over the days of its month."""
    days = "sequence(trunc(plan_month, 'month'), last_day(plan_month))"
    return plan.selectExpr("sku", f"explode({days}) AS plan_date", f"{rate_per_day()} AS daily_plan_qty")


def inventory_coverage(stock: DataFrame, next_plan: DataFrame) -> DataFrame:
    """Stock beside the coming months' plan; the plan is NULL where there is none."""
    return stock.join(next_plan, "sku", "left").select("sku", "item_name", *STOCK, "next_plan_qty")


def with_coverage_status(coverage: DataFrame) -> DataFrame:
    """Adds total available and Sufficient / Shortfall (also Shortfall without a plan)."""
    return coverage.selectExpr(
        "*",
        "on_hand + in_transit AS total_available",
        "if(on_hand + in_transit >= next_plan_qty, 'Sufficient', 'Shortfall') AS coverage_status",
    )


def sku_performance(coverage: DataFrame, actuals: DataFrame, plan: DataFrame) -> DataFrame:
    """Coverage with year-to-date sales and plan, zero where there is none."""
    joined = coverage.join(actuals, "sku", "left").join(plan, "sku", "left")
    filled = [f"coalesce({c}, {cast('0', TOTAL_QUANTITY)}) AS {c}" for c in ("ytd_actual_qty", "ytd_plan_qty")]
    return joined.selectExpr(*coverage.columns, *filled)


def coverage_by_day(stock: DataFrame, daily: DataFrame) -> DataFrame:
    """Stock beside each planned day."""
    return stock.join(daily, "sku", "inner").select("sku", "item_name", *STOCK, "plan_date", "daily_plan_qty")


def coverage_windows(
    stock: DataFrame, daily: DataFrame, as_of: Day = None, days: tuple[int, ...] = COVERAGE_DAYS
) -> DataFrame:
    """Planned demand of the next days (today included) per window, beside the stock.

    The plan is summed per SKU before it meets the stock.
    """
    today = as_date(as_of)
    sums = [
        f"coalesce(sum(daily_plan_qty) FILTER (WHERE plan_date < date_add({today}, {n})), 0) AS plan_{n}d" for n in days
    ]
    coming = daily.where(f"plan_date >= {today} AND plan_date < date_add({today}, {max(days)})")
    demand = coming.groupBy("sku").agg(*[F.expr(s) for s in sums])
    return stock.join(demand, "sku", "inner").select("sku", "item_name", *STOCK, *[f"plan_{n}d" for n in days])


def coverage_by_day_ytd(by_day: DataFrame, actuals: DataFrame, plan: DataFrame) -> DataFrame:
    """Coverage by day with year-to-date sales and plan, NULL where there is none."""
    return by_day.join(actuals, "sku", "left").join(plan, "sku", "left")


def sales_vs_plan_pivot(compared: DataFrame, months: list[str]) -> DataFrame:
    """SKU by month of ``sales_vs_plan``: planned and sold quantity of each month (``yyyy-MM``) side by side."""
    rows = compared.selectExpr("sku", "date_format(month, 'yyyy-MM') AS month", "plan_qty", "actual_qty")
    return pivot_report(rows, ["sku"], "month", months, {"plan": "plan_qty", "actual": "actual_qty"})


def coverage_range_pivot(by_day: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Per SKU and item name the demand of the chosen days beside stock and year-to-date figures, and what is left.

    Stock and year-to-date figures repeat on every day of ``coverage_by_day_ytd``, so they are taken once.
    """
    chosen = by_day.where(f"plan_date BETWEEN {as_date(first)} AND {as_date(last)}")
    once = [*STOCK, "ytd_actual_qty", "ytd_plan_qty"]
    summed = chosen.groupBy("sku", "item_name").agg(
        *[F.expr(f"max({c}) AS {c}") for c in once], F.expr("sum(daily_plan_qty) AS range_plan_qty")
    )
    return summed.selectExpr("*", "on_hand + in_transit - range_plan_qty AS left_after_range")

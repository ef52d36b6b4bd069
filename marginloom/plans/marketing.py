"""Weekly advertising spend, and invoice lines beside spend, payments and deals."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F

from marginloom.functions.calendar import (
    as_date,
    in_later_week,
    slash_date,
    week_end,
    week_key,
    week_number,
    week_start,
    week_text,
)
from marginloom.functions.channels import OrderRules, order_channel, order_channel_legacy, paid_status
from marginloom.functions.text import name_segment
from marginloom.operators.joins import exclude_keep_null, unfilled_scaffold
from marginloom.operators.report import is_first, newest_first, same_group, smallest_ids
from marginloom.staging import staged, staged_together
from marginloom.types import TOTAL_MONEY, cast, money, text, texts

# Fixed value: exchange rate of platform spend.
USD_TO_CAD = "1.35"
# Dealer account types, left out of the KPIs.
DEALER_TYPES = ["Dealer - Bronze", "Dealer - Gold", "Dealer - Silver", "Dealer - Standard"]
CLOSED = "Closed"
# Rows up to which a weekly table, whose rows are counted, is broadcast: some ten megabytes.
FEW_WEEKLY_ROWS = 100_000

SPEND = ["fb_usd", "fb_cad", "google_usd", "google_cad", "other_cad"]
CAD = ["fb_cad", "google_cad", "other_cad"]
Day = dt.date | str | None


def _spend_rows(df: DataFrame, name: str, channel: str, category: str, filled: dict[str, str]) -> DataFrame:
    """The common spend schema: given amounts, zero in the others."""
    amounts = [f"{cast(filled.get(c, '0'), TOTAL_MONEY)} AS {c}" for c in SPEND]
    return df.selectExpr(
        "year_week", f"{name} AS name", f"{channel} AS channel", f"{category} AS product_category", *amounts
    )


def _hashed(keyed: DataFrame) -> DataFrame:
    """A side as large as the orders, with few rows per key: its partitions are hashed, so that neither side is sorted."""
    return keyed.hint("shuffle_hash")


def _up_to(rows: DataFrame, day: str, last: Day) -> DataFrame:
    """``rows`` without the days of weeks after that of ``last``; all of them if none is given."""
    return rows if last is None else rows.where(f"NOT {in_later_week(day, as_date(last))}")


def _platform_spend(
    names: DataFrame, name_id: str, name: str, costs: DataFrame, cost_id: str, day: str, cost: str, last: Day
) -> DataFrame:
    """Weekly cost of one platform per ad name: one grouping, combined on the map side."""
    spent = _up_to(costs, day, last).where(f"{cost} > 0").selectExpr(
        f"{cost_id} AS _ad", f"{week_number(day)} AS _week", f"{money(cost)} AS _cost"
    )
    named = names.selectExpr(f"{name_id} AS _ad", f"{name} AS name")
    weekly = spent.join(named, "_ad", "inner").groupBy("_week", "name").agg(F.expr("sum(_cost) AS usd"))
    return weekly.selectExpr(f"{week_text('_week')} AS year_week", "name", "usd")


def ad_spend(
    fb_sets: DataFrame,
    fb_insights: DataFrame,
    g_campaigns: DataFrame,
    g_performance: DataFrame,
    other: DataFrame,
    fx: str = USD_TO_CAD,
    last: Day = None,
) -> DataFrame:
    """Weekly spend of both platforms per ad name, and the manual spend rows as they are.

    With ``last``, days of the platforms that lie in a later week may be left out: a table that ends with the week of
    that day needn't read their costs.
    """
    fb = _platform_spend(fb_sets, "id", "name", fb_insights, "adset_id", "reporting_starts", "amount_spent", last)
    google = _platform_spend(g_campaigns, "campaign_id", "campaign", g_performance, "campaign_id", "day", "costs", last)
    usd, cad = "round(usd, 2)", f"round(usd * {fx}, 2)"
    parsed = "name", name_segment("name", 1), name_segment("name", 2)
    manual = other.where("spending_cad > 0")
    return (
        _spend_rows(fb, *parsed, {"fb_usd": usd, "fb_cad": cad})
        .unionByName(_spend_rows(google, *parsed, {"google_usd": usd, "google_cad": cad}))
        .unionByName(
            _spend_rows(
                manual, "channel", "channel", "product_category", {"other_cad": f"round({money('spending_cad')}, 2)"}
            )
        )
    )


def _sums(columns: list[str]) -> list:
    return [F.expr(f"sum({c}) AS {c}") for c in columns]


def spend_by_category(spend: DataFrame) -> DataFrame:
    """Spend per week and category; the total covers both platforms, not the manual spend."""
    return (
        spend.groupBy("year_week", "product_category")
        .agg(*_sums(SPEND[:4]))
        .selectExpr(
            "year_week",
            "product_category AS item_category",
            "fb_cad AS fb_spend_cad",
            "google_cad AS google_spend_cad",
            "fb_cad + google_cad AS total_spend_cad",
            "fb_usd AS fb_spend_usd",
            "google_usd AS google_spend_usd",
        )
    )


def spend_by_channel(spend: DataFrame) -> DataFrame:
    """Spend in CAD per week and channel."""
    return spend.groupBy("year_week", "channel").agg(*_sums(CAD))


def _scaffold(bounds: DataFrame, channels: list[str]) -> DataFrame:
    weeks = f"sequence({week_start('first')}, last, INTERVAL 7 DAYS)"
    return (
        bounds.selectExpr(f"explode({weeks}) AS week_start")
        .selectExpr("week_start", f"explode(array({texts(channels)})) AS channel")
        .selectExpr(
            f"{week_key('week_start')} AS year_week", "channel", "week_start", f"{week_end('week_start')} AS week_end"
        )
    )


def week_channel_scaffold(
    spark: SparkSession, first: dt.date | str, last: dt.date | str, channels: list[str]
) -> DataFrame:
    """One row per week from ``first`` to ``last`` and channel."""
    return _scaffold(spark.sql(f"SELECT {as_date(first)} AS first, {as_date(last)} AS last"), channels)


def scaffold_over(df: DataFrame, day: str, channels: list[str]) -> DataFrame:
    """One row per week between the first and last ``day`` found in ``df`` and channel."""
    bounds = df.selectExpr(f"CAST(min({day}) AS DATE) AS first", f"CAST(max({day}) AS DATE) AS last")
    return _scaffold(bounds, channels)


def _with_orders(links: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows with the sales order their ``_link`` names; a link to a missing order has NULL order fields."""
    return links.join(_hashed(orders), F.expr("_link = sales_order_id"), "left").drop("_link")


def closed_invoices(invoices: DataFrame, junction: DataFrame, orders: DataFrame, rules: OrderRules) -> DataFrame:
    """Closed invoices with week and channel; an invoice with several orders repeats per order.

    The links meet the closed invoices first, so only the links of those are shuffled on to the orders. Invoices
    without a link go past both joins, see ``left_join_lines``.
    """
    closed = invoices.where(f"status = {text(CLOSED)}")
    links = junction.selectExpr("invoice_id", "sales_order_id AS _link")
    numbered = orders.selectExpr("sales_order_id", "sales_order_no", "type AS sales_order_type")
    linked = _with_orders(closed.join(links, "invoice_id", "inner"), numbered)
    unlinked = closed.join(links.select("invoice_id").distinct(), "invoice_id", "left_anti")
    return linked.unionByName(unlinked, allowMissingColumns=True).selectExpr(
        "invoice_id",
        "customer_id",
        "invoice_date",
        "total",
        "balance",
        "invoice_number",
        "source",
        "source_new",
        "sales_person_id",
        "status",
        "shipping_status",
        f"{week_key('invoice_date')} AS invoice_week",
        f"{slash_date(week_start('invoice_date'))} AS invoice_date_start",
        f"{slash_date(week_end('invoice_date'))} AS invoice_date_end",
        "sales_order_id",
        "sales_order_no",
        "sales_order_type",
        f"{order_channel_legacy('sales_order_no', rules)} AS so_channel_old",
        f"{order_channel('sales_order_no', rules)} AS channel",
    )


def weekly_payments(
    payments: DataFrame,
    invoices: DataFrame,
    junction: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    rules: OrderRules,
    dealers: list[str] = DEALER_TYPES,
    last: Day = None,
) -> DataFrame:
    """Cash received per week and channel without dealers.

    A payment counts once per order of its invoice. The orders are counted per channel first,
    into one row per invoice, so payments meet one row each and are shuffled once. With ``last``, payments of weeks
    after that of the day may be left out, for a table that ends there.
    """
    channels = rules.channels()
    labelled = orders.selectExpr("sales_order_id", f"{order_channel('sales_order_no', rules)} AS _label")
    links = (
        _with_orders(junction.selectExpr("invoice_id", "sales_order_id AS _link"), labelled)
        .selectExpr("invoice_id", f"coalesce(_label, {text(rules.no_order)}) AS channel")
        .groupBy("invoice_id")
        .agg(*[F.expr(f"count_if(channel = {text(c)}) AS _n{i}") for i, c in enumerate(channels)])
    )
    counts = ", ".join(f"named_struct('channel', {text(c)}, 'links', _n{i})" for i, c in enumerate(channels))
    headers = (
        invoices.select("invoice_id", "customer_id")
        .join(_hashed(links), "invoice_id", "left")
        .join(customers.select("customer_id", "account_type"), "customer_id", "left")
        .selectExpr("invoice_id", "account_type", f"if(_n0 IS NULL, NULL, filter(array({counts}), c -> c.links > 0)) AS _orders")
    )
    received = _up_to(payments, "created_time", last).selectExpr(
        "invoice_id", f"{week_number('created_time')} AS _week", f"{money('amount')} AS _amount"
    )
    # a payment or invoice without an order counts once, under the label for that
    none = f"array(named_struct('channel', {text(rules.no_order)}, 'links', 1L))"
    return (
        received.join(_hashed(headers), "invoice_id", "left")
        .where(exclude_keep_null("account_type", dealers))
        .selectExpr("_week", "_amount", f"inline(coalesce(_orders, {none}))")
        .groupBy("_week", "channel")
        .agg(F.expr(f"{cast('sum(_amount * links)', TOTAL_MONEY)} AS paid_total"))
        .selectExpr(f"{week_text('_week')} AS year_week", "channel", "paid_total")
    )


def _with_categories(lines: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    """Invoice lines with the item and category of each."""
    return lines.join(items.selectExpr("item_id AS product_id", "sku", "category_id"), "product_id", "left").join(
        categories.select("category_id", "category_name"), "category_id", "left"
    )


def _broadcast_if_few(kept: DataFrame) -> DataFrame:
    """A staged weekly table, broadcast only if its rows, which are counted, are few.

    Beyond, Spark chooses by size and splits what is skewed.
    """
    return F.broadcast(kept) if kept.count() <= FEW_WEEKLY_ROWS else kept


def sales_and_spend(
    scaffold: DataFrame,
    closed: DataFrame,
    customers: DataFrame,
    lines: DataFrame,
    items: DataFrame,
    categories: DataFrame,
    sales_persons: DataFrame,
    spend: DataFrame,
    spend_on: dict[str, str],
    payments: DataFrame,
    deals: DataFrame,
    flag_group: list[str],
    as_of: Day = None,
    dealers: list[str] = DEALER_TYPES,
    exclude_before_join: bool = False,
    unique_flag: bool = False,
) -> DataFrame:
    """Week x channel x invoice line with spend, payments and deals (38 columns).

    ``spend``, ``payments`` and ``deals`` hold one row per key (``spend_on`` maps output
    columns to spend columns). Weeks without invoices stay; a week and channel with dealer
    invoices only is dropped, unless ``exclude_before_join`` removes the dealers first. The
    flag is set after all filters, so the flagged rows of a group carry the repeated amounts.

    Invoice lines are read once and shuffled by invoice only: they meet the headers, and what comes out is staged.
    The headers without lines, the minimum of each group and the rows themselves are read from there, the first two
    from a few of its columns. What there is per week and channel is put on the scaffold, and what there is per group
    of the flag on the minimum; both are small tables that meet the rows last, so that their amounts are neither
    shuffled nor staged with every line. Everything that is staged is computed when this function is called.
    """
    week_and_channel = ["year_week", "channel"]
    per_cell = set(spend_on) == set(week_and_channel)
    total = f"{' + '.join(CAD)} AS total_spend"
    spent = spend.selectExpr(*[f"{c} AS _{c}" for c in spend_on.values()], *CAD, total)
    on_spend = reduce(and_, [F.col(c) == F.col(f"_{s}") for c, s in spend_on.items()])
    ended = f"year_week <= {week_key(as_date(as_of))}"
    buyers = customers.select("customer_id", "contact_type", "account_type")
    sellers = sales_persons.selectExpr("sales_person_id", "name AS sales_person")
    keyed = (
        closed.withColumnRenamed("invoice_week", "year_week")
        .where(f"NOT {in_later_week('invoice_date', as_date(as_of))} AND {ended}")
        .withColumn("paid_status", F.expr(paid_status("total", "balance")))
        .join(buyers, "customer_id", "left")
        .join(sellers, "sales_person_id", "left")
        .drop("customer_id", "sales_person_id", "total", "balance")
    )
    # staged before they are joined, or the text of the week would be built and compared on every payment and cost
    payments, deals, spent, keyed = staged_together(
        {"weekly-payments": payments, "weekly-deals": deals, "weekly-spend": spent, "closed-invoices": keyed}
    )
    cells = (
        scaffold.where(ended)
        .select(*week_and_channel, "week_start", "week_end")
        .join(payments, week_and_channel, "left")
        .join(deals, week_and_channel, "left")
    )
    if per_cell:
        cells = cells.join(spent, on_spend, "left").drop(*[f"_{c}" for c in spend_on.values()])
    cells = _broadcast_if_few(staged(cells, "weekly-cells"))
    retail = keyed.where(exclude_keep_null("account_type", dealers))
    headers = retail.join(cells.select(*week_and_channel), week_and_channel, "left_semi")
    empty_cells = unfilled_scaffold(cells, retail if exclude_before_join else keyed, week_and_channel)

    line = lines.selectExpr(
        "invoice_id", "product_id", "item_id", "item_name", "quantity", "total AS item_total", "warehouse_id"
    )
    # an inner join, of which adaptive execution splits a hot invoice; headers are hashed, so that lines aren't sorted
    sold = _hashed(headers).join(line, "invoice_id", "inner")
    unique_by = ["invoice_id", "sales_order_id", "product_id"] if unique_flag else None
    unread = ["category_id"] if unique_flag else ["category_id", "product_id"]
    sold = staged(_with_categories(sold, items, categories).drop(*unread), "sold-lines")
    # few as a rule, staged because the rows are computed twice, once to find the ranges they are sorted in
    unsold = headers.join(_hashed(sold.select("invoice_id").distinct()), "invoice_id", "left_anti")

    groups = smallest_ids(sold, flag_group, "item_id", unique_by)
    if not per_cell:
        of_group = {c: f"_g{flag_group.index(c)}" for c in spend_on}
        on_group = reduce(and_, [F.col(of_group[c]) == F.col(f"_{s}") for c, s in spend_on.items()])
        groups = groups.join(spent, on_group, "left")
    groups, unsold = staged_together({"weekly-groups": groups, "unsold-headers": unsold})
    groups = _broadcast_if_few(groups)

    flagged = (
        sold.unionByName(unsold, allowMissingColumns=True)
        .join(groups, same_group(flag_group), "left")
        # one row per week of the calendar and listed channel; a week key that two weeks share repeats
        .join(cells, week_and_channel, "inner")
        .selectExpr("*", "year_week AS invoice_week", f"{is_first('item_id', unique_by)} AS is_first_row")
        # weeks without invoices hold no item and need no group
        .unionByName(
            empty_cells.selectExpr("*", f"{paid_status('NULL', 'NULL')} AS paid_status", "0 AS is_first_row"),
            allowMissingColumns=True,
        )
    )
    return (
        flagged.selectExpr(
            "year_week",
            "invoice_week",
            f"coalesce(invoice_date_start, {slash_date('week_start')}) AS invoice_date_start",
            f"coalesce(invoice_date_end, {slash_date('week_end')}) AS invoice_date_end",
            "item_name",
            "quantity AS item_quantity",
            "item_total",
            "category_name AS item_category",
            "sales_order_no AS sales_order_number",
            "channel",
            "so_channel_old",
            "fb_cad AS fb_spend",
            "google_cad AS google_spend",
            "other_cad AS other_spend",
            "total_spend",
            "invoice_date",
            "paid_total AS total_paid",
            "sales_order_type",
            "sku AS item_sku",
            "source AS invoice_source",
            "source_new AS invoice_channel",
            "sales_person",
            "paid_status AS invoice_paid_status",
            "status AS invoice_status",
            "pipeline AS pipeline_amount",
            "weighted_pipeline AS weighted_pipeline_amount",
            "deal_count",
            "qualification_cnt",
            "closed_won_cnt AS won_cnt",
            "closed_lost_cnt AS lost_cnt",
            "contact_type AS customer_contact_type",
            "account_type AS customer_account_type",
            "invoice_number",
            "warehouse_id AS item_warehouse_id",
            "sales_order_id AS so_id",
            "invoice_id",
            "shipping_status AS invoice_shipping_status",
            "is_first_row",
        )
    )


def sales_and_spend_by_category(spend: DataFrame, **tables) -> DataFrame:
    """Invoice lines beside the spend of their week and category; flag per week and category."""
    return sales_and_spend(
        spend=spend.groupBy("year_week", "product_category").agg(*_sums(CAD)),
        spend_on={"year_week": "year_week", "category_name": "product_category"},
        flag_group=["year_week", "category_name"],
        **tables,
    )


def sales_and_spend_by_channel(spend: DataFrame, **tables) -> DataFrame:
    """Invoice lines beside the spend of their week and channel; flag per week and channel."""
    return sales_and_spend(
        spend=spend_by_channel(spend),
        spend_on={"year_week": "year_week", "channel": "channel"},
        flag_group=["year_week", "channel"],
        **tables,
    )


def newest_weeks_first(df: DataFrame) -> DataFrame:
    """The order of the weekly tables; the id columns cut a large week into sort ranges."""
    return newest_first(df, "year_week", *[c for c in ("channel", "name", "invoice_id", "item_name") if c in df.columns])

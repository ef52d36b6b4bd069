
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, TimestampNTZType, TimestampType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marginloom.functions import (  # noqa: E402
    iso_week_key,
    order_channel,
    order_channel_legacy,
    paid_status,
    slash_date,
    week_end,
    week_key,
    week_start,
)
from marginloom.operators import pivot_report  # noqa: E402
from marginloom.operators.key_repair import key_candidates, repair_keys  # noqa: E402
from marginloom.operators.validity import join_valid, overlapping_versions, share_sums_over_time  # noqa: E402
from marginloom.plans import demand as dm, inventory as inv, marketing as mk, pnl, quality as q, voice as vo  # noqa: E402
from marginloom.refresh import DaySums  # noqa: E402
from marginloom.sources.by_document import over_documents, store_by_document  # noqa: E402
from marginloom.sources.rules import rules_from_rows  # noqa: E402
from marginloom.staging import shared_folder  # noqa: E402
from marginloom.plans import delivered  # noqa: E402
from marginloom.plans.bindings import (  # noqa: E402
    AS_OF,
    CALLS_YEAR,
    CHANNELS,
    FX,
    FY_START,
    MIN_YEAR,
    ORDER_RULES,
    Sources,
)

SMOKE_DIR = "/root/testdata/sf0.001"


def portable(df: DataFrame, digits: int = 4) -> DataFrame:
    """Types two engines print alike: rounded doubles, longs, dates and times as texts."""

    def column(field) -> str:
        kind, name = field.dataType, f"`{field.name}`"
        if isinstance(kind, DecimalType):
            return f"CAST(round({name}, {digits}) AS DOUBLE) AS {name}"
        if isinstance(kind, IntegerType):
            return f"CAST({name} AS BIGINT) AS {name}"
        if isinstance(kind, DateType):
            return f"CAST({name} AS STRING) AS {name}"
        if isinstance(kind, (TimestampNTZType, TimestampType)):
            return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {name}"
        return name

    return df.selectExpr(*[column(f) for f in df.schema.fields])


# --- marketing ---


def _spend(s: Sources, last: str | None = None) -> DataFrame:
    return mk.ad_spend(s.fb_ad_sets, s.fb_insights, s.g_campaigns, s.g_performance, s.other_spend, FX, last)


def _closed(s: Sources) -> DataFrame:
    return mk.closed_invoices(s.invoices, s.sales_order_invoice, s.linked_sales_orders, ORDER_RULES)


def _payments(s: Sources, last: str | None = None) -> DataFrame:
    return mk.weekly_payments(
        s.invoice_payments, s.invoices, s.sales_order_invoice, s.linked_sales_orders, s.customers, ORDER_RULES, last=last
    )


def _scaffold(s: Sources) -> DataFrame:
    return mk.scaffold_over(s.table("orders"), "o_orderdate", CHANNELS)


def _weekly_tables(s: Sources) -> dict:
    return dict(
        scaffold=_scaffold(s),
        closed=_closed(s),
        customers=s.customers,
        lines=s.invoice_items,
        items=s.items,
        categories=s.categories,
        sales_persons=s.sales_persons,
        payments=_payments(s, AS_OF),
        deals=s.deals_weekly,
        as_of=AS_OF,
    )


def _calendar_keys(s: Sources) -> DataFrame:
    days = s.table("lineitem").selectExpr("CAST(l_shipdate AS DATE) AS day").distinct()
    return days.selectExpr(
        "day",
        f"{week_key('day')} AS year_week",
        f"{iso_week_key('day')} AS iso_year_week",
        f"{slash_date(week_start('day'))} AS week_start",
        f"{slash_date(week_end('day'))} AS week_end",
    )


def _paid_status(s: Sources) -> DataFrame:
    return s.invoices.selectExpr("invoice_id", f"{paid_status('total', 'balance')} AS paid_status")


def _order_channel(rule) -> Callable[[Sources], DataFrame]:
    return lambda s: s.linked_sales_orders.selectExpr(
        "sales_order_id", "sales_order_no", f"{rule('sales_order_no', ORDER_RULES)} AS channel"
    )


# --- inventory ---


def _lines(s: Sources) -> DataFrame:
    return inv.sales_order_lines(s.sales_order_items, s.sales_orders, s.items, s.tracked_skus, min_year=MIN_YEAR)


def _stock(s: Sources) -> DataFrame:
    return inv.stock_on_hand(s.stock_by_warehouse, s.tracked_skus)


def _daily(s: Sources) -> DataFrame:
    return inv.daily_plan(s.plan_monthly)


def _actuals(s: Sources) -> DataFrame:
    return inv.ytd_actuals(_lines(s), FY_START, AS_OF)


def _curve(s: Sources) -> DataFrame:
    return dm.plan_curve(s.plan_monthly)


def _ytd_plan(s: Sources) -> DataFrame:
    return dm.ytd_plan_of(_curve(s), FY_START, AS_OF)


def _coverage(s: Sources) -> DataFrame:
    return inv.inventory_coverage(_stock(s), inv.next_months_plan(s.plan_monthly, AS_OF))


def _plan_pivot(s: Sources) -> DataFrame:
    plan = s.plan_monthly.selectExpr("*", "date_format(plan_month, 'yyyy-MM') AS month")
    months = [f"1998-{m:02d}" for m in range(1, 7)]
    dates = ("plan_month", "1998-01-01", "1998-06-30")
    return pivot_report(plan, ["sku"], "month", months, "planned_qty", date_range=dates)


def _sales_vs_plan_pivot(s: Sources) -> DataFrame:
    months = [f"{y}-{m:02d}" for y, m in [(1997, 11), (1997, 12), *[(1998, m) for m in range(1, 11)]]]
    return inv.sales_vs_plan_pivot(inv.sales_vs_plan(s.plan_monthly, _lines(s)), months)


def _by_day_ytd(s: Sources) -> DataFrame:
    return inv.coverage_by_day_ytd(inv.coverage_by_day(_stock(s), _daily(s)), _actuals(s), _ytd_plan(s))


# --- calls ---


def _outgoing(s: Sources) -> DataFrame:
    return vo.outgoing_calls(s.agent_metrics, s.agents, s.call_logs)


def _incoming(s: Sources) -> DataFrame:
    return vo.answered_incoming(s.call_logs, s.agent_metrics, s.agents)


def _contacts(s: Sources, by_agent: bool = False) -> DataFrame:
    return vo.returning_contacts(s.call_logs, s.agent_metrics, s.agents, by_agent)


def _summary(s: Sources) -> DataFrame:
    return vo.callback_summary_of(s.call_logs, _contacts(s))


def _matched(s: Sources) -> DataFrame:
    return vo.matched_call_agents(s.call_logs, s.agent_metrics, s.agents).select(
        "log_id", "customer_number", "start_time", "agent_called_time", "agent_name"
    )


# --- profit and loss ---


def _bridge(s: Sources) -> DataFrame:
    return pnl.entity_bridge(pnl.invoice_bridge(s.invoices), s.credit_notes)


def _revenue(s: Sources) -> DataFrame:
    return pnl.channel_revenue(s.ledger, s.accounts, _bridge(s), s.rules)


def _po_cost(s: Sources) -> DataFrame:
    return pnl.channel_po_cost(s.invoice_items, s.invoices, pnl.avg_po_cost(s.po_items), s.rules)


def _shares(s: Sources) -> DataFrame:
    return pnl.revenue_shares(_revenue(s))


def _commission_shares(s: Sources) -> DataFrame:
    return pnl.revenue_shares(_revenue(s), pnl.COMMISSION_CHANNELS)


def _opex(s: Sources) -> DataFrame:
    return pnl.operating_expenses(s.ledger, s.accounts)


def _other(s: Sources) -> DataFrame:
    return pnl.other_expenses(s.ledger, s.accounts)


def _opex_static(s: Sources) -> DataFrame:
    ads = pnl.allocate_static(_opex(s), s.rules, "ad_pct")
    return ads.unionByName(pnl.allocate_static(_opex(s), s.rules, "payment_account"))


def _books(s: Sources, rules: DataFrame) -> tuple[DataFrame, ...]:
    return s.ledger, s.accounts, _bridge(s), rules, s.invoice_items, s.invoices, s.po_items


def _statement(s: Sources) -> DataFrame:
    return pnl.channel_statement(*_books(s, s.rules))


def _in_cents(s: Sources) -> DataFrame:
    return pnl.statement_in_cents(*_books(s, s.rules))


def _delivered(stack, names: list[str], table: str) -> Callable[[Sources], DataFrame]:
    """One table of a stack of which all named tables are built."""
    return lambda s: stack.build({n: getattr(s, n) for n in _sources(stack)}, names)[table]


def _refreshed_sales(s: Sources) -> DataFrame:
    """Year-to-date sales from the year's day sums, which a first import filled and a refresh brought up to date.

    The first import lacks the orders of one status, and so some days; the refresh finds and sums them.
    """
    year = _lines(s).where(f"order_date BETWEEN '{FY_START}' AND '{AS_OF}'")
    folder = f"{shared_folder(s.spark)}/sales-by-day-{uuid.uuid4().hex}"
    sums = DaySums(s.spark, folder, "order_date", inv.sold_by_day)
    sums.refresh(year.where("so_status <> 'confirmed' OR order_date >= '1998-01-01'"))
    sums.refresh(year)
    return inv.ytd_actuals(sums.read(), FY_START, AS_OF)


def _revenue_by_document(s: Sources, buckets: int = 16) -> DataFrame:
    ledger = store_by_document(s.ledger, "entity_id", buckets)
    bridge = store_by_document(_bridge(s), "entity_id", buckets, ledger.large)
    revenue = lambda rows, known, few: pnl.channel_revenue(rows, s.accounts, known, s.rules, few_documents=few)
    return over_documents(ledger, bridge, revenue)


def _invoiced_by_document(s: Sources, buckets: int = 16) -> DataFrame:
    """Per invoice with its lines: total of the header and of the lines, number of lines."""
    lines = store_by_document(s.invoice_items.selectExpr("invoice_id", "total AS line_total"), "invoice_id", buckets)
    headers = store_by_document(s.invoices.select("invoice_id", "total"), "invoice_id", buckets, lines.large)

    def totals(line: DataFrame, header: DataFrame, few: bool) -> DataFrame:
        sums = line.groupBy("invoice_id").agg(F.expr("sum(line_total) AS line_total"), F.expr("count(*) AS line_count"))
        return sums.join(F.broadcast(header) if few else header, "invoice_id", "inner")

    return over_documents(lines, headers, totals)


def _sources(stack) -> list[str]:
    read = {needed for t in stack.tables.values() for needed in t.inputs}
    return sorted(read - set(stack.tables))


def _more_rules(s: Sources) -> DataFrame:
    """The rules and some vendors of a channel that isn't one of the fixed four."""
    more = [("vendor", v, "Wholesale", None) for v in ("5", "6")]
    return s.rules.unionByName(rules_from_rows(s.spark, more))


def _pl_pivot(s: Sources, rules: DataFrame) -> DataFrame:
    statement = pnl.channel_statement(*_books(s, rules))
    return pnl.profitability_pivot(statement, "1997-01-01", "1997-12-31", pnl.report_channels(rules))


def _basic(s: Sources) -> DataFrame:
    return pnl.assign_channel_basic(s.ledger, s.accounts, s.invoices, ["2", "3"], ["4", "5"])


def _conservation(s: Sources) -> DataFrame:
    allocated = _statement(s).where(f"pl_section = '{pnl.OPERATING_EXPENSE}'")
    # shares hold 12 digits, so an account may miss its source by less than a hundredth of a cent
    checked = q.conservation(_opex(s), allocated, ["account_name"])
    return checked.selectExpr("account_name", *[f"round({c}, 4) AS {c}" for c in checked.columns[1:]])


_QUERIES: dict[str, Callable[[Sources], DataFrame]] = {
    "ad_spend_weekly": lambda s: mk.newest_weeks_first(_spend(s)),
    "spend_by_category": lambda s: mk.spend_by_category(_spend(s)),
    "spend_by_channel": lambda s: mk.spend_by_channel(_spend(s)),
    "calendar_keys": _calendar_keys,
    "order_channel": _order_channel(order_channel),
    "order_channel_legacy": _order_channel(order_channel_legacy),
    "closed_invoices": _closed,
    "weekly_payments": _payments,
    "paid_status": _paid_status,
    "week_scaffold": _scaffold,
    "sales_spend_category": lambda s: mk.newest_weeks_first(
        mk.sales_and_spend_by_category(_spend(s, AS_OF), **_weekly_tables(s))
    ),
    "sales_spend_channel": lambda s: mk.newest_weeks_first(
        mk.sales_and_spend_by_channel(_spend(s, AS_OF), **_weekly_tables(s))
    ),
    "order_lines": _lines,
    "stock_on_hand": _stock,
    "refreshed_sales": _refreshed_sales,
    "sales_vs_plan": lambda s: inv.sales_vs_plan(s.plan_monthly, _lines(s)),
    "ytd_actuals": _actuals,
    "ytd_plan": _ytd_plan,
    "next_months_plan": lambda s: inv.next_months_plan(s.plan_monthly, AS_OF),
    "daily_plan": _daily,
    "inventory_coverage": _coverage,
    "coverage_status": lambda s: inv.with_coverage_status(_coverage(s)),
    "sku_performance": lambda s: inv.sku_performance(_coverage(s), _actuals(s), _ytd_plan(s)),
    "coverage_by_day": lambda s: inv.coverage_by_day(_stock(s), _daily(s)),
    "coverage_windows": lambda s: dm.coverage_windows_of(_stock(s), _curve(s), AS_OF),
    "coverage_by_day_ytd": _by_day_ytd,
    "plan_pivot": _plan_pivot,
    "sales_vs_plan_pivot": _sales_vs_plan_pivot,
    "coverage_range_pivot": lambda s: dm.coverage_range_of(
        _stock(s), _curve(s), _actuals(s), _ytd_plan(s), "1998-06-01", "1998-08-31"
    ),
    "lead_time_demand": lambda s: dm.with_planned_demand(s.supply_lines, _curve(s), "first_day", "last_day"),
    "expand_seconds": lambda s: vo.outgoing_agent_map(s.agent_metrics, s.agents),
    "outgoing_calls": _outgoing,
    "answered_incoming": _incoming,
    "callback_agents": lambda s: vo.callback_agents_of(s.call_logs, _contacts(s, by_agent=True)),
    "callback_summary": _summary,
    "callback_report": lambda s: vo.callback_report(_summary(s), CALLS_YEAR),
    "callback_rate": lambda s: vo.callback_rate(
        vo.callback_minutes(s.call_logs, _outgoing(s), _incoming(s)), ["yr", "mth", "was_returned"]
    ),
    "tolerance_join": _matched,
    "pickup_rate": lambda s: vo.pickup_rate(s.agent_metrics, s.agents),
    "entity_bridge": _bridge,
    "channel_revenue": _revenue,
    "revenue_by_document": _revenue_by_document,
    "invoiced_by_document": _invoiced_by_document,
    "avg_po_cost": lambda s: pnl.avg_po_cost(s.po_items),
    "channel_po_cost": _po_cost,
    "revenue_shares": _shares,
    "cogs_alloc": lambda s: pnl.allocate_cogs(_revenue(s), pnl.po_cost_shares(_po_cost(s))),
    "opex_payroll": lambda s: pnl.allocate_static(_opex(s), s.rules, "payroll_pct"),
    "opex_static": _opex_static,
    "opex_commission": lambda s: pnl.allocate_commission(_opex(s), s.rules, _commission_shares(s)),
    "opex_other": lambda s: pnl.allocate_other_opex(_opex(s), s.rules, _shares(s)),
    "opex_unalloc": lambda s: pnl.tag_unallocated(_opex(s), s.rules, "unalloc_opex"),
    "other_expense": lambda s: pnl.allocate_other_expense(_other(s), s.rules, _shares(s)),
    "channel_pl": lambda s: pnl.with_net(_statement(s)),
    "channel_statement": _statement,
    "net_profit": lambda s: pnl.net_statement(*_books(s, s.rules)),
    "pl_pivot": lambda s: _pl_pivot(s, s.rules),
    "pl_pivot_wide": lambda s: _pl_pivot(s, _more_rules(s)),
    "fixed_split": lambda s: pnl.fixed_split(_opex(s), exclude=["ECONOMY Brand#6"], exclude_prefixes=("PROMO",)),
    "fixed_commission": lambda s: pnl.fixed_split(
        _opex(s), pnl.OLD_COMMISSION_SHARES, include=["ECONOMY Brand#3", "ECONOMY Brand#4"]
    ),
    "fixed_payroll": lambda s: pnl.fixed_split(
        _opex(s), pnl.OLD_PAYROLL_SHARES, include=["ECONOMY Brand#6"], include_prefixes=("PROMO",)
    ),
    "channel_basic": _basic,
    "dated_payroll": lambda s: pnl.allocate_static(_opex(s), s.dated_rules, "payroll_pct"),
    "dated_revenue": lambda s: pnl.channel_revenue(s.ledger, s.accounts, _bridge(s), s.dated_rules),
    "dated_statement": lambda s: pnl.channel_statement(*_books(s, s.dated_rules)),
    "dated_cents": lambda s: pnl.statement_in_cents(*_books(s, s.dated_rules)),
    "versions_in_force": lambda s: join_valid(s.shipped_lines, s.customer_versions.drop("type"), ["key"], "day"),
    "overlapping_versions": lambda s: overlapping_versions(s.customer_versions, ("type", "key")),
    "share_sums_over_time": lambda s: share_sums_over_time(s.customer_versions, ["payroll_pct"]),
    "pct_sum_check": lambda s: q.share_sums(s.article_rules),
    "key_format_check": lambda s: q.damaged_keys(s.order_rules),
    "key_candidates": lambda s: key_candidates(s.order_rules, s.posting_ids),
    "key_repair": lambda s: repair_keys(s.vendor_rules, s.posting_ids),
    "dup_config_check": lambda s: q.duplicate_rules(s.order_rules),
    "config_drift": lambda s: q.rule_drift(s.customer_rules("F"), s.customer_rules("O")),
    "invoice_crossref": lambda s: q.invoice_crossref(s.portal_invoices, s.invoices),
    "listed_invoices": lambda s: q.listed_invoices(s.portal_invoices, s.invoices).select("invoice_id", "invoice_number"),
    "unknown_numbers": lambda s: q.unknown_numbers(s.portal_invoices, s.invoices),
    "conservation_check": _conservation,
    "stacked_pl": _delivered(delivered.profit_and_loss(), delivered.PL_TABLES, "channel_pl"),
    "stacked_inventory": _delivered(
        delivered.inventory(FY_START, AS_OF, MIN_YEAR), delivered.INVENTORY_TABLES, "sku_performance"
    ),
    "statement_in_cents": _in_cents,
    "cents_conservation": lambda s: q.conservation(
        pnl.rounded_sources(s.ledger, s.accounts), _in_cents(s), ["pl_section", "account_name"]
    ),
}
# Ratios are compared with six digits, money with four.
_DIGITS = {"callback_rate": 6, "pickup_rate": 6, "revenue_shares": 6}


def _bound(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: portable(_QUERIES[name](Sources(spark, folder)), _DIGITS.get(name, 4))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: weekly advertising spend by category on the smoke data."""
    return _bound("spend_by_category")(spark, SMOKE_DIR)


def _has(module: str) -> bool:
    """Whether an optional part of the repository is there; errors inside it are not hidden."""
    spec = find_spec(module)
    return spec is not None and spec.origin is not None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name; each reads the tables of the given folder."""
    found = {name: _bound(name) for name in _QUERIES}
    if _has("marginloom.llm"):
        from marginloom.llm.queries import QUERIES

        found |= QUERIES
        if _has("corpus_pipeline"):
            import corpus_pipeline

            found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    """The SQL twin of every query that SQL can express."""
    from oracles import ORACLES

    found = dict(ORACLES)
    if _has("marginloom.llm"):
        from marginloom.llm.queries import ORACLES as llm_oracles

        found |= llm_oracles
        if _has("corpus_pipeline"):
            import corpus_pipeline

            if corpus_pipeline.ORACLE_SQL:
                found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found

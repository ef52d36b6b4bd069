"""The delivered tables as stacks: what each one reads."""

from __future__ import annotations

import datetime as dt

from marginloom.plans import demand as dm, inventory as inv, pnl
from marginloom.publish import Stack, Table

PL_SOURCES = ["ledger", "accounts", "invoices", "credit_notes", "invoice_items", "po_items", "rules"]
#: The tables of the profit and loss, in the order a reader goes through them.
PL_TABLES = [
    "entity_bridge",
    "channel_po_cost",
    "channel_revenue",
    "cogs_alloc",
    "opex_payroll",
    "opex_alloc",
    "opex_unalloc",
    "other_expense",
    "channel_pl",
]


def profit_and_loss() -> Stack:
    """The statement by way of its parts; the ledger is passed once for income and cost and once for expenses."""
    of_section = lambda section: lambda rows: rows.where(f"pl_section = '{section}'")
    return Stack(
        {
            "entity_bridge": Table(lambda i, c: pnl.entity_bridge(pnl.invoice_bridge(i), c), ("invoices", "credit_notes")),
            "channel_revenue": Table(pnl.channel_revenue, ("ledger", "accounts", "entity_bridge", "rules")),
            "avg_po_cost": Table(pnl.avg_po_cost, ("po_items",)),
            "channel_po_cost": Table(pnl.channel_po_cost, ("invoice_items", "invoices", "avg_po_cost", "rules")),
            "po_shares": Table(pnl.po_cost_shares, ("channel_po_cost",)),
            "revenue_shares": Table(pnl.revenue_shares, ("channel_revenue",)),
            "commission_shares": Table(lambda r: pnl.revenue_shares(r, pnl.COMMISSION_CHANNELS), ("channel_revenue",)),
            "cogs_alloc": Table(pnl.allocate_cogs, ("channel_revenue", "po_shares")),
            "expenses": Table(pnl.all_expenses, ("ledger", "accounts")),
            "opex": Table(of_section(pnl.OPERATING_EXPENSE), ("expenses",)),
            "other": Table(of_section(pnl.OTHER_EXPENSE), ("expenses",)),
            "opex_payroll": Table(lambda o, r: pnl.allocate_static(o, r, "payroll_pct"), ("opex", "rules")),
            "opex_alloc": Table(pnl.opex_alloc, ("opex", "rules", "revenue_shares", "commission_shares")),
            "opex_unalloc": Table(lambda o, r: pnl.tag_unallocated(o, r, "unalloc_opex"), ("opex", "rules")),
            "other_expense": Table(pnl.allocate_other_expense, ("other", "rules", "revenue_shares")),
            "statement": Table(
                pnl.channel_pl,
                ("channel_revenue", "cogs_alloc", "opex_payroll", "opex_alloc", "opex_unalloc", "other_expense"),
            ),
            "net": Table(pnl.net_profit, ("statement",)),
            "channel_pl": Table(lambda s, n: s.unionByName(n), ("statement", "net")),
        }
    )


INVENTORY_SOURCES = ["sales_order_items", "sales_orders", "items", "tracked_skus", "stock_by_warehouse", "plan_monthly"]
INVENTORY_TABLES = [
    "order_lines",
    "stock_on_hand",
    "sales_vs_plan",
    "ytd_actuals",
    "ytd_plan",
    "next_months_plan",
    "inventory_coverage",
    "sku_performance",
    "coverage_by_day",
    "coverage_windows",
    "coverage_by_day_ytd",
]


def inventory(fy_start: dt.date | str, as_of: dt.date | str | None = None, min_year: int = 2025) -> Stack:
    """Stock, sales and plan tables; order lines, stock and the plan's curve are computed once for all their readers."""
    return Stack(
        {
            "order_lines": Table(
                lambda i, o, p, t: inv.sales_order_lines(i, o, p, t, min_year=min_year),
                ("sales_order_items", "sales_orders", "items", "tracked_skus"),
            ),
            "stock_on_hand": Table(inv.stock_on_hand, ("stock_by_warehouse", "tracked_skus")),
            "sales_vs_plan": Table(inv.sales_vs_plan, ("plan_monthly", "order_lines")),
            "plan_curve": Table(dm.plan_curve, ("plan_monthly",)),
            "daily_plan": Table(inv.daily_plan, ("plan_monthly",)),
            "ytd_actuals": Table(lambda lines: inv.ytd_actuals(lines, fy_start, as_of), ("order_lines",)),
            "ytd_plan": Table(lambda curve: dm.ytd_plan_of(curve, fy_start, as_of), ("plan_curve",)),
            "next_months_plan": Table(lambda plan: inv.next_months_plan(plan, as_of), ("plan_monthly",)),
            "inventory_coverage": Table(inv.inventory_coverage, ("stock_on_hand", "next_months_plan")),
            "sku_performance": Table(inv.sku_performance, ("inventory_coverage", "ytd_actuals", "ytd_plan")),
            "coverage_by_day": Table(inv.coverage_by_day, ("stock_on_hand", "daily_plan")),
            "coverage_windows": Table(lambda stock, curve: dm.coverage_windows_of(stock, curve, as_of), ("stock_on_hand", "plan_curve")),
            "coverage_by_day_ytd": Table(inv.coverage_by_day_ytd, ("coverage_by_day", "ytd_actuals", "ytd_plan")),
        }
    )

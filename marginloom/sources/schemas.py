"""Schemas of the source tables. Ids are texts: they are long and must never be read as numbers."""

from __future__ import annotations

from marginloom.types import MONEY, QUANTITY

_TYPES = {
    "text": "STRING",
    "money": MONEY,
    "qty": QUANTITY,
    "date": "DATE",
    "time": "TIMESTAMP_NTZ",
    "long": "BIGINT",
}


def _table(**columns: str) -> str:
    return ", ".join(f"{name} {_TYPES[kind]}" for name, kind in columns.items())


SCHEMAS: dict[str, str] = {
    # sales
    "invoices": _table(
        invoice_id="text",
        customer_id="text",
        sales_person_id="text",
        invoice_number="text",
        invoice_date="date",
        total="money",
        balance="money",
        status="text",
        source="text",
        source_new="text",
        shipping_status="text",
        so_number="text",
    ),
    "invoice_items": _table(
        item_id="text",
        invoice_id="text",
        product_id="text",
        item_name="text",
        quantity="qty",
        total="money",
        warehouse_id="text",
    ),
    "sales_orders": _table(sales_order_id="text", sales_order_no="text", type="text", status="text", order_date="date"),
    "sales_order_items": _table(sales_order_id="text", item_name="text", quantity="qty"),
    "sales_order_invoice": _table(sales_order_id="text", invoice_id="text"),
    "invoice_payments": _table(invoice_id="text", created_time="time", amount="money"),
    "customers": _table(customer_id="text", account_type="text", contact_type="text"),
    "items": _table(item_id="text", item_name="text", sku="text", category_id="text"),
    "categories": _table(category_id="text", category_name="text"),
    "sales_persons": _table(sales_person_id="text", name="text"),
    # advertising and deals
    "fb_ad_sets": _table(id="text", name="text"),
    "fb_insights": _table(adset_id="text", reporting_starts="date", amount_spent="money"),
    "g_campaigns": _table(campaign_id="text", campaign="text"),
    "g_performance": _table(campaign_id="text", day="date", costs="money"),
    "other_spend": _table(year_week="text", channel="text", product_category="text", spending_cad="money"),
    "week_channel": _table(year_week="text", channel="text", week_start="date", week_end="date"),
    "deals_weekly": _table(
        year_week="text",
        channel="text",
        pipeline="money",
        weighted_pipeline="money",
        deal_count="long",
        qualification_cnt="long",
        closed_won_cnt="long",
        closed_lost_cnt="long",
    ),
    # stock and plan
    "stock_by_warehouse": _table(
        sku="text", item_name="text", quantity_available="qty", external_inv="qty", transit_inv="qty"
    ),
    "plan_monthly": _table(sku="text", plan_month="date", planned_qty="qty"),
    "plan_daily": _table(sku="text", plan_date="date", daily_plan_qty="qty"),
    # calls
    "call_logs": _table(
        log_id="text", call_type="text", customer_number="text", start_time="time", missed_call_returned="text"
    ),
    "agent_metrics": _table(
        calllog_id="text", agent="text", call_type="text", hangup_cause="text", agent_called_time="time"
    ),
    "agents": _table(agent_id="text", name="text"),
    # ledger
    "ledger": _table(
        account_id="text",
        entity_id="text",
        entity_type="text",
        vendor_id="text",
        transaction_date="date",
        debit_minus_credit="money",
        credit_minus_debit="money",
    ),
    "accounts": _table(account_id="text", account_name="text", account_type="text"),
    "credit_notes": _table(creditnote_id="text", sales_person_id="text"),
    "po_items": _table(product_id="text", item_price="money", quantity="qty"),
}

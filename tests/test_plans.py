"""Shape of the physical plans on the smoke data."""

import re

import pytest

import __spark_entry__ as entry
from marginloom.operators import tolerance_join
from marginloom.plans.bindings import Sources


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(query(spark, entry.SMOKE_DIR)) for name, query in entry.queries().items() if name in entry._QUERIES}


@pytest.fixture(scope="module")
def far(spark):
    """Plans with a broadcast limit so low that lines and orders are shuffled, as they would be at scale."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    names = ["sales_spend_category", "sales_spend_channel", "pl_pivot", "channel_statement", "net_profit", "callback_rate"]
    try:
        return {n: plan(entry.queries()[n](spark, entry.SMOKE_DIR)) for n in names}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_no_query_pairs_rows_without_a_key(plans):
    loops = [n for n, p in plans.items() if "NestedLoopJoin" in p or "CartesianProduct" in p]
    assert loops == []


def test_no_python_runs_on_the_rows(plans):
    assert [n for n, p in plans.items() if "Python" in p or "Pandas" in p] == []


def test_scans_read_only_needed_columns(plans):
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plans["spend_by_category"])
    assert schemas and all("l_comment" not in s and s.count(":") <= 4 for s in schemas)


def test_filters_reach_the_scan(plans):
    assert "EqualTo(l_returnflag,A)" in plans["spend_by_category"]
    assert "In(event_type" in plans["outgoing_calls"]


def test_tolerance_join_is_an_equality_join(spark):
    s = Sources(spark, entry.SMOKE_DIR)
    logs = s.call_logs.select("customer_number", "start_time")
    text = plan(tolerance_join(logs, logs.withColumnRenamed("start_time", "other"), ["customer_number"], "start_time", "other"))
    assert "_bucket" in text and "NestedLoop" not in text


def test_statement_reads_the_ledger_once_per_side(plans):
    """Income and cost once, expense once, the base of the revenue shares, invoice and purchase lines."""
    assert len(re.findall(r"FileScan parquet .*lineitem.parquet", plans["channel_statement"])) == 5


def test_first_row_flag_needs_no_window_over_rows(plans):
    assert "Window [" not in plans["sales_spend_category"] and "Window [" not in plans["sales_spend_channel"]


def scans(text, table):
    return re.findall(rf"FileScan parquet .*{table}.parquet.*", text)


@pytest.mark.parametrize("name", ["sales_spend_category", "sales_spend_channel"])
def test_invoice_lines_are_never_shuffled_by_week(far, name):
    """Whatever is exchanged by a week key is an aggregate or the scaffold, not a line with its item name."""
    lines = far[name].split("\n")
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\((year_week|_g0)#", line):
            below = lines[i + 1]
            assert "item_name" not in below and "item_total" not in below, below


@pytest.mark.parametrize("name", ["sales_spend_category", "sales_spend_channel"])
def test_invoice_lines_are_read_once(spark, name, monkeypatch):
    """Lines meet the headers in one staged join; the flag, the empty headers and the rows read that."""
    staged, together, seen = entry.mk.staged, entry.mk.staged_together, []

    def noted(df):
        seen.append(plan(df))
        return df

    monkeypatch.setattr(entry.mk, "staged", lambda df, table: staged(noted(df), table))
    monkeypatch.setattr(entry.mk, "staged_together", lambda tables: together({n: noted(df) for n, df in tables.items()}))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        seen.append(plan(entry.queries()[name](spark, entry.SMOKE_DIR)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = [s for text in seen for s in scans(text, "lineitem") if "l_linenumber" in s]
    assert len(lines) == 1
    # the others are those of payments (one) and spend
    payments = sum(len(scans(text, "lineitem")) for text in [plan(entry._payments(Sources(spark, entry.SMOKE_DIR)))])
    spend = len(scans(plan(entry._spend(Sources(spark, entry.SMOKE_DIR))), "lineitem"))
    assert sum(len(scans(text, "lineitem")) for text in seen) <= payments + spend + 3


@pytest.mark.parametrize("name", ["sales_spend_category", "sales_spend_channel"])
def test_amounts_of_a_week_are_not_staged_with_lines(spark, name, monkeypatch):
    """What the rows of a week and channel share meets the staged lines last; a day decides whether a payment is read."""
    staged, together, kept = entry.mk.staged, entry.mk.staged_together, {}

    def noted(tables):
        kept.update(tables)
        return tables

    monkeypatch.setattr(entry.mk, "staged", lambda df, table: staged(noted({table: df})[table], table))
    monkeypatch.setattr(entry.mk, "staged_together", lambda tables: together(noted(tables)))
    entry.queries()[name](spark, entry.SMOKE_DIR)
    shared = {"paid_total", "pipeline", "weighted_pipeline", "deal_count", "fb_cad", "google_cad", "other_cad", "week_start"}
    assert not shared & set(kept["sold-lines"].columns)
    # payments are cut by their day, no text of a week is built and compared on each
    filters = [line for line in plan(kept["weekly-payments"]).split("\n") if re.search(r"Filter .*l_shipdate", line)]
    assert filters and all("1998-06-22" in line and "lpad" not in line for line in filters)


def test_date_filter_of_the_pivot_reaches_the_ledger_scans(far):
    dated = [s for s in scans(far["pl_pivot"], "lineitem") if "GreaterThanOrEqual(l_shipdate" in s]
    assert len(dated) == 2  # income and cost, and expenses; not the base of the shares, which needs all dates


def test_net_profit_spreads_sums_only(far):
    """Every Generate stands above an aggregate over its ledger rows."""
    for part in far["net_profit"].split("Generate explode(")[1:]:
        assert part.index("HashAggregate") < part.index("lineitem.parquet") if "lineitem.parquet" in part else True


def test_callback_rate_reads_no_contacts(far):
    assert "_contact" not in far["callback_rate"] and "callback_agent" not in far["callback_rate"]


def test_ledger_is_not_shuffled_for_accounts_or_rules(spark):
    s = Sources(spark, entry.SMOKE_DIR)
    text = plan(entry.pnl.channel_revenue(s.ledger, s.accounts, entry._bridge(s), s.rules))
    assert len(re.findall(r"hashpartitioning\(account", text)) == 0
    assert len(re.findall(r"hashpartitioning\(vendor", text)) == 0


def test_statement_shuffles_only_by_document_and_product(spark):
    s = Sources(spark, entry.SMOKE_DIR)
    keys = set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan(entry._statement(s))))
    assert keys <= {"entity_id", "channel", "product_id", "invoice_id"}

"""Stacks: order, cycles, shared tables computed once, publishing."""

import re

import pytest

import __spark_entry__ as entry
from marginloom import publish
from marginloom.plans import delivered
from marginloom.plans.bindings import Sources
from marginloom.publish import Stack, StackError, Table


def test_order_puts_inputs_first():
    stack = Stack({n: Table(lambda *x: None, tuple(i)) for n, i in {"d": "bc", "b": "a", "c": "as", "a": "s", "z": "s"}.items()})
    assert stack.order(["d"], "s") == ["a", "b", "c", "d"]
    assert stack.order(["z", "b"], "s") == ["z", "a", "b"]
    assert stack.readers(["a", "b", "c", "d"]) == {"a": 2, "b": 1, "c": 1, "d": 0}


def test_cycles_and_missing_inputs_are_named():
    stack = Stack({n: Table(lambda *x: None, tuple(i)) for n, i in {"a": "b", "b": "c", "c": "a", "x": "y"}.items()})
    with pytest.raises(StackError, match="a reads b reads c reads a"):
        stack.order(["a"], [])
    with pytest.raises(StackError, match="x reads y"):
        stack.order(["x"], [])
    assert stack.order(["a"], ["c"]) == ["b", "a"]


@pytest.fixture(scope="module")
def books(spark, tmp_path_factory):
    """The sources of the profit and loss, each a Parquet table of its own."""
    s, home = Sources(spark, entry.SMOKE_DIR), tmp_path_factory.mktemp("books")
    for name in delivered.PL_SOURCES:
        getattr(s, name).write.parquet(f"file://{home}/{name}")
    return {name: spark.read.parquet(f"file://{home}/{name}") for name in delivered.PL_SOURCES}


def test_publishing_the_profit_and_loss_scans_the_ledger_twice(spark, books, tmp_path, monkeypatch, got):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pl LOCATION '{tmp_path}/pl'")
    plans, table, stage = [], publish.publish_table, publish.staged

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(publish, "publish_table", lambda df, name, parts: table(seen(df), name, parts))
    monkeypatch.setattr(publish, "staged", lambda df, name: stage(seen(df), name))
    names = {n: f"pl.{n}" for n in delivered.PL_TABLES}
    found = delivered.profit_and_loss().publish(books, names, {"channel_pl": ["pl_section"]})
    scans = lambda name: sum(len(re.findall(rf"FileScan [^\n]*/{name}[\],]", p)) for p in plans)
    assert scans("ledger") == 2 and scans("credit_notes") == 1 and scans("po_items") == 1
    s = Sources(spark, entry.SMOKE_DIR)
    columns = ["pl_section", "account_name", "transaction_date", "amount", "channel"]
    assert got(found["channel_pl"], *columns) == got(entry._QUERIES["channel_pl"](s), *columns)
    assert got(spark.table("pl.opex_payroll"), *columns) == got(entry._QUERIES["opex_payroll"](s), *columns)


def test_a_table_that_fails_keeps_its_old_contents(spark, tmp_path, got):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS half LOCATION '{tmp_path}/half'")
    stack = Stack(
        {
            "doubled": Table(lambda rows: rows.selectExpr("id * 2 AS id"), ("rows",)),
            "checked": Table(lambda rows: rows.selectExpr("if(id > 6, raise_error('too large'), id) AS id"), ("doubled",)),
        }
    )
    names = {"doubled": "half.doubled", "checked": "half.checked"}
    stack.publish({"rows": spark.range(3)}, names)
    with pytest.raises(Exception, match="too large"):
        stack.publish({"rows": spark.range(9)}, names)
    assert spark.table("half.doubled").count() == 9 and got(spark.table("half.checked")) == [(0,), (2,), (4,)]


def test_inventory_stack_equals_the_single_queries(spark, got):
    s = Sources(spark, entry.SMOKE_DIR)
    stack = delivered.inventory(entry.FY_START, entry.AS_OF, entry.MIN_YEAR)
    assert entry._sources(stack) == sorted(delivered.INVENTORY_SOURCES)
    found = stack.build({n: getattr(s, n) for n in delivered.INVENTORY_SOURCES}, delivered.INVENTORY_TABLES)
    for name in ("order_lines", "stock_on_hand", "sales_vs_plan", "coverage_windows", "coverage_by_day_ytd"):
        single = entry._QUERIES[name](s)
        assert got(found[name], *single.columns) == got(single)

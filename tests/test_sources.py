import pytest

from marginloom.plans import quality as q
from marginloom.sources import (
    HeaderError,
    RuleError,
    append_rules,
    load_rules,
    publish_table,
    publish_view,
    read_csv,
    read_invoice_list,
    read_table,
    replace_rules,
    rules_from_rows,
    rules_of,
)

HEADER = "Type,Key,Channel,Value,Description\n"


def test_plan_csv(spark, tmp_path, got):
    path = tmp_path / "plan.csv"
    path.write_text("SKU,Plan Month,Planned Qty\nA-1,2025-11-01,6.1\nB-1,2025-11-01,5\n")
    plan = read_csv(spark, str(path), "plan_monthly")
    assert plan.dtypes == [("sku", "string"), ("plan_month", "date"), ("planned_qty", "decimal(18,6)")]
    assert got(plan, "sku", "planned_qty") == [("A-1", 6.1), ("B-1", 5.0)]


def test_columns_are_found_by_name(spark, tmp_path, got):
    plan = tmp_path / "plan.csv"
    plan.write_text("Planned Qty,Note,sku,PLAN MONTH\n6.1,x,A-1,2025-11-01\n")
    assert got(read_csv(spark, str(plan), "plan_monthly"), "sku", "planned_qty") == [("A-1", 6.1)]
    rules = tmp_path / "rules.csv"
    rules.write_text("Type,Channel,Key,Description,Value\nvendor,Retail,123,d,\n")
    assert got(load_rules(spark, str(rules)), "type", "key", "channel") == [("vendor", "123", "Retail")]
    rules.write_text("Type,Channel,Name,Description,Value\nvendor,Retail,123,d,\n")
    with pytest.raises(HeaderError, match="key"):
        load_rules(spark, str(rules))


def test_bad_csv_value_stops_the_job(spark, tmp_path):
    path = tmp_path / "plan.csv"
    path.write_text("SKU,Plan Month,Planned Qty\nA-1,soon,6.1\n")
    with pytest.raises(Exception):
        read_csv(spark, str(path), "plan_monthly").collect()


def test_table_round_trip(spark, source, tmp_path, got):
    ledger = source("ledger", [{"account_id": "1234567890123456789", "debit_minus_credit": "1.5"}])
    ledger.write.parquet(str(tmp_path / "ledger"))
    assert got(read_table(spark, str(tmp_path / "ledger"), "ledger"), "account_id", "debit_minus_credit") == [("1234567890123456789", 1.5)]


def test_rules_file(spark, tmp_path, got):
    path = tmp_path / "rules.csv"
    path.write_text(HEADER + "salesperson,0012345678901234567,B2B,,\"A, b\"\npayroll_pct,Wages,B2B,0.306944,\n")
    rules = load_rules(spark, str(path))
    assert got(rules, "key", "channel", "value", "description") == [
        ("0012345678901234567", "B2B", None, "A, b"),
        ("Wages", "B2B", 0.306944, None),
    ]
    assert got(rules_of(rules, "payroll_pct")) == [("Wages", "B2B", 0.306944)]


def test_rules_file_with_repeated_rule_is_refused(spark, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text(HEADER + "vendor,1,Retail,,\nvendor,1,Retail,,again\n")
    with pytest.raises(RuleError, match="duplicate"):
        load_rules(spark, str(path))


def test_rules_file_with_damaged_key_is_refused(spark, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text(HEADER + "vendor,1.97995E+18,Retail,,\n")
    with pytest.raises(RuleError, match="damaged"):
        load_rules(spark, str(path))


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "rules")
    rules = rules_from_rows(spark, [("vendor", "1", "Retail", None), ("vendor", "it's", "B2B", "0.5")])
    full = rules.selectExpr("*", "'' AS description")
    replace_rules(full, path)
    replace_rules(full, path)
    assert load_rules(spark, path).count() == 2
    append_rules(full, path)
    with pytest.raises(RuleError):
        load_rules(spark, path)


def test_invoice_list_and_cross_reference(spark, source, tmp_path, got):
    path = tmp_path / "numbers.txt"
    path.write_text("INV-00001\nINV-00002 \n\nINV-00001\nINV-00009\n")
    listed = read_invoice_list(spark, str(path))
    assert listed.count() == 4
    invoices = source("invoices", [{"invoice_number": n} for n in ("INV-00001", "INV-00002", "INV-00003")])
    assert got(q.invoice_crossref(listed, invoices)) == [
        ("INV-00001", 2, True, True),
        ("INV-00002", 1, False, True),
        ("INV-00009", 1, False, False),
    ]
    assert got(q.listed_invoices(listed, invoices), "invoice_number") == [("INV-00001",), ("INV-00002",)]
    assert got(q.unknown_numbers(listed, invoices)) == [("INV-00009",)]


def test_publishing(spark, source, got):
    items = source("items", [{"item_id": "1", "sku": "A"}])
    publish_view(items, "published_items")
    assert got(spark.sql("SELECT sku FROM published_items")) == [("A",)]


def test_publish_table(spark, source, got, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pub LOCATION '{tmp_path}/pub'")
    items = source("items", [{"item_id": "1", "sku": "A"}, {"item_id": "2", "sku": "B"}])
    publish_table(items, "pub.items")
    publish_table(items.where("sku = 'B'"), "pub.items", ["category_id"])
    assert got(spark.table("pub.items"), "sku") == [("B",)]
    spark.sql("DROP TABLE pub.items")


def test_rule_checks(spark, got):
    rules = rules_from_rows(
        spark,
        [
            ("payroll_pct", "a", "B2B", "0.6"),
            ("payroll_pct", "a", "Retail", "0.3"),
            ("payroll_pct", "b", "B2B", "1"),
            ("vendor", "1.97995E+18", "Retail", None),
            ("vendor", "12", "Retail", None),
            ("vendor", "12", "Retail", None),
            ("so_prefix", "89400", "Costco", "7"),
            ("ad_pct", "c", "B2B", None),
        ],
    )
    assert got(q.share_sums(rules)) == [("ad_pct", "c", None), ("payroll_pct", "a", 0.9)]
    assert got(q.damaged_keys(rules), "key", "damage") == [("1.97995E+18", "scientific notation"), ("89400", "shorter than its length")]
    assert got(q.duplicate_rules(rules)) == [("vendor", "12", "Retail", 2)]


def test_rule_drift_counts_copies(spark, got):
    old = rules_from_rows(spark, [("vendor", "1", "Retail", None), ("vendor", "2", "B2B", None), ("vendor", "2", "B2B", None)])
    new = rules_from_rows(spark, [("vendor", "2", "B2B", None), ("commission_fee", "x", "B2B", None)])
    assert got(q.rule_drift(old, new), "type", "key", "change") == [
        ("commission_fee", "x", "added"),
        ("vendor", "1", "removed"),
        ("vendor", "2", "removed"),
    ]

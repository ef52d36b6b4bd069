"""Checks on rules, invoice lists and allocations, as DataFrames of findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marginloom.sources.rules import ADVERTISING, PAYMENT, PAYROLL, SO_PREFIX
from marginloom.types import ALLOCATED, cast, text, texts

# Rule types whose shares must sum to one.
SHARE_TYPES = [PAYROLL, ADVERTISING, PAYMENT]


def share_sums(rules: DataFrame, types: list[str] | None = SHARE_TYPES) -> DataFrame:
    """Accounts whose shares do not sum to exactly 1."""
    listed = rules if types is None else rules.where(f"type IN ({texts(types)})")
    sums = listed.groupBy("type", "key").agg(F.sum("value").alias("total"))
    return sums.where("total <> 1 OR total IS NULL")


def damaged_keys(rules: DataFrame) -> DataFrame:
    """Keys damaged by a spreadsheet: scientific notation, or a prefix shorter than its stated length."""
    scientific = r"key RLIKE '^[0-9]+([.][0-9]+)?[eE][+]?[0-9]+$'"
    short = f"type = {text(SO_PREFIX)} AND length(key) < value"
    damage = f"CASE WHEN {scientific} THEN 'scientific notation' WHEN {short} THEN 'shorter than its length' END"
    return rules.selectExpr("type", "key", "channel", f"{damage} AS damage").where("damage IS NOT NULL")


def duplicate_rules(rules: DataFrame) -> DataFrame:
    """(type, key, channel) listed more than once."""
    return rules.groupBy("type", "key", "channel").agg(F.expr("count(*) AS copies")).where("copies > 1")


def rule_drift(old: DataFrame, new: DataFrame, columns: tuple[str, ...] = ("type", "key", "channel", "value")) -> DataFrame:
    """Rules found in one version only, copies counted."""
    before, after = old.select(*columns), new.select(*columns)
    removed = before.exceptAll(after).selectExpr("*", "'removed' AS change")
    added = after.exceptAll(before).selectExpr("*", "'added' AS change")
    return removed.unionByName(added)


def invoice_crossref(listed: DataFrame, invoices: DataFrame) -> DataFrame:
    """Per listed number: how often it is listed, and whether it exists as an invoice.

    Copies are counted before the join, so each number meets the invoices once.
    """
    numbers = listed.groupBy("invoice_number").agg(F.expr("count(*) AS times_listed"))
    known = invoices.select("invoice_number").distinct().selectExpr("invoice_number", "TRUE AS known")
    return numbers.join(known, "invoice_number", "left").selectExpr(
        "invoice_number", "times_listed", "times_listed > 1 AS is_duplicate", "known IS NOT NULL AS is_known"
    )


def listed_invoices(listed: DataFrame, invoices: DataFrame) -> DataFrame:
    """Invoices that appear in the list."""
    return invoices.join(listed.select("invoice_number").distinct(), "invoice_number", "left_semi")


def unknown_numbers(listed: DataFrame, invoices: DataFrame) -> DataFrame:
    """Listed numbers without an invoice."""
    return listed.select("invoice_number").distinct().join(invoices, "invoice_number", "left_anti")


def conservation(source: DataFrame, allocated: DataFrame, keys: list[str], amount: str = "amount") -> DataFrame:
    """Per key: source amount, allocated amount and their difference."""
    total = f"sum({cast(amount, ALLOCATED)})"
    before = source.groupBy(*keys).agg(F.expr(f"{total} AS source_amount"))
    after = allocated.groupBy(*keys).agg(F.expr(f"{total} AS allocated_amount"))
    zero = cast("0", ALLOCATED)
    gap = f"coalesce(allocated_amount, {zero}) - coalesce(source_amount, {zero}) AS difference"
    return before.join(after, keys, "full").selectExpr("*", gap)

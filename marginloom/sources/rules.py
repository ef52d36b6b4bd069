"""The rules table ``type, key, channel, value, description`` that drives the P&L."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from marginloom.sources.versions import Versions
from marginloom.types import quantity, text

RULE_COLUMNS = ["type", "key", "channel", "value", "description"]

# The rule types the P&L reads.
SALESPERSON = "salesperson"
VENDOR = "vendor"
CLUB_ACCOUNT = "costco_account"
COGS_UNALLOCATED = "cogs_unalloc"
PAYROLL = "payroll_pct"
ADVERTISING = "ad_pct"
PAYMENT = "payment_account"
COMMISSION = "commission_fee"
OPEX_UNALLOCATED = "unalloc_opex"
OTHER_UNALLOCATED = "unalloc_other_exp"
SO_PREFIX = "so_prefix"
DEFAULT_CHANNEL = "default_channel"


class HeaderError(ValueError):
    """A file lacks a column or has one twice."""


def read_by_header(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """A CSV file's columns as texts, found by their names in the header, in whatever order they stand.

    Case, blanks and signs in a name don't matter (``Plan Month`` is plan_month); other columns are left out. Of a
    table with versions the latest is read.
    """
    folders = Versions(spark, path).folders() or [path]
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(folders)
    plain = [re.sub(r"[^a-z0-9]+", "_", c.strip().lower()).strip("_") for c in raw.columns]
    wrong = [c for c in columns if plain.count(c) != 1]
    if wrong:
        raise HeaderError(f"{path}: columns {wrong} are not there once each; the header has {raw.columns}")
    named = raw.toDF(*[f"c{i}" for i in range(len(plain))])
    return named.selectExpr(*[f"c{plain.index(c)} AS {c}" for c in columns])


class RuleError(ValueError):
    """The rules table would give wrong amounts."""


def dates_of(rules: DataFrame) -> list[str]:
    """The columns that say when a rule holds, if the rules have them."""
    return [c for c in ("valid_from", "valid_to") if c in rules.columns]


def rules_of(rules: DataFrame, rule_type: str, *columns: str) -> DataFrame:
    """Rules of one type; ``columns`` are the expressions wanted from key, channel and value. Dates come along."""
    return rules.where(f"type = {text(rule_type)}").selectExpr(*(columns or ("key", "channel", "value")), *dates_of(rules))


def rules_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Rules given in code as ``(type, key, channel, value)``; a local relation with known size."""
    listed = ", ".join(f"({', '.join(text(v) for v in row)})" for row in rows)
    raw = spark.sql(f"SELECT * FROM VALUES {listed} AS t(type, `key`, channel, value)")
    return raw.selectExpr("type", "key", "channel", f"{quantity('value')} AS value")


def dated_rules_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Rules given in code as ``(type, key, channel, value, valid_from, valid_to)``; None for an open end."""
    listed = ", ".join(f"({', '.join(text(v) for v in row)})" for row in rows)
    raw = spark.sql(f"SELECT * FROM VALUES {listed} AS t(type, `key`, channel, value, valid_from, valid_to)")
    dates = [f"CAST({c} AS DATE) AS {c}" for c in ("valid_from", "valid_to")]
    return raw.selectExpr("type", "key", "channel", f"{quantity('value')} AS value", *dates)


def load_dated_rules(spark: SparkSession, path: str) -> DataFrame:
    """A rules file with the columns valid from and valid to (not included; blank for open ends).

    Stops on versions of one rule that overlap, which would double amounts, and on damaged keys.
    """
    from marginloom.operators.validity import overlapping_versions
    from marginloom.plans.quality import damaged_keys

    raw = read_by_header(spark, path, [*RULE_COLUMNS, "valid_from", "valid_to"])
    blank = lambda c: f"nullif(trim({c}), '')"
    dates = [f"CAST({blank(c)} AS DATE) AS {c}" for c in ("valid_from", "valid_to")]
    rules = raw.selectExpr("type", "key", "channel", f"{quantity(blank('value'))} AS value", "description", *dates)
    doubled = overlapping_versions(rules).limit(5).collect()
    if doubled:
        raise RuleError(f"overlapping versions: {[(r['type'], r['key'], r['channel'], str(r['overlaps_from'])) for r in doubled]}")
    damaged = damaged_keys(rules).limit(5).collect()
    if damaged:
        raise RuleError(f"damaged keys: {[(r['type'], r['key']) for r in damaged]}")
    return rules


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Read and check a rules file; every key is read as text.

    Stops on duplicate rules, which would double amounts, and on keys a spreadsheet turned
    into scientific notation, which would match nothing.
    """
    from marginloom.plans.quality import damaged_keys, duplicate_rules

    raw = read_by_header(spark, path, RULE_COLUMNS)
    value = quantity("nullif(trim(value), '')")
    rules = raw.selectExpr("type", "key", "channel", f"{value} AS value", "description")
    doubled = duplicate_rules(rules).limit(5).collect()
    if doubled:
        raise RuleError(f"duplicate rules: {[(r['type'], r['key'], r['channel']) for r in doubled]}")
    damaged = damaged_keys(rules).limit(5).collect()
    if damaged:
        raise RuleError(f"damaged keys: {[(r['type'], r['key']) for r in damaged]}")
    return rules


def _write_csv(rules: DataFrame):
    return lambda folder: rules.write.option("header", True).csv(folder)


def replace_rules(rules: DataFrame, path: str) -> None:
    """Import that replaces the table: readers see the old rules until the new ones are complete.

    ``rules`` may be read from the same path. If the job fails, the old rules stay.
    """
    Versions(rules.sparkSession, path).replace(_write_csv(rules))


def append_rules(rules: DataFrame, path: str) -> None:
    """Import that adds to the table, all rows at once; repeated imports leave duplicates that ``load_rules`` reports.

    The rules need the columns of the table, in any order.
    """
    spark = rules.sparkSession
    folders = Versions(spark, path).folders()
    if folders:
        known = spark.read.option("header", True).csv(folders).columns
        if sorted(known) != sorted(rules.columns):
            raise HeaderError(f"{path} has the columns {known}, the new rules {rules.columns}")
        rules = rules.select(*[f"`{c}`" for c in known])
    Versions(spark, path).append(_write_csv(rules))

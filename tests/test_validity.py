"""Rules that hold from a date, against comparing every row with every version."""

import datetime as dt
import random

import pytest

import __spark_entry__ as entry
from marginloom.operators.validity import (
    in_force,
    join_valid,
    overlapping_versions,
    revise_rules,
    rules_on,
    share_sums_over_time,
)
from marginloom.plans import pnl
from marginloom.plans.bindings import DATED_RULE_ROWS, RULE_ROWS, Sources
from marginloom.sources.rules import RuleError, dated_rules_from_rows, load_dated_rules, rules_from_rows

DAY = dt.date(2025, 1, 1)


def day(rng, spread=400):
    return rng.choice([None, *[DAY + dt.timedelta(rng.randint(0, spread)) for _ in range(6)]])


@pytest.fixture(scope="module")
def tables(make):
    rng = random.Random(12)
    rows = [(n, rng.choice(["a", "b", "c", None]), day(rng)) for n in range(120)]
    rules = [(rng.choice(["a", "b", "d", None]), f"c{n}", day(rng), day(rng, 700)) for n in range(30)]
    rules += [("a", "open", None, None), ("b", "none", DAY, DAY), ("b", "back", DAY + dt.timedelta(9), DAY)]
    return rows, rules, make("n INT, k STRING, d DATE", rows), make("k STRING, channel STRING, valid_from DATE, valid_to DATE", rules)


def holds(rule, d):
    return d is not None and (rule[2] is None or rule[2] <= d) and (rule[3] is None or d < rule[3])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_valid(tables, got, how):
    rows, rules, frame, versions = tables
    want = []
    for n, k, d in rows:
        met = [r[1] for r in rules if k is not None and r[0] == k and holds(r, d)]
        if how in ("inner", "left"):
            want += [(n, c) for c in met or [None] * (how == "left")]
        elif bool(met) == (how == "left_semi"):
            want.append((n,))
    found = join_valid(frame, versions, ["k"], "d", how)
    assert found.columns == ["n", "k", "d", *["channel"] * (how in ("inner", "left"))]
    assert got(found, "n", *["channel"] * (how in ("inner", "left"))) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    assert join_valid(frame, in_force(versions, frame, "d"), ["k"], "d", how, closed=True).count() == len(want)


def test_join_valid_with_empty_tables(tables):
    _, _, frame, versions = tables
    assert join_valid(frame.limit(0), versions, ["k"], "d").count() == 0
    assert join_valid(frame, versions.limit(0), ["k"], "d", "left").count() == frame.count()


def test_join_is_one_on_equality(spark, tables):
    _, _, frame, versions = tables
    text = join_valid(frame, versions, ["k"], "d", "left")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


VERSIONS = [
    ("payroll_pct", "a", "B2B", "0.5", None, "2025-03-01"),
    ("payroll_pct", "a", "Retail", "0.5", None, "2025-04-01"),
    ("payroll_pct", "a", "B2B", "0.25", "2025-04-01", None),
    ("payroll_pct", "a", "Retail", "0.75", "2025-06-01", None),
    ("payroll_pct", "b", "B2B", "1", "2025-01-01", "2025-02-01"),
    ("payroll_pct", "b", "B2B", "1", "2025-03-01", "2025-05-01"),
    ("payroll_pct", "c", "B2B", "1", "2025-01-01", "2025-02-01"),
    ("payroll_pct", "c", "B2B", "1", "2025-01-15", "2025-01-20"),
    ("payroll_pct", "c", "B2B", "1", "2025-01-31", None),
    ("payroll_pct", "d", "B2B", "1", "2025-05-01", "2025-05-01"),
    ("vendor", "e", "B2B", None, None, None),
]


def test_share_sums_over_time(spark, got):
    found = share_sums_over_time(dated_rules_from_rows(spark, VERSIONS), ["payroll_pct"])
    date = dt.date.fromisoformat
    assert got(found) == [
        ("payroll_pct", "a", date("2025-03-01"), date("2025-04-01"), 0.5),
        ("payroll_pct", "a", date("2025-04-01"), date("2025-06-01"), 0.25),
        ("payroll_pct", "b", date("2025-02-01"), date("2025-03-01"), 0.0),
        ("payroll_pct", "c", date("2025-01-15"), date("2025-01-20"), 2.0),
        ("payroll_pct", "c", date("2025-01-31"), date("2025-02-01"), 2.0),
    ]


def test_overlapping_versions(spark, got):
    found = overlapping_versions(dated_rules_from_rows(spark, VERSIONS))
    date = dt.date.fromisoformat
    until = date("2025-02-01")
    assert got(found) == [("payroll_pct", "c", "B2B", date("2025-01-15"), until), ("payroll_pct", "c", "B2B", date("2025-01-31"), until)]


def test_revise_rules_keeps_the_past(spark, got):
    rules = dated_rules_from_rows(spark, VERSIONS)
    changes = rules_from_rows(spark, [("payroll_pct", "a", "B2B", "1"), ("vendor", "new", "Retail", None)])
    revised = revise_rules(rules, changes, "2025-05-01")
    columns = ("type", "key", "channel", "value")
    for d in ("2025-01-16", "2025-03-15", "2025-04-30"):
        assert got(rules_on(revised, d), *columns) == got(rules_on(rules, d), *columns)
    for d in ("2025-05-01", "2025-07-01"):
        others = rules_on(rules, d).where("key <> 'a'")
        assert got(rules_on(revised, d), *columns) == got(others.unionByName(changes), *columns)
    assert overlapping_versions(revised.where("key <> 'c'")).count() == 0


def test_load_dated_rules(spark, tmp_path, got):
    path = tmp_path / "rules.csv"
    head = "Type,Key,Channel,Value,Description,Valid From,Valid To\n"
    path.write_text(head + "payroll_pct,a,B2B,1,,,2025-02-01\npayroll_pct,a,B2B,0.5,,2025-02-01,\n")
    assert got(load_dated_rules(spark, str(path)), "value", "valid_from") == [(0.5, dt.date(2025, 2, 1)), (1.0, None)]
    path.write_text(head + "vendor,a,B2B,,,,2025-02-02\nvendor,a,B2B,,,2025-02-01,\n")
    with pytest.raises(RuleError, match="overlapping"):
        load_dated_rules(spark, str(path))


PARTS = ["channel_revenue", "channel_statement", "net_statement", "statement_in_cents"]


def part(s, name, rules):
    if name == "channel_revenue":
        return pnl.channel_revenue(s.ledger, s.accounts, entry._bridge(s), rules)
    return getattr(pnl, name)(*entry._books(s, rules))


@pytest.mark.parametrize("name", PARTS)
def test_rules_that_always_hold_give_the_undated_statement(spark, got, name):
    s = Sources(spark, entry.SMOKE_DIR)
    always = dated_rules_from_rows(spark, [(*row, None, None) for row in RULE_ROWS])
    assert got(part(s, name, always)) == got(part(s, name, s.rules))


def test_each_version_applies_to_its_own_dates(spark, got):
    """Expenses of a span of days are those of a statement by the rules of that span."""
    s = Sources(spark, entry.SMOKE_DIR)
    opex = entry._opex(s)
    dated = s.dated_rules
    assert len(DATED_RULE_ROWS) == dated.count()
    for first, last in (("1995-01-01", "1997-03-01"), ("1997-03-01", "1997-07-01"), ("1997-07-01", "1998-01-01"), ("1998-01-01", "2002-01-01")):
        span = f"transaction_date >= '{first}' AND transaction_date < '{last}'"
        then = rules_on(dated, first)
        for kind in ("payroll_pct", "ad_pct", "unalloc_opex"):
            found = pnl.allocate_static(opex, dated, kind).where(span)
            assert got(found) == got(pnl.allocate_static(opex.where(span), then, kind))
        shares = entry._shares(s)
        found = pnl.allocate_other_opex(opex, dated, shares).where(span)
        assert got(found) == got(pnl.allocate_other_opex(opex.where(span), then, shares)) and found.count() > 0
        revenue = pnl.channel_revenue(s.ledger, s.accounts, entry._bridge(s), dated).where(span)
        assert got(revenue) == got(pnl.channel_revenue(s.ledger.where(span), s.accounts, entry._bridge(s), then))

"""Largest remainders per row, against exact fractions."""

import random
import re
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
from math import floor

import pytest

import __spark_entry__ as entry
from marginloom.operators.cents import receivers_of, spread_in_cents
from marginloom.plans import pnl
from marginloom.plans.bindings import Sources

ROWS = "id INT, amount DECIMAL(18,4), receivers ARRAY<STRUCT<channel: STRING, share: DECIMAL(13,12)>>, channel STRING"


def plain(amount, takers, rest):
    """(channel, cents) of each part."""
    if not takers:
        takers = [(rest, Decimal(1))]
    if amount is None:
        return [(c, None) for c, _ in takers]
    exact = [(Fraction(amount) * 100 * Fraction(s), c) for c, s in takers]
    total = sum(Fraction(s) for _, s in takers)
    whole = Fraction(amount) * 100 * (1 if abs(total - 1) < Fraction(1, 10**9) else total)
    target = int((Decimal(whole.numerator) / Decimal(whole.denominator)).quantize(Decimal(1), ROUND_HALF_UP))
    missing = target - sum(floor(x) for x, _ in exact)
    ranked = sorted(exact, key=lambda p: (floor(p[0]) - p[0], p[1]))
    return [(c, floor(x) + (i < missing)) for i, (x, c) in enumerate(ranked)]


def test_parts_sum_to_the_rounded_amount(spark):
    rng = random.Random(1)
    third, rest = Decimal("0.333333333333"), Decimal("0.333333333334")
    sets = [
        [("B2B", third), ("Retail", third), ("Costco", rest)],
        [("b", Decimal("0.25")), ("a", Decimal("0.25")), ("c", Decimal("0.5"))],
        [("only", Decimal(1))],
        [("x", Decimal("0.1")), ("y", Decimal("0.7"))],
        [("x", Decimal("0.999999999999"))],
        [("p", Decimal(1)), ("q", Decimal(1))],
        [("z", Decimal(0)), ("y", Decimal(1))],
        [],
        None,
    ]
    amounts = [None, *map(Decimal, ("0", "0.01", "-0.01", "0.005", "-0.005", "10.004", "10.006", "99999999999999.9999", "0.0001"))]
    amounts += [Decimal(rng.randint(-10**7, 10**7)).scaleb(-4) for _ in range(40)]
    cases = [(a, t) for a in amounts for t in sets]
    df = spark.createDataFrame([(i, a, t, "old") for i, (a, t) in enumerate(cases)], ROWS)
    found = spread_in_cents(df.selectExpr("id", "amount", "receivers", "channel"), "receivers", "Rest")
    assert found.columns == ["id", "receivers", "amount", "channel"]
    got = Counter((r.id, r.channel, r.amount) for r in found.collect())
    want = Counter(
        (i, c, None if cents is None else Decimal(cents).scaleb(-2)) for i, (a, t) in enumerate(cases) for c, cents in plain(a, t, "Rest")
    )
    assert got == want
    for i, (amount, takers) in enumerate(cases):
        if amount is not None and takers in (None, *sets[:3]):
            assert sum(p * n for (k, _, p), n in got.items() if k == i) == amount.quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_receivers_leave_out_channels_without_a_share(spark):
    shares = spark.sql("SELECT * FROM VALUES ('b', 0.5BD), ('c', NULL), ('a', 0.5BD) AS t(channel, share)")
    (row,) = receivers_of(shares).collect()
    assert [r.channel for r in row.receivers] == ["a", "b"]
    assert receivers_of(shares.where("false")).first().receivers == []


def test_no_row_meets_another(spark):
    text = spread_in_cents(spark.createDataFrame([], ROWS), "receivers", "Rest")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text


def test_statement_in_cents_sums_to_every_source(spark):
    found = entry.queries()["cents_conservation"](spark, entry.SMOKE_DIR).collect()
    assert len(found) > 20 and {r.difference for r in found} == {0.0}
    statement = entry._in_cents(Sources(spark, entry.SMOKE_DIR))
    assert statement.where("amount <> round(amount, 2)").count() == 0


@pytest.mark.parametrize("columns", [["pl_section", "account_name", "transaction_date", "amount", "channel"]])
def test_statement_in_cents_is_near_the_exact_one(spark, columns):
    s = Sources(spark, entry.SMOKE_DIR)
    exact, cents = entry._statement(s), entry._in_cents(s)
    assert exact.columns == cents.columns == columns
    both = exact.groupBy("pl_section", "channel").agg({"amount": "sum", "*": "count"}).toDF("pl_section", "channel", "a", "n")
    near = cents.groupBy("pl_section", "channel").agg({"amount": "sum", "*": "count"}).toDF("pl_section", "channel", "b", "m")
    rows = both.join(near, ["pl_section", "channel"], "full").collect()
    assert rows and all(r.n == r.m and abs(r.a - r.b) <= Decimal("0.01") * r.n for r in rows)


def test_statement_computes_shares_of_revenue_once(spark):
    text = entry.queries()["cents_conservation"](spark, entry.SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    # two shares of revenue in one subquery, purchase cost in another; sources in one pass
    assert len(set(re.findall(r"scalar-subquery#\d+", text))) == 2


def test_sources_are_read_once(spark):
    s = Sources(spark, entry.SMOKE_DIR)
    text = pnl.rounded_sources(s.ledger, s.accounts)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("l_extendedprice") and text.count("Relation") == 2


def test_sole_receivers_round_like_any_other(make, spark, got):
    amounts = ["0.0049", "0.005", "-0.005", "-0.0149", "12.345", "-12.345", "99999999999999.9999", "0", None]
    rows = make("id INT, amount DECIMAL(18,4)", list(enumerate(amounts)))
    sole = "array(struct('a' AS channel, CAST(1 AS DECIMAL(13,12)) AS share))"
    beside = "array(struct('a' AS channel, CAST(1 AS DECIMAL(13,12)) AS share), struct('b' AS channel, CAST(0 AS DECIMAL(13,12)) AS share))"
    plain = got(spread_in_cents(rows, sole, "rest"), "id", "amount", "channel")
    assert plain == [r for r in got(spread_in_cents(rows, beside, "rest"), "id", "amount", "channel") if r[2] == "a"]
    assert plain == got(rows.selectExpr("id", "round(amount, 2) AS amount", "'a' AS channel"))

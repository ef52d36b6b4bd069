"""Day sums after a sync: what is written again, and that the result is that of a full run."""

import os
import random

import pytest

import __spark_entry__ as entry
from marginloom.plans import pnl
from marginloom.plans.bindings import Sources
from marginloom.refresh import DaySums, file_digests, row_digests

ROWS = "day DATE, k STRING, amount DECIMAL(18,4)"


def totals(rows):
    return rows.where("k <> 'skip'").groupBy("day", "k").agg({"amount": "sum", "*": "count"}).toDF("day", "k", "amount", "n")


def files(path):
    """Files by day, with what tells a rewritten one."""
    found = {}
    for folder, _, names in os.walk(path):
        day = os.path.basename(folder).partition("day=")[2]
        if day:
            found[day] = {(n, os.stat(f"{folder}/{n}").st_mtime_ns) for n in names if n.endswith(".parquet")}
    return found


@pytest.fixture
def rows():
    rng = random.Random(2)
    return [(f"2025-01-{d:02d}", rng.choice("ab"), rng.randint(-9, 9)) for d in range(1, 11) for _ in range(5)] + [(None, "a", 3)]


def same(got, sums, table):
    columns = ("day", "k", "amount", "n")
    assert got(sums.read(), *columns) == got(totals(table), *columns)


def test_only_changed_days_are_written(spark, make, got, tmp_path, rows):
    path = str(tmp_path / "sums")
    sums = DaySums(spark, path, "day", totals)
    table = make(ROWS, rows)
    first = sums.refresh(table)
    assert len(first.written) == 11 and first.removed == []
    same(got, sums, table)
    before = files(path)
    assert sums.refresh(table.repartition(7)) .written == [] and files(path) == before

    # a changed amount, a row more, a copy more, a day without sums, a day gone, a new day, no day
    changed = [r for r in rows if r[0] != "2025-01-08"]
    changed[0] = (*changed[0][:2], 100)
    changed += [("2025-01-03", "c", 1), next(r for r in rows if r[0] == "2025-01-05"), ("2025-01-20", "a", 4), (None, "b", 1)]
    changed = [(d, "skip", a) if d == "2025-01-06" else (d, k, a) for d, k, a in changed]
    table = make(ROWS, changed)
    second = sums.refresh(table)
    assert second.written == ["2025-01-01", "2025-01-03", "2025-01-05", "2025-01-06", "2025-01-20", None]
    assert second.removed == ["2025-01-08"]
    same(got, sums, table)
    after = files(path)
    kept = [f"2025-01-{d:02d}" for d in (2, 4, 7, 9, 10)]
    assert all(after[d] == before[d] for d in kept)
    assert "2025-01-06" not in after and "2025-01-08" not in after and after["2025-01-01"] != before["2025-01-01"]


def test_a_refresh_that_fails_is_repeated(spark, make, got, tmp_path, rows):
    path, broken = str(tmp_path / "sums"), []

    def build(table):
        if broken:
            return totals(table.withColumn("k", table.k)).selectExpr("day", "if(day = '2025-01-02', raise_error('lost'), k) AS k", "amount", "n")
        return totals(table)

    sums = DaySums(spark, path, "day", build)
    sums.refresh(make(ROWS, rows))
    table = make(ROWS, [*rows, ("2025-01-02", "a", 1), ("2025-01-04", "a", 1)])
    broken.append(True)
    with pytest.raises(Exception, match="lost"):
        sums.refresh(table)
    broken.clear()
    assert sums.refresh(table).written == ["2025-01-02", "2025-01-04"]
    same(got, sums, table)


def test_another_version_sums_every_day(spark, make, tmp_path, rows):
    path = str(tmp_path / "sums")
    table = make(ROWS, rows)
    DaySums(spark, path, "day", totals).refresh(table)
    assert len(DaySums(spark, path, "day", totals, version="2").refresh(table).written) == 11


def test_many_days_are_joined(spark, make, got, tmp_path, rows, monkeypatch):
    monkeypatch.setattr("marginloom.refresh.FEW_DAYS", 2)
    sums = DaySums(spark, str(tmp_path / "sums"), "day", totals)
    table = make(ROWS, rows)
    assert len(sums.refresh(table).written) == 11
    same(got, sums, table)


def test_digests_tell_rows_apart(spark, make):
    def digest(*rows):
        return {str(r.day): r.digest for r in row_digests(make("day DATE, a STRING, b STRING", rows), "day").collect()}["2025-01-01"]

    d = "2025-01-01"
    base = digest((d, "x", "y"), (d, "p", None))
    assert digest((d, "p", None), (d, "x", "y")) == base
    for other in ([(d, "xy", "")], [(d, "x", "y")], [(d, "x", "y"), (d, None, "p")], [(d, "x", "y"), (d, "p", "")], [(d, "x", "y"), (d, "p", None), (d, "p", None)]):
        assert digest(*other) != base


def test_files_as_digests(spark, make, tmp_path, rows):
    source = str(tmp_path / "source")
    make(ROWS, rows).write.partitionBy("day").parquet(source)
    read = lambda: spark.read.schema("k STRING, amount DECIMAL(18,4), day DATE").parquet(source)
    sums = DaySums(spark, str(tmp_path / "sums"), "day", totals, file_digests)
    assert len(sums.refresh(read()).written) == 11 and sums.refresh(read()).written == []
    make(ROWS, [("2025-01-02", "a", 1)]).write.mode("append").partitionBy("day").parquet(source)
    assert sums.refresh(read()).written == ["2025-01-02"]
    text = file_digests(read(), "day")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in text


def test_net_profit_from_refreshed_days(spark, got, tmp_path):
    """One changed day of the ledger: one partition each is written, and the net equals that of a full run."""
    s = Sources(spark, entry.SMOKE_DIR)
    ledger, bridge = s.ledger, entry._bridge(s)
    late = ledger.where("transaction_date = '1997-05-05' AND account_id IS NOT NULL")
    revenue = lambda t: pnl.channel_revenue(t, s.accounts, bridge, s.rules)
    days = DaySums(spark, str(tmp_path / "revenue"), "transaction_date", pnl.revenue_by_day)
    spent = DaySums(spark, str(tmp_path / "expenses"), "transaction_date", pnl.expenses_by_day)
    assert late.count() > 0
    for table in (ledger.exceptAll(late), ledger):
        changed = [days.refresh(revenue(table)).written, spent.refresh(pnl.all_expenses(table, s.accounts)).written]
    assert {d for c in changed for d in c} == {"1997-05-05"}
    shares = pnl.po_cost_shares(entry._po_cost(s))
    net = pnl.net_from_days(days.read(), spent.read(), s.rules, shares)
    columns = ["transaction_date", "channel", "amount"]
    assert got(net, *columns) == got(pnl.net_statement(*entry._books(s, s.rules)), *columns)

import random
import re

import pytest

import __spark_entry__ as entry
from marginloom.operators import (
    exclude_keep_null,
    expand_seconds,
    first_after,
    first_row_flag,
    joined_distinct,
    left_join_keyed,
    left_join_lines,
    newest_first,
    pivot_report,
    tolerance_join,
)


def test_exclusion_keeps_null(make, got):
    kinds = make("k STRING", [("dealer",), ("retail",), (None,)])
    assert got(kinds.where(exclude_keep_null("k", ["dealer"]))) == [(None,), ("retail",)]
    assert got(kinds.where(exclude_keep_null("k", ["it's"]))) == [(None,), ("dealer",), ("retail",)]


def test_join_with_lines_equals_plain_left_join(make, got):
    left = make("k STRING, h STRING", [("hot", "h1"), ("hot", "h2"), ("a", "h3"), ("b", "h4"), ("none", "h5"), (None, "h6")])
    right = make("k STRING, v INT", [("hot", i % 7) for i in range(200)] + [("a", 1), ("a", 1), ("b", 2), (None, 9)])
    assert got(left_join_lines(left, right, ["k"]), "k", "h", "v") == got(left.join(right, "k", "left"), "k", "h", "v")


def test_join_past_rows_without_key_equals_plain_left_join(make, got):
    left = make("h STRING, k STRING", [("h1", "a"), ("h2", "a"), ("h3", None), ("h3", None), ("h4", "none"), ("h5", "")])
    right = make("k STRING, v INT", [("a", 1), ("a", 1), ("b", 2), (None, 9), ("", 3)])
    joined = left_join_keyed(left, right, "k")
    assert got(joined, "k", "h", "v") == got(left.join(right, "k", "left"), "k", "h", "v")


@pytest.mark.parametrize("name", ["channel_basic"])
def test_ledger_rows_without_entity_are_not_shuffled_by_it(spark, name):
    text = entry.queries()[name](spark, entry.SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"isnotnull\(cast\(l_orderkey#\w+ as string\)\) else false", text)  # joined: those with one
    assert re.search(r"isnull\(cast\(l_orderkey#\w+ as string\)\) else true", text) and "Union" in text


def test_expand_seconds(make, got):
    calls = make("t TIMESTAMP_NTZ, a STRING", [("2024-01-01 23:59:55", "x")])
    seconds = [str(r[0]) for r in got(expand_seconds(calls, "t", 10), "t")]
    assert len(seconds) == 11 and seconds[0].endswith("23:59:55") and seconds[-1] == "2024-01-02 00:00:05"


def test_tolerance_join_edges(make, got):
    left = make("k STRING, t TIMESTAMP_NTZ, id STRING", [("a", f"2024-01-01 10:00:{s}", s) for s in ("00", "10", "11")])
    left = left.unionByName(make("k STRING, t TIMESTAMP_NTZ, id STRING", [("a", "2024-01-01 09:59:59", "before")]))
    right = make("k STRING, r TIMESTAMP_NTZ", [("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:00:00")])
    assert got(tolerance_join(left, right, ["k"], "t", "r", 10), "id") == [("00",), ("10",)]


def test_tolerance_join_equals_nested_loops(make, got):
    rng = random.Random(5)
    stamp = lambda s: f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"
    left = [(rng.choice("ab"), rng.randrange(600), i) for i in range(150)]
    right = [(rng.choice("ab"), rng.randrange(600), i) for i in range(150)]
    expected = sorted((str(i), str(j)) for k, s, i in left for q, t, j in right if k == q and 0 <= s - t <= 10)
    joined = tolerance_join(
        make("k STRING, t TIMESTAMP_NTZ, i INT", [(k, stamp(s), i) for k, s, i in left]),
        make("k STRING, r TIMESTAMP_NTZ, j INT", [(k, stamp(s), i) for k, s, i in right]),
        ["k"], "t", "r", 10,
    )
    assert sorted((str(r["i"]), str(r["j"])) for r in joined.collect()) == expected


@pytest.mark.parametrize("bucket_seconds", [3600 * 2, 10**9])
def test_first_after_equals_brute_force(make, bucket_seconds):
    rng = random.Random(11)
    hour = 3600 * 1_000_000
    at = lambda: rng.randrange(0, 72) * hour // 3
    points = [("hot", at(), f"p{i}") for i in range(120)] + [(rng.choice("abc"), at(), f"q{i}") for i in range(12)]
    events = [("hot", at()) for _ in range(40)] + [(rng.choice("ab"), at()) for _ in range(6)]
    expected = {i: min((e for q, e in events if q == k and e > p), default=None) for k, p, i in points}
    table, happened = make("k STRING, p BIGINT, id STRING", points), make("k STRING, e BIGINT", events)
    found = first_after(table, happened, ["k"], "p", "e", "n", bucket_seconds)
    assert found.columns == ["k", "p", "id", "n"]
    assert {r["id"]: r["n"] for r in found.collect()} == expected


def test_first_row_flag(make, got):
    rows = make("g STRING, id STRING, x INT", [("a", "1", 1), ("a", "1", 2), ("a", "2", 3), (None, "5", 4), (None, "6", 5), ("b", None, 6)])
    flagged = first_row_flag(rows, ["g"], "id", "f")
    assert {r["x"]: r["f"] for r in flagged.collect()} == {1: 1, 2: 1, 3: 0, 4: 1, 5: 0, 6: 0}
    unique = first_row_flag(rows, ["g"], "id", "f", unique_by=["x"])
    assert {r["x"]: r["f"] for r in unique.collect()} == {1: 1, 2: 0, 3: 0, 4: 1, 5: 0, 6: 0}


def test_joined_distinct(make, got):
    names = make("g INT, n STRING", [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)])
    names.createOrReplaceTempView("names_for_list")
    listed = names.sparkSession.sql(f"SELECT g, {joined_distinct('n')} AS l FROM names_for_list GROUP BY g")
    assert got(listed) == [(1, "a, b"), (2, None)]


def test_pivot_report_filters_before_it_pivots(make, got):
    rows = make(
        "a STRING, c STRING, v DECIMAL(18,4), d DATE",
        [("x", "L", 1, "2024-01-01"), ("x", "R", 2, "2024-01-02"), ("x", "L", 4, "2024-02-01"), ("y", "M", 8, "2024-01-03")],
    )
    dates = ("d", "2024-01-01", "2024-01-31")
    pivot = pivot_report(rows, ["a"], "c", ["L", "R", "M"], "v", date_range=dates)
    assert got(pivot) == [("x", 1.0, 2.0, None), ("y", None, None, 8.0)]
    assert got(pivot_report(rows, ["a"], "c", ["L", "R"], "v", "min", where="a = 'x'")) == [("x", 1.0, 2.0)]
    two = pivot_report(rows, ["a"], "c", ["L", "R"], {"sum": "v", "twice": "v * 2"}, where="a = 'x'")
    assert two.columns == ["a", "L_sum", "L_twice", "R_sum", "R_twice"] and got(two) == [("x", 5.0, 10.0, 2.0, 4.0)]


def test_pivot_report_stops_at_a_value_without_column(make):
    rows = make("a STRING, c STRING, v INT", [("x", "L", 1), ("x", "M", 2)])
    with pytest.raises(Exception, match="no pivot column for c M"):
        pivot_report(rows, ["a"], "c", ["L"], "v").collect()


def test_newest_first(make):
    rows = make("w STRING, c STRING", [("2024-01", "b"), ("2024-02", "z"), ("2024-01", "a")])
    assert [tuple(r) for r in newest_first(rows, "w", "c").collect()] == [("2024-02", "z"), ("2024-01", "a"), ("2024-01", "b")]

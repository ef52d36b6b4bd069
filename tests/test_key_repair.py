"""Damaged ids against the ids in use, by comparing every pair with exact fractions."""

import random
import re
from fractions import Fraction

import pytest

import __spark_entry__ as entry
from marginloom.operators.key_repair import key_candidates, key_intervals, repair_keys, with_repaired_keys

RULES = "type STRING, key STRING, channel STRING, value DECIMAL(18,6)"


def fits(key, number):
    """Whether a number rounds to the key's digits, either way on a half."""
    match = re.fullmatch(r"(\d+)(?:[.](\d+))?[eE][+]?(\d{1,2})", key)
    if not match or not re.fullmatch("[0-9]{1,37}", number):
        return False
    whole, broken, exponent = match[1], (match[2] or "").rstrip("0"), int(match[3])
    unit = Fraction(10) ** (exponent - len(broken))
    return unit >= 1 and abs(int(number) - int(whole + broken) * unit) <= (unit / 2 if unit > 1 else 0)


KEYS = ["1.97995E+18", "1.97995e18", "1.9E+3", "2E+3", "1.25E+1", "1E+0", "12E+2", "9.99E+36", "1.5E+36", "1E+40", "0E+5", "x", "1.2.3E+4", "17", "1.230E+5"]
IDS = ["1979945000000000000", "1979944999999999999", "1979955000000000000", "1979955000000000001", "1979950000000000000", "01979950000000000000"]
IDS += ["1900", "1950", "1951", "1849", "1850", "1500", "2500", "2501", "12", "13", "1", "1200", "1150", "1249", "1250", "0", "50000", "50001"]
IDS += ["9990000000000000000000000000000000000", "9" * 37, "9" * 38, "", "12a", "-5", None, "123000", "123499", "122500"]


def test_candidates(spark, got):
    rng = random.Random(6)
    ids = IDS + IDS[:5] + [str(rng.randint(1, 10 ** rng.randint(1, 20))) for _ in range(200)]
    rules = spark.createDataFrame([("vendor", k, "Retail", None) for k in [*KEYS, *KEYS[:3], None]], RULES)
    found = key_candidates(rules, spark.createDataFrame([(i,) for i in ids], "id STRING"))
    want = {(k, i) for k in KEYS for i in ids if i is not None and fits(k, i)}
    assert got(found, "key", "candidate") == sorted(want) and len(want) > 15


def test_intervals_are_exact(spark):
    rows = {r.key: (int(r.low), int(r.high)) for r in key_intervals(spark.createDataFrame([("v", k, "c", None) for k in KEYS], RULES)).collect()}
    assert rows["1.97995E+18"] == (1979945 * 10**12, 1979955 * 10**12)
    assert rows["1E+0"] == (1, 1) and "1.25E+1" not in rows and "1E+40" not in rows


def test_repair(spark, got):
    rules = [
        ("vendor", "1.2E+3", "Retail", None),  # 1200 alone is left: 1234 is named
        ("vendor", "1.2E+3", "Retail", None),
        ("vendor", "1234", "B2B", None),
        ("vendor", "5.5E+3", "Retail", None),  # two rules for one id
        ("vendor", "5.5E+3", "B2B", None),
        ("vendor", "7.7E+3", "B2B", None),  # two ids
        ("vendor", "8.8E+3", "B2B", None),  # no id
        ("salesperson", "1.2E+3", "B2B", None),  # 1234 is free for this type, so two
    ]
    frame = spark.createDataFrame(rules, RULES)
    ids = spark.createDataFrame([(i,) for i in ("1200", "1234", "5500", "7700", "7701", "1200")], "id STRING")
    assert got(repair_keys(frame, ids)) == [
        ("salesperson", "1.2E+3", 1, 1, 2, None, True),
        ("vendor", "1.2E+3", 2, 1, 1, "1200", False),
        ("vendor", "5.5E+3", 2, 2, 1, None, True),
        ("vendor", "7.7E+3", 1, 1, 2, None, True),
        ("vendor", "8.8E+3", 1, 1, 0, None, False),
    ]
    repaired = with_repaired_keys(frame, ids)
    assert repaired.columns == frame.columns
    assert got(repaired, "type", "key", "channel") == sorted(
        [("vendor", "1200", "Retail"), ("vendor", "1234", "B2B"), ("vendor", "5.5E+3", "B2B"), ("vendor", "5.5E+3", "Retail")]
        + [("vendor", "7.7E+3", "B2B"), ("vendor", "8.8E+3", "B2B"), ("salesperson", "1.2E+3", "B2B")]
    )


def test_empty_tables(spark):
    rules, ids = spark.createDataFrame([], RULES), spark.createDataFrame([], "id STRING")
    one = spark.createDataFrame([("vendor", "1.2E+3", "Retail", None)], RULES)
    assert repair_keys(rules, ids).count() == key_candidates(one, ids).count() == 0
    assert [(r.candidates, r.ambiguous) for r in repair_keys(one, ids).collect()] == [(0, False)]


@pytest.mark.parametrize("name", ["key_candidates", "key_repair"])
def test_join_is_one_on_equality(spark, name):
    text = entry.queries()[name](spark, entry.SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_rules_are_read_once(spark, tmp_path):
    spark.createDataFrame([("vendor", "1.2E+3", "Retail", None), ("vendor", "1234", "B2B", None)], RULES).write.parquet(f"{tmp_path}/rules")
    rules = spark.read.schema(RULES).parquet(f"{tmp_path}/rules")
    ids = spark.createDataFrame([("1200",)], "id STRING")
    plans = [repair_keys(rules, ids), key_intervals(rules)]
    texts = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    # both go on from staged tables: no expression on keys is evaluated on the rules' rows
    assert not any(f"{tmp_path}/rules" in t for t in texts) and "counted-rules" in texts[0] and "damaged-keys" in texts[1]


def test_query_has_every_outcome(spark):
    rows = entry.queries()["key_repair"](spark, "/root/testdata/sf0.01").collect()
    assert {(r.resolved is not None, r.ambiguous) for r in rows} == {(True, False), (False, True), (False, False)}

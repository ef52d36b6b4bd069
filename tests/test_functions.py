from marginloom.functions import (
    OrderRules,
    as_date,
    in_later_week,
    iso_week_key,
    minutes_between,
    name_segment,
    order_channel,
    order_channel_legacy,
    paid_status,
    slash_date,
    wall_micros,
    week_end,
    week_key,
    week_start,
)

RULES = OrderRules(
    plain=(("0089400", "Club"),), dashed=(("SO-EB-", "East"), ("SO-VM-", "Van"), ("SO-MB-", "Moon"), ("SO-", "House"))
)


def test_name_segments(make, got):
    names = make("name STRING", [("One - Two - Rest",), ("A-B",), ("NoDash",), (None,), (" X  -Y- Z-W",)])
    parsed = names.selectExpr("name", f"{name_segment('name', 1)} AS a", f"{name_segment('name', 2)} AS b")
    found = {r["name"]: (r["a"], r["b"]) for r in parsed.collect()}
    assert found == {
        "One - Two - Rest": ("One", "Two"),
        "A-B": ("A", ""),
        "NoDash": ("", ""),
        None: (None, None),
        " X  -Y- Z-W": ("X", "Y"),
    }


def test_week_keys(make, got):
    days = make("d DATE", [("2024-01-01",), ("2024-12-30",), ("2026-12-28",), ("2027-01-01",), ("2024-03-03",)])
    keys = days.selectExpr("CAST(d AS STRING) AS d", f"{week_key('d')} AS k", f"{iso_week_key('d')} AS i")
    assert got(keys) == [
        ("2024-01-01", "2024-01", "2024-01"),
        ("2024-03-03", "2024-09", "2024-09"),
        ("2024-12-30", "2024-01", "2025-01"),
        ("2026-12-28", "2026-53", "2026-53"),
        ("2027-01-01", "2026-53", "2026-53"),
    ]


def test_week_bounds(make, got):
    days = make("d DATE", [("2024-02-29",), ("2024-03-03",), ("2024-03-04",)])
    bounds = days.selectExpr(f"{slash_date(week_start('d'))} AS s", f"{slash_date(week_end('d'))} AS e")
    assert got(bounds) == [("2024/02/26", "2024/03/03"), ("2024/02/26", "2024/03/03"), ("2024/03/04", "2024/03/10")]


def test_as_date_is_a_literal_or_the_run_day():
    assert as_date("2026-04-16") == "DATE'2026-04-16'"
    assert as_date() == "current_date()"


def test_order_channels(make):
    numbers = ["0089400123", "SO-EB-1", "SO-VM-1", "SO-MB-1", "SO-9", "12345", "X-1", None, "0089400-1"]
    table = make("n STRING", [(n,) for n in numbers])
    rows = table.selectExpr("n", f"{order_channel('n', RULES)} AS c", f"{order_channel_legacy('n', RULES)} AS o").collect()
    assert {r["n"]: r["c"] for r in rows} == {
        "0089400123": "Club",
        "SO-EB-1": "East",
        "SO-VM-1": "Van",
        "SO-MB-1": "Moon",
        "SO-9": "House",
        "12345": "No SO",
        "X-1": "No SO",
        None: "No SO",
        "0089400-1": "No SO",
    }
    legacy = {r["n"]: r["o"] for r in rows}
    assert legacy["0089400123"] == "Club" and legacy["SO-9"] == "House"
    assert [legacy[n] for n in ("12345", "X-1", None)] == ["", "", ""]
    assert RULES.channels() == ["Club", "East", "Van", "Moon", "House", "No SO"]


def test_paid_status(make):
    bills = make("t DECIMAL(18,4), b DECIMAL(18,4)", [(10, 0), (10, 4), (10, 10), (None, None)])
    found = [r["s"] for r in bills.selectExpr("t", f"{paid_status('t', 'b')} AS s").collect()]
    assert found == ["Paid", "Partial", "Not Paid", "Not Paid"]


def test_wall_clock_does_not_follow_the_session_zone(spark, make):
    zone = spark.conf.get("spark.sql.session.timeZone")
    times = make("ts TIMESTAMP_NTZ", [("2024-03-10 02:30:00.000001",), ("1970-01-01 00:00:00",)])
    try:
        found = []
        for name in ("UTC", "America/Vancouver"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found.append([r[0] for r in times.selectExpr(wall_micros("ts")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] == [1710037800000001, 0]


def test_minutes_are_truncated_and_only_forward(make):
    spans = make("a BIGINT, b BIGINT", [(0, 59_999_999), (0, 60_000_000), (0, 0), (5, 1), (0, 300_000_000)])
    assert [r[0] for r in spans.selectExpr(minutes_between("a", "b")).collect()] == [0, 1, None, None, 5]


def test_days_of_later_weeks_have_greater_keys(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1996-01-01', DATE'2003-12-31')) AS day")
    for last in ("1998-06-15", "1998-12-28", "1999-12-31", "2001-12-31", "2002-01-06"):
        key = week_key(as_date(last))
        later = days.selectExpr("*", f"{in_later_week('day', as_date(last))} AS later", f"{week_key('day')} > {key} AS greater")
        assert later.where("later AND NOT greater").count() == 0
        # only days around the end of a year are left to the keys, unless the last week itself is one that keeps its old year
        if last in ("2001-12-31", "2002-01-06"):
            continue
        assert later.where("greater AND NOT later AND date_format(day, 'MMdd') BETWEEN '0107' AND '1228'").count() == 0
    assert days.where(in_later_week("CAST(NULL AS DATE)", as_date("1998-06-15"))).count() == 0

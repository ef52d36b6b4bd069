import random

import pytest

import __spark_entry__ as entry

from marginloom.plans import voice as vo


def log(key, kind, number, at, returned="false"):
    return {"log_id": key, "call_type": kind, "customer_number": number, "start_time": f"2026-01-05 {at}", "missed_call_returned": returned}


def leg(key, agent, kind, at="09:00:00", cause="answered"):
    return {"calllog_id": key, "agent": agent, "call_type": kind, "hangup_cause": cause, "agent_called_time": f"2026-01-05 {at}"}


@pytest.fixture(scope="module")
def calls(source):
    logs = source(
        "call_logs",
        [
            log("m1", "missed", "100", "10:00:00", "true"),
            log("m2", "missed", "200", "10:00:00"),
            log("m3", "missed", "", "10:00:00"),
            log("m4", "missed", None, "10:00:00"),
            log("m5", "missed", "300", "10:00:00"),
            log("o1", "outgoing", "100", "09:50:00"),
            log("o2", "outgoing", "100", "10:00:59"),
            log("o3", "outgoing", "100", "10:05:00"),
            log("o4", "outgoing", "300", "10:00:00"),
            log("i1", "incoming", "100", "10:03:00"),
            log("i2", "incoming", "100", "10:04:00"),
            log("i3", "incoming", "", "10:04:00"),
        ],
    )
    metrics = source(
        "agent_metrics",
        [
            leg("o1", "a1", "outgoing", "09:50:00"),
            leg("o2", "a2", "outgoing", "10:00:59"),
            leg("o3", "a2", "outgoing", "10:05:00"),
            leg("o3", "a2", "outgoing", "10:04:58"),
            leg("o3", "a3", "outgoing", "10:05:00"),
            leg("o3", "", "outgoing", "10:05:00"),
            leg("o3", None, "outgoing", "10:05:00"),
            leg("o4", "a1", "outgoing", "10:00:00"),
            leg("i1", "a3", "incoming"),
            leg("i1", "a1", "incoming"),
            leg("i1", "a1", "incoming"),
            leg("i1", "a2", "incoming", cause="busy"),
            leg("i2", "zz", "incoming"),
            leg("i3", "a1", "incoming"),
        ],
    )
    agents = source("agents", [{"agent_id": "a1", "name": "Ada"}, {"agent_id": "a2", "name": "Bo"}])
    return logs, metrics, agents, vo.outgoing_calls(metrics, agents, logs), vo.answered_incoming(logs, metrics, agents)


def test_outgoing_is_one_row_per_call_and_agent(calls, got):
    found = got(calls[3].selectExpr("log_id", "customer_number", "CAST(out_time AS STRING) AS t", "agent_name"))
    assert found == [
        ("o1", "100", "2026-01-05 09:50:00", "Ada"),
        ("o2", "100", "2026-01-05 10:00:59", "Bo"),
        ("o3", "100", "2026-01-05 10:05:00", None),
        ("o3", "100", "2026-01-05 10:05:00", "Bo"),
        ("o4", "300", "2026-01-05 10:00:00", "Ada"),
    ]


def test_incoming_lists_distinct_known_agents(calls, got):
    assert got(calls[4], "log_id", "customer_number", "agent_name") == [("i1", "100", "Ada"), ("i2", "100", None)]


def test_candidates_and_minutes(calls, got):
    table = vo.callback_candidates(calls[0], calls[3], calls[4])
    found = got(table.where("missed_id = 'm1'"), "call_direction", "callback_agent", "mins_to_callback")
    assert found == [
        ("incoming", None, 4),
        ("incoming", "Ada", 3),
        ("outgoing", None, 5),
        ("outgoing", "Ada", None),
        ("outgoing", "Bo", 0),
        ("outgoing", "Bo", 5),
    ]
    assert got(table.where("missed_id = 'm2'"), "call_direction", "out_time") == [("incoming", None), ("outgoing", None)]
    # a call at the very time of the miss is not later
    assert got(table.where("missed_id = 'm5' AND out_time IS NOT NULL"), "mins_to_callback") == [(None,)]


def test_summary(calls, got):
    summary = vo.callback_summary(calls[0], calls[3], calls[4])
    assert got(summary, "missed_id", "all_agents", "mins_to_callback", "was_returned", "yr", "mth") == [
        ("m1", "Ada, Bo, incoming: Ada", 0, "true", 2026, 1),
        ("m2", None, None, "false", 2026, 1),
        ("m5", "Ada", None, "false", 2026, 1),
    ]
    later = vo.callback_summary(calls[0], calls[3], calls[4], only_after=True)
    assert got(later, "missed_id", "all_agents") == [("m1", "Bo, incoming: Ada"), ("m2", None), ("m5", None)]


def test_report_and_rate(calls, got):
    summary = vo.callback_summary(calls[0], calls[3], calls[4])
    report = vo.callback_report(summary, 2026)
    assert got(report, "missed_id", "never_called_back", "within_service_level") == [
        ("m1", False, True),
        ("m2", True, False),
        ("m5", True, False),
    ]
    assert vo.callback_report(summary, 2025).count() == 0
    assert got(vo.callback_rate(summary, ["yr"]), "missed", "returned", "in_time", "callback_rate") == [(3, 1, 1, 0.333333333333)]


def test_agent_map_and_tolerance_match_agree(calls, got):
    logs, metrics, agents = calls[:3]
    agent_map = vo.outgoing_agent_map(metrics, agents)
    assert agent_map.count() == 6 * 11
    outgoing = logs.where("call_type = 'outgoing'")
    by_map = outgoing.join(agent_map, outgoing["start_time"] == agent_map["out_time"])
    by_range = vo.matched_call_agents(outgoing, metrics, agents, ("call_type",))
    assert got(by_map, "log_id", "agent_name") == got(by_range, "log_id", "agent_name")


def test_pickup_rate(calls, got):
    rates = vo.pickup_rate(calls[1], calls[2])
    assert got(rates.where("agent = 'a2'"), "agent_name", "hangup_cause", "legs", "share") == [
        ("Bo", "answered", 3, 0.75),
        ("Bo", "busy", 1, 0.25),
    ]


def test_agents_equal_the_pair_table_when_one_customer_dominates(source):
    rng = random.Random(3)
    number = lambda: "1" if rng.random() < 0.5 else str(rng.randrange(2, 6))
    clock = lambda: f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:00"
    rows = [log(f"m{i}", "missed", number(), clock()) for i in range(60)]
    legs = []
    for i in range(90):
        at, kind = clock(), rng.choice(["outgoing", "incoming"])
        rows.append(log(f"c{i}", kind, number(), at))
        legs.append(leg(f"c{i}", rng.choice(["a1", "a2", "a9"]), kind, at))
    logs, metrics = source("call_logs", rows), source("agent_metrics", legs)
    agents = source("agents", [{"agent_id": "a1", "name": "Ada"}, {"agent_id": "a2", "name": "Bo"}])
    outgoing, incoming = vo.outgoing_calls(metrics, agents, logs), vo.answered_incoming(logs, metrics, agents)
    expected = {}
    for r in vo.callback_candidates(logs, outgoing, incoming).where("out_time IS NOT NULL").collect():
        key = (r["missed_id"], r["call_direction"], r["callback_agent"])
        known = [m for m in (expected.get(key), r["mins_to_callback"]) if m is not None]
        expected[key] = min(known, default=None)
    found = {
        (r["missed_id"], r["call_direction"], r["callback_agent"]): r["mins_to_callback"]
        for r in vo.callback_agents(logs, outgoing, incoming).where("call_direction IS NOT NULL").collect()
    }
    assert found == expected
    summary = {r["missed_id"]: r["mins_to_callback"] for r in vo.callback_summary(logs, outgoing, incoming).collect()}
    minutes = {r["missed_id"]: r["mins_to_callback"] for r in vo.callback_minutes(logs, outgoing, incoming).collect()}
    assert minutes == summary
    single = vo.callback_agents(logs, outgoing, vo.answered_by_agent(logs, metrics, agents))
    assert single.where("callback_agent LIKE '%,%'").count() == 0
    assert single.groupBy("missed_id", "call_direction", "callback_agent").count().where("count > 1").count() == 0


@pytest.mark.parametrize("by_agent", [False, True])
def test_contacts_from_one_pass_equal_both_directions(spark, source, got, by_agent):
    """Random legs: unknown agents, agents of one name, calls without a log, without a number, of both directions."""
    rng = random.Random(by_agent)
    logs = source(
        "call_logs",
        [
            {
                "log_id": str(rng.randint(1, 25)),
                "call_type": rng.choice(["missed", "outgoing", "incoming"]),
                "customer_number": rng.choice(["1", "2", "3", "", None]),
                "start_time": f"2024-01-0{rng.randint(1, 9)} 10:00:00",
            }
            for _ in range(60)
        ],
    )
    metrics = source(
        "agent_metrics",
        [
            {
                "calllog_id": str(rng.randint(1, 30)),
                "agent": rng.choice(["a", "b", "c", "x", "", None]),
                "call_type": rng.choice(["outgoing", "incoming"]),
                "hangup_cause": rng.choice(["answered", "no answer"]),
                "agent_called_time": f"2024-01-0{rng.randint(1, 9)} 11:00:00",
            }
            for _ in range(90)
        ],
    )
    agents = source("agents", [{"agent_id": "a", "name": "Ann"}, {"agent_id": "b", "name": "Bo"}, {"agent_id": "c", "name": "Ann"}])
    answered = (vo.answered_by_agent if by_agent else vo.answered_incoming)(logs, metrics, agents)
    want = vo.returning_calls(vo.outgoing_calls(metrics, agents, logs), answered).distinct()
    found = vo.returning_contacts(logs, metrics, agents, by_agent)
    assert found.columns == want.columns and got(found.distinct()) == got(want) and want.count() > 30


def test_call_backs_read_the_events_four_times_at_most(spark, monkeypatch):
    seen, staged = [], vo.staged
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(vo, "staged", lambda df, name: (seen.append(plan(df)), staged(df, name))[1])
    for name in ("callback_summary", "callback_agents", "callback_report"):
        seen.clear()
        seen.append(plan(entry.queries()[name](spark, entry.SMOKE_DIR)))
        assert sum(text.count("events.parquet") for text in seen) <= 4

"""Missed calls and how they were returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marginloom.functions.calendar import minutes_between, wall_micros
from marginloom.operators.asof import first_after
from marginloom.operators.joins import expand_seconds, tolerance_join
from marginloom.operators.textagg import joined_distinct
from marginloom.staging import staged
from marginloom.types import ratio, text

# Call types, the outcome that counts as answered, the label of answered calls.
MISSED, OUTGOING, INCOMING = "missed", "outgoing", "incoming"
ANSWERED = "answered"
INCOMING_PREFIX = "incoming: "
# Seconds an agent's record may lie before the call log; minutes of the service level.
CLOCK_TOLERANCE = 10
SERVICE_MINUTES = 60

MISSED_COLUMNS = ["missed_id", "customer_number", "missed_at", "yr", "mth", "was_returned"]


def _filled(name: str) -> str:
    return f"{name} IS NOT NULL AND {name} <> ''"


def _max(source: str, out: str):
    return F.expr(f"max({source}) AS {out}")


def _agent_names(agents: DataFrame) -> DataFrame:
    return agents.groupBy("agent_id").agg(_max("name", "agent_name")).withColumnRenamed("agent_id", "agent")


def _placed_calls(metrics: DataFrame) -> DataFrame:
    return metrics.where(f"call_type = {text(OUTGOING)} AND {_filled('agent')}")


def _named_calls(metrics: DataFrame, agents: DataFrame) -> DataFrame:
    return _placed_calls(metrics).join(agents.selectExpr("agent_id AS agent", "name AS agent_name"), "agent", "left")


def outgoing_agent_map(metrics: DataFrame, agents: DataFrame, seconds: int = CLOCK_TOLERANCE) -> DataFrame:
    """Agent and time of each outgoing call, repeated for every second of clock tolerance."""
    calls = _named_calls(metrics, agents).selectExpr("agent_called_time AS out_time", "agent_name")
    return expand_seconds(calls, "out_time", seconds)


def matched_call_agents(
    logs: DataFrame, metrics: DataFrame, agents: DataFrame, on: tuple[str, ...] = ("log_id",), seconds: int = CLOCK_TOLERANCE
) -> DataFrame:
    """Calls with the agents recorded at most ``seconds`` before them; the map without its copies.

    ``on`` are columns both sides share, the call id by default. With no more than the call
    type, as the map is used, every call meets all calls placed in the same seconds.
    """
    placed = _named_calls(metrics, agents).withColumnRenamed("calllog_id", "log_id")
    wanted = [*on, *[c for c in placed.columns if c not in {*on, *logs.columns}]]
    return tolerance_join(logs, placed.select(*wanted), list(on), "start_time", "agent_called_time", seconds)


def outgoing_calls(metrics: DataFrame, agents: DataFrame, logs: DataFrame) -> DataFrame:
    """One row per outgoing call and agent with the customer's number.

    Call legs are reduced to call and agent first; each lookup holds one row per id, so no
    join can repeat a row and a call with very many legs is combined on the map side.
    """
    legs = (
        _placed_calls(metrics)
        .groupBy("calllog_id", "agent")
        .agg(_max("agent_called_time", "out_time"))
        .withColumnRenamed("calllog_id", "log_id")
    )
    numbers = logs.groupBy("log_id").agg(_max("customer_number", "customer_number"))
    return (
        legs.join(_agent_names(agents), "agent", "left")
        .join(numbers, "log_id", "left")
        .select("log_id", "customer_number", "out_time", "agent_name")
    )


def _answered_legs(logs: DataFrame, metrics: DataFrame, agents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Incoming calls, one row each, and who answered them, one row per call and agent."""
    calls = (
        logs.where(f"call_type = {text(INCOMING)} AND {_filled('customer_number')}")
        .groupBy("log_id")
        .agg(_max("customer_number", "customer_number"), _max("start_time", "in_time"))
    )
    answered = metrics.where(f"hangup_cause = {text(ANSWERED)}")
    legs = answered.selectExpr("calllog_id AS log_id", "agent").distinct()
    return calls, legs.join(_agent_names(agents), "agent", "left")


def answered_incoming(logs: DataFrame, metrics: DataFrame, agents: DataFrame) -> DataFrame:
    """One row per answered incoming call; several agents are listed by name."""
    calls, legs = _answered_legs(logs, metrics, agents)
    listed = legs.groupBy("log_id").agg(F.expr(f"{joined_distinct('agent_name')} AS agent_name"))
    return calls.join(listed, "log_id", "inner").select("log_id", "customer_number", "in_time", "agent_name")


def answered_by_agent(logs: DataFrame, metrics: DataFrame, agents: DataFrame) -> DataFrame:
    """One row per answered incoming call and agent name (NULL for unknown agents)."""
    calls, legs = _answered_legs(logs, metrics, agents)
    named = legs.select("log_id", "agent_name").distinct()
    return calls.join(named, "log_id", "inner").select("log_id", "customer_number", "in_time", "agent_name")


def missed_calls(logs: DataFrame) -> DataFrame:
    """Missed calls with a known customer number."""
    return logs.where(f"call_type = {text(MISSED)} AND {_filled('customer_number')}").selectExpr(
        "log_id AS missed_id",
        "customer_number",
        "start_time AS missed_at",
        "year(start_time) AS yr",
        "month(start_time) AS mth",
        "missed_call_returned AS was_returned",
    )


def returning_calls(outgoing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both directions in one table: number, time, agent, direction."""

    def side(calls: DataFrame, time: str, direction: str) -> DataFrame:
        return calls.selectExpr(
            "customer_number",
            f"{time} AS out_time",
            "agent_name AS callback_agent",
            f"{text(direction)} AS call_direction",
        )

    return side(outgoing, "out_time", OUTGOING).unionByName(side(incoming, "in_time", INCOMING))


def returning_contacts(logs: DataFrame, metrics: DataFrame, agents: DataFrame, by_agent: bool = False) -> DataFrame:
    """``returning_calls`` from one pass over the logs and one over the call legs, joined once by call.

    An answered incoming call is one row with the list of its agents, or with ``by_agent`` one row per agent. What is
    collected per call are its agents, one entry each however many legs they had.
    """
    placed = f"call_type = {text(OUTGOING)} AND {_filled('agent')}"
    legs = metrics.groupBy("calllog_id", "agent").agg(
        F.expr(f"max(agent_called_time) FILTER (WHERE {placed}) AS out_time"),
        F.expr(f"count_if({placed}) > 0 AS placed"),
        F.expr(f"count_if(hangup_cause = {text(ANSWERED)}) > 0 AS answered"),
    )
    legs = legs.where("placed OR answered").withColumnRenamed("calllog_id", "log_id").join(_agent_names(agents), "agent", "left")
    taken = f"call_type = {text(INCOMING)} AND {_filled('customer_number')}"
    calls = logs.groupBy("log_id").agg(
        _max("customer_number", "number"),
        F.expr(f"max(customer_number) FILTER (WHERE {taken}) AS number_in"),
        F.expr(f"max(start_time) FILTER (WHERE {taken}) AS in_time"),
    )
    made = "struct(out_time, agent_name)"
    per_call = legs.join(calls, "log_id", "left").groupBy("log_id").agg(
        *[_max(c, c) for c in ("number", "number_in", "in_time")],
        F.expr(f"collect_set(CASE WHEN placed THEN {made} END) AS made"),
        # an unknown agent is one entry too
        F.expr("collect_set(CASE WHEN answered THEN struct(agent_name) END) AS answerers"),
    )

    def entry(number: str, time: str, agent: str, direction: str) -> str:
        return f"struct({number} AS customer_number, {time} AS out_time, {agent} AS callback_agent, {text(direction)} AS call_direction)"

    out = f"transform(made, m -> {entry('number', 'm.out_time', 'm.agent_name', OUTGOING)})"
    if by_agent:
        back = f"transform(answerers, a -> {entry('number_in', 'in_time', 'a.agent_name', INCOMING)})"
    else:
        known = "array_sort(filter(transform(answerers, a -> a.agent_name), n -> n IS NOT NULL))"
        listed = f"if(size({known}) > 0, array_join({known}, ', '), NULL)"
        back = f"if(size(answerers) > 0, array({entry('number_in', 'in_time', listed, INCOMING)}), array())"
    answered = f"if(number_in IS NULL, array(), {back})"
    return per_call.selectExpr(f"inline(concat({out}, {answered}))")


def callback_candidates(logs: DataFrame, outgoing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Every missed call beside every call with the same number, per direction.

    This table grows with the square of a customer's calls; it is for looking at single
    customers (filter ``logs`` first). ``callback_agents`` and ``callback_summary`` give its
    results without building it.
    """
    directions = f"explode(array({text(OUTGOING)}, {text(INCOMING)})) AS call_direction"
    missed = missed_calls(logs).selectExpr("*", directions)
    minutes = minutes_between(wall_micros("missed_at"), wall_micros("out_time"))
    return (
        missed.join(returning_calls(outgoing, incoming), ["customer_number", "call_direction"], "left")
        .selectExpr(*MISSED_COLUMNS, "out_time", "callback_agent", f"{minutes} AS mins_to_callback", "call_direction")
    )


def _timed_calls(calls: DataFrame, *columns: str) -> DataFrame:
    known = calls.where(_filled("customer_number"))
    return known.selectExpr("customer_number", *columns, f"{wall_micros('out_time')} AS _at")


def callback_minutes(logs: DataFrame, outgoing: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row per missed call: minutes to the customer's first later call, whoever took it.

    Only the customer's calls are looked at, not who made them.
    """
    return callback_minutes_of(logs, returning_calls(outgoing, incoming))


def callback_minutes_of(logs: DataFrame, calls: DataFrame) -> DataFrame:
    """``callback_minutes`` for a table of ``returning_calls`` or ``returning_contacts``."""
    points = missed_calls(logs).selectExpr("*", f"{wall_micros('missed_at')} AS _missed")
    timed = first_after(points, _timed_calls(calls), ["customer_number"], "_missed", "_at", "_first")
    minutes = f"min({minutes_between('_missed', '_first')}) AS mins_to_callback"
    return timed.groupBy("missed_id").agg(*[_max(c, c) for c in MISSED_COLUMNS[1:]], F.expr(minutes))


def callback_agents(logs: DataFrame, outgoing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Missed call x agent in contact with the customer: minutes to that agent's first later call.

    One row per missed call, direction and agent, however many calls there were; the minutes
    are NULL for an agent who called only before the miss. A missed call whose customer had
    no other contact gives one row without agent and direction. With ``incoming`` from
    ``answered_by_agent`` there are at most two rows per agent; with lists of agents from
    ``answered_incoming``, as the list of ``callback_summary`` needs them, one per list.
    """
    return callback_agents_of(logs, returning_calls(outgoing, incoming))


def callback_agents_of(logs: DataFrame, calls: DataFrame) -> DataFrame:
    """``callback_agents`` for a table of ``returning_calls`` or ``returning_contacts``.

    The calls are looked at twice, for who was in contact at all and for the first call after each miss, so they are
    staged when this function is called. A row per miss and agent is what the result consists of.
    """
    # one text per direction and agent that keeps an unknown agent apart from every name
    contact = "concat(call_direction, coalesce(concat(' by ', callback_agent), '')) AS _contact"
    calls = staged(_timed_calls(calls, contact), "contacts")
    contacts = calls.select("customer_number", "_contact").distinct()
    missed = missed_calls(logs).selectExpr("missed_id", "customer_number", "missed_at", "was_returned")
    points = missed.join(contacts, "customer_number", "left").selectExpr(
        *missed.columns, "coalesce(_contact, '') AS _contact", f"{wall_micros('missed_at')} AS _missed"
    )
    timed = first_after(points, calls, ["customer_number", "_contact"], "_missed", "_at", "_first")
    return timed.selectExpr(
        "missed_id",
        "customer_number",
        "missed_at",
        "year(missed_at) AS yr",
        "month(missed_at) AS mth",
        "was_returned",
        "if(_contact LIKE '% by %', substring(_contact, instr(_contact, ' by ') + 4), NULL) AS callback_agent",
        "nullif(substring_index(_contact, ' by ', 1), '') AS call_direction",
        f"{minutes_between('_missed', '_first')} AS mins_to_callback",
    )


def callback_summary(
    logs: DataFrame, outgoing: DataFrame, incoming: DataFrame, only_after: bool = False
) -> DataFrame:
    """One row per missed call: minutes to the first call back, and the agents in contact.

    The list names agents by their minutes (agents who called only before the miss come
    first, ``only_after`` leaves them out), then by label; answerers of the customer's own
    calls are prefixed.
    """
    return callback_summary_of(logs, returning_calls(outgoing, incoming), only_after)


def callback_summary_of(logs: DataFrame, calls: DataFrame, only_after: bool = False) -> DataFrame:
    """``callback_summary`` for a table of ``returning_calls`` or ``returning_contacts``."""
    listed = "AND mins_to_callback IS NOT NULL" if only_after else ""
    label = f"if(call_direction = {text(INCOMING)}, concat({text(INCOMING_PREFIX)}, callback_agent), callback_agent)"
    # one entry per missed call and agent: the list is as long as the text it becomes
    entries = f"""collect_list(CASE WHEN callback_agent IS NOT NULL {listed}
        THEN named_struct('mins', mins_to_callback, 'label', {label}) END)"""
    names = f"array_distinct(transform(array_sort({entries}), e -> e.label))"
    return (
        callback_agents_of(logs, calls)
        .groupBy("missed_id")
        .agg(
            *[_max(c, c) for c in MISSED_COLUMNS[1:]],
            F.expr(f"nullif(array_join({names}, ', '), '') AS all_agents"),
            F.expr("min(mins_to_callback) AS mins_to_callback"),
        )
    )


def callback_report(summary: DataFrame, year: int | None = None, service_minutes: int = SERVICE_MINUTES) -> DataFrame:
    """One row per customer and missed call with the never-called-back and in-time flags."""
    if year is not None:
        summary = summary.where(f"yr = {year}")
    return (
        summary.groupBy("customer_number", "missed_id")
        .agg(
            F.expr("min(mins_to_callback) AS mins_to_callback"),
            _max("all_agents", "all_agents"),
            _max("was_returned", "was_returned"),
        )
        .selectExpr(
            "*",
            "mins_to_callback IS NULL AS never_called_back",
            f"coalesce(mins_to_callback <= {service_minutes}, FALSE) AS within_service_level",
        )
    )


def callback_rate(summary: DataFrame, by: list[str], service_minutes: int = SERVICE_MINUTES) -> DataFrame:
    """Share of missed calls that were returned, and returned in time; ``callback_minutes`` is all it needs."""
    counts = {
        "missed": "count(*)",
        "returned": "count(mins_to_callback)",
        "in_time": f"count_if(mins_to_callback <= {service_minutes})",
    }
    return (
        summary.groupBy(*by)
        .agg(*[F.expr(f"{count} AS {out}") for out, count in counts.items()])
        .selectExpr(
            "*", f"{ratio('returned', 'missed')} AS callback_rate", f"{ratio('in_time', 'missed')} AS in_time_rate"
        )
    )


def pickup_rate(metrics: DataFrame, agents: DataFrame) -> DataFrame:
    """Call legs per agent and outcome, and their share in the agent's legs.

    The definition is ours: the report is known by name only.
    """
    counted = metrics.where(_filled("agent")).groupBy("agent", "hangup_cause").agg(F.expr("count(*) AS legs"))
    # the window runs over the counts: one row per agent and outcome
    shared = counted.selectExpr("*", f"{ratio('legs', 'sum(legs) OVER (PARTITION BY agent)')} AS share")
    return shared.join(_agent_names(agents), "agent", "left").select(
        "agent", "agent_name", "hangup_cause", "legs", "share"
    )

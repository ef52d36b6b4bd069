"""Ids that a spreadsheet turned into scientific notation, found again among the ids that are in use.

``1.97995E+18`` has lost digits: it stands for every id that rounds to it, an interval as wide as one unit of its last
digit. Ids in use are compared with it by an interval join: for each width that occurs among the damaged keys the
number line is cut into cells of that width, an id lies in one cell and an interval touches two, so the join is one
on equality of width and cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marginloom.staging import staged

WIDE = "DECIMAL(38,0)"
SCIENTIFIC = r"^[0-9]+([.][0-9]+)?[eE][+]?[0-9]{1,2}$"
# digits before and after the point, and the exponent
_PARTS = r"^([0-9]+)(?:[.]([0-9]+))?[eE][+]?([0-9]{1,2})$"
#: Longest ids that are compared, and the largest interval: what 38 digits hold.
_PLAIN = "^[0-9]{1,37}$"


def key_intervals(damaged: DataFrame) -> DataFrame:
    """Distinct ``key`` of ``damaged`` in scientific notation with low, high (both included) and width of its ids.

    Keys without an exponent that is larger than their digits behind the point have lost nothing: their interval
    is one id. Keys of more than 37 digits are left out. The distinct keys are computed when this function is called:
    from a plan the optimizer moves what follows below the distinct, to every row of ``damaged``.
    """
    part = lambda n: f"regexp_extract(key, '{_PARTS}', {n})"
    keys = staged(damaged.where(f"key RLIKE '{SCIENTIFIC}'").select("key").distinct(), "damaged-keys")
    read = keys.selectExpr("key", f"{part(1)} AS whole", f"rtrim('0', {part(2)}) AS broken", f"CAST({part(3)} AS INT) AS exponent")
    lost = read.selectExpr("key", "concat(whole, broken) AS digits", "exponent - length(broken) AS zeros")
    lost = lost.where("zeros >= 0 AND length(ltrim('0', digits)) + zeros <= 37")
    power = f"CAST(rpad('1', zeros + 1, '0') AS {WIDE})"
    value = f"CAST(concat(digits, repeat('0', zeros)) AS {WIDE})"
    # a half is rounded either way, so both ends belong to the interval
    half = f"(CASE WHEN zeros = 0 THEN CAST(0 AS {WIDE}) ELSE CAST(concat('5', repeat('0', zeros - 1)) AS {WIDE}) END)"
    exact = lost.selectExpr("key", f"{value} AS value", f"{half} AS half", f"{power} AS width")
    return exact.selectExpr("key", f"CAST(value - half AS {WIDE}) AS low", f"CAST(value + half AS {WIDE}) AS high", "width")


def key_candidates(damaged: DataFrame, ids: DataFrame) -> DataFrame:
    """key, candidate: the ids in use (column ``id`` of ``ids``, texts) that each damaged key may stand for.

    Repeated ids count once; ids that aren't plain numbers can't be one. Leading zeros make another id of the same
    number. A key that no id fits isn't in the result.
    """
    intervals = key_intervals(damaged)
    cell = lambda value: f"CAST({value} DIV width AS {WIDE})"
    touched = f"explode(array_distinct(array({cell('low')}, {cell('high')}))) AS cell"
    cells = intervals.selectExpr("key", "low", "high", "width AS key_width", touched)
    widths = intervals.agg(F.expr("collect_set(width) AS widths"))  # at most 38
    used = ids.where(f"id RLIKE '{_PLAIN}'").select("id").distinct()
    numbers = used.withColumn("widths", widths.scalar()).selectExpr("id", f"CAST(id AS {WIDE}) AS number", "explode(widths) AS width")
    placed = numbers.selectExpr("id", "number", "width", f"{cell('number')} AS id_cell")
    met = F.expr("width = key_width AND id_cell = cell AND number >= low AND number <= high")
    return placed.join(cells, met, "inner").selectExpr("key", "id AS candidate")


def repair_keys(rules: DataFrame, ids: DataFrame) -> DataFrame:
    """type, key, rules, channels, candidates, resolved, ambiguous: what becomes of each damaged key of ``rules``.

    Candidates are ids in use that no undamaged rule of the same type names already. A key is resolved if there is
    one candidate and one distinct rule (channel, value) for it; more of either are ambiguous; without a candidate it
    is neither.

    ``rules`` is read once: equal rules are counted first, and what is staged of them serves all that follows.
    """
    rules = staged(rules.groupBy("type", "key", "channel", "value").agg(F.count("*").alias("copies")), "counted-rules")
    damaged = rules.where(f"key RLIKE '{SCIENTIFIC}'")
    groups = damaged.groupBy("type", "key").agg(
        F.sum("copies").alias("rules"), F.count("*").alias("versions"), F.expr("count(DISTINCT channel) AS channels")
    )
    named = rules.where(f"key RLIKE '{_PLAIN}'").selectExpr("type AS named_type", "key AS named").distinct()
    kinds = damaged.select("type", "key").distinct()
    open_ids = kinds.join(key_candidates(damaged, ids), "key", "inner").join(
        named, F.expr("type = named_type AND candidate = named"), "left_anti"
    )
    # an array of two at most would do; the least and the number say the same and are combined before the shuffle
    found = open_ids.groupBy("type", "key").agg(F.expr("count(*) AS candidates"), F.expr("min(candidate) AS least"))
    return groups.join(found, ["type", "key"], "left").selectExpr(
        "type",
        "key",
        "rules",
        "channels",
        "coalesce(candidates, 0) AS candidates",
        "if(candidates = 1 AND versions = 1, least, NULL) AS resolved",
        "coalesce(candidates > 1 OR (candidates = 1 AND versions > 1), FALSE) AS ambiguous",
    )


def with_repaired_keys(rules: DataFrame, ids: DataFrame) -> DataFrame:
    """``rules`` with the keys that ``repair_keys`` resolves; copies of one rule become one, others stay as they are."""
    resolved = repair_keys(rules, ids).where("resolved IS NOT NULL").selectExpr("type AS _type", "key AS _key", "resolved AS _resolved")
    joined = rules.join(resolved, F.expr("type = _type AND key = _key"), "left")
    columns = ["coalesce(_resolved, key) AS key" if c == "key" else f"`{c}`" for c in rules.columns]
    repaired = joined.where("_resolved IS NOT NULL").selectExpr(*columns).dropDuplicates(["type", "key", "channel", "value"])
    return joined.where("_resolved IS NULL").selectExpr(*columns).unionByName(repaired)

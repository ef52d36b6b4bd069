"""Repair of conversations: the cheapest edits that make the roles alternate, by a run-length DP.

A row counts as one of sixteen symbols: its role's initial (s, u, a, other) and its first fault. What stands
before it is one of four states (nothing, s, u, a), so a symbol is a min-plus 4 x 4 transition of costs.
Equal consecutive symbols are one run; the costs before a run come from those behind it by cached binary powers of
the transition, and only then are the choices unrolled, front to back, the ASCII-least of the cheapest.

Conversations may be of any length. Rows are sorted by ranges of (conversation, turn) and cut into blocks; a block
stands for all its rows by one transition. Blocks are chained backwards (costs behind each block) and, once
every block has been unrolled by itself, forwards (state and place before each block). One task never sees more of a
conversation than a block of rows or a few numbers for each block, but for the audit itself, which is one value.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from .scratch import Scratch

BLOCK_ROWS = 8192
RARELY = 4096
_SPACE = " \t\n\x0b\f\r"

# The edits' costs.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

NONE, BLANK, DUPLICATE, CUT = range(4)
_CLASSES = "sua"
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: State after a row that is inserted or gets another role, by the state before: user, but assistant after user.
_NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
_ALLOWED = {("s", "u"), ("u", "a"), ("a", "u")}
_FAR = 1 << 60
#: Costs of what is still to insert when all rows are done: nothing or an even dialogue may stand.
FINAL = (0, 2 * INSERT, INSERT, 0)


def symbol(initial: str, fault: int) -> int:
    return 4 * (_CLASSES.find(initial) if initial in _CLASSES and initial else 3) + fault


def _keeps(role: int, state: int) -> bool:
    """Whether a row of this role may stand behind the state as it is."""
    return (role == 0 and state == START) or (role == 1 and state != AFTER_U) or (role == 2 and state == AFTER_U)


def _edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row, or before it, in ASCII order: initial, cost, state after the edit."""
    role, fault = divmod(code, 4)
    out = [("D", DELETE, state), ("I", INSERT, _NEXT[state])]
    if fault in (NONE, CUT):
        more = TRUNCATED if fault == CUT else 0
        if _keeps(role, state):
            out.append(("K", KEEP + more, (AFTER_S, AFTER_U, AFTER_A)[role]))
        out.append(("R", REROLE + more, _NEXT[state]))
    return out


def _times(left: tuple, right: tuple) -> tuple:
    """Min-plus product of 4 x 4 costs."""
    columns = list(zip(*right, strict=True))
    return tuple(tuple(min(min(a + b for a, b in zip(row, column, strict=True)), _FAR) for column in columns) for row in left)


@lru_cache(maxsize=None)  # sixteen symbols, at most 64 powers
def power(code: int, k: int) -> tuple:
    """Costs from state to state over 2 ** k rows of one symbol."""
    if k:
        half = power(code, k - 1)
        return _times(half, half)
    edits = [[_FAR] * 4 for _ in range(4)]
    inserts = [[0 if p == q else _FAR for q in range(4)] for p in range(4)]
    for state in range(4):
        for name, cost, after in _edits(code, state):
            table = inserts if name == "I" else edits
            table[state][after] = min(table[state][after], cost)
    many = _times(inserts, inserts)  # any number: from each state three lead everywhere that inserting leads
    return _times(_times(many, many), edits)


@lru_cache(maxsize=RARELY)
def _before(code: int, k: int, after: tuple) -> tuple[int, tuple]:
    """Costs before 2 ** k rows for the costs behind them, as their least and what is above it."""
    costs = [min(min(a + b for a, b in zip(row, after, strict=True)), _FAR) for row in power(code, k)]
    least = min(costs)
    return least, tuple(c - least if c < _FAR else _FAR for c in costs)


def costs_before(code: int, rows: int, after: tuple[int, tuple]) -> tuple[int, tuple]:
    """Costs before a run of equal symbols: a binary power for each set bit of its length."""
    base, costs = after
    for k in range(rows.bit_length()):
        if rows >> k & 1:
            more, costs = _before(code, k, costs)
            base += more
    return base, costs


def _split(costs: tuple) -> tuple[int, tuple]:
    least = min(costs)
    return least, tuple(c - least if c < _FAR else _FAR for c in costs)


@lru_cache(maxsize=RARELY)
def _choice(code: int, behind: tuple, state: int) -> tuple[str, int]:
    """The edits of one row (insertions before it too) and the state after it, for the costs behind it."""
    base, costs = _before(code, 0, behind)
    out = ""
    while True:
        for edit, cost, after in _edits(code, state):
            # an insertion leaves the row to be dealt with
            rest = base + costs[after] if edit == "I" else behind[after]
            if cost + rest == base + costs[state]:
                out, state = out + edit, after
                break
        if edit != "I":
            return out, state


def runs_of(codes: list[int], counts: list[int]) -> list[tuple[int, int]]:
    """Runs of equal symbols: each row's own, and one for the further copies of a repeated row."""
    rows = []
    for code, n in zip(codes, counts, strict=True):
        rows.append((code, 1))
        if n > 1:
            rows.append((code // 4 * 4 + (BLANK if code % 4 == BLANK else DUPLICATE), n - 1))
    return [(code, sum(n for _, n in group)) for code, group in groupby(rows, key=lambda r: r[0])]


def transition(runs: list[tuple[int, int]]) -> list[int]:
    """Costs from state to state over all runs, row by row; from each state behind them by itself."""
    columns = []
    for state in range(4):
        costs = (0, tuple(0 if s == state else _FAR for s in range(4)))
        for code, n in reversed(runs):
            costs = costs_before(code, n, costs)
        columns.append([min(costs[0] + c, _FAR) for c in costs[1]])
    return [columns[after][state] for state in range(4) for after in range(4)]


def unroll(runs: list[tuple[int, int]], after: tuple, last: bool, states: range = range(4)) -> list[tuple[str, int]]:
    """For each state before the runs: the ASCII-least of the cheapest audits, and the state behind them."""
    behind = [_split(after)]
    for code, n in reversed(runs):
        behind.append(costs_before(code, n, behind[-1]))
    behind.pop()
    audits, now = [[] for _ in states], list(states)
    for (code, n), (_, costs) in zip(runs, reversed(behind), strict=True):
        inside = [costs]
        for _ in range(n - 1):
            inside.append(_before(code, 0, inside[-1])[1])
        for costs in reversed(inside):
            for i, state in enumerate(now):
                edits, now[i] = _choice(code, costs, state)
                audits[i].append(edits)
    if last:  # an unfinished dialogue is finished
        for i, state in enumerate(now):
            audits[i].append("I" * (FINAL[state] // INSERT))
            now[i] = START if state == START else AFTER_A
    return [("".join(a), s) for a, s in zip(audits, now, strict=True)]


def _summary(runs: list[tuple[int, int]], turns: list) -> dict:
    """What a block adds to the report of its conversation."""
    faults = [0] * 4
    illegal = 0
    for code, n in runs:
        faults[code % 4] += n
    classes = [(key, sum(n for _, n in group)) for key, group in groupby(runs, key=lambda r: r[0] // 4)]
    for key, n in classes:
        illegal += n - 1
    names = ["sua-"[key] for key, _ in classes]
    illegal += sum(pair not in _ALLOWED for pair in pairwise(names))
    known = [t for t in turns if t is not None]
    return {
        "blank": faults[BLANK],
        "duplicate": faults[DUPLICATE],
        "truncated": faults[CUT],
        "illegal": illegal,
        "first": names[0],
        "final": names[-1],
        "low": known[0] if known else None,
        "high": known[-1] if known else None,
        "distinct": len(set(known)),
    }


_SUMMARY = [(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")]
_SUMMARY += [("first", pa.string()), ("final", pa.string())]


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _mapped(df: DataFrame, make, schema: pa.Schema, size: int = 1000) -> DataFrame:
    """``df`` through a function from rows to rows, a partition at a time, in batches of ``size`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(make(_rows(batches)), schema, size)

    return df.mapInArrow(run, from_arrow_schema(schema))


def _keyed(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (null role and text: one space), digest: equal for equal texts only."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.sha2(text, 256).alias("digest"))


def _symbols(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct rows (conv_id, turn, role, digest) with their number n and the symbol of the first of them."""
    last = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    faulted = _keyed(rows).withColumn("fault", F.when(last == "", BLANK).when(last.isin(".", "!", "?"), NONE).otherwise(CUT))
    grouped = faulted.groupBy("conv_id", "turn", "role", "digest").agg(F.count("*").alias("n"), F.first("fault").alias("fault"))
    distinct = scratch.table(grouped, "distinct-rows")
    # nulls first, as the rows are ordered
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = distinct.groupBy("conv_id", "role", "digest").agg(F.count("*").alias("times"), F.min(place).alias("first_place"))
    again = again.where("times > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first_place"
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    repeated = F.col("first_place").isNotNull() & (F.col("first_place") != place) & (F.col("fault") != BLANK)
    fault = F.when(repeated, DUPLICATE).otherwise(F.col("fault"))
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    code = (4 * kind + fault).cast("int").alias("code")
    return distinct.join(again, same, "left").select("conv_id", "turn", "role", "digest", "n", code)


def _block_fields(conv: pa.DataType, turn: pa.DataType) -> list[tuple[str, pa.DataType]]:
    lists = [("turns", pa.list_(turn)), ("roles", pa.list_(pa.string())), ("digests", pa.list_(pa.string()))]
    lists += [("counts", pa.list_(pa.int64())), ("codes", pa.list_(pa.int32())), ("matrix", pa.list_(pa.int64()))]
    known = [("low", turn), ("high", turn), ("distinct", pa.int64())]
    return [("conv_id", conv), ("block", pa.int64()), *lists, *_SUMMARY, *known]


def _blocks(symbols: DataFrame, size: int, types: tuple) -> DataFrame:
    """Rows in their order, cut at conversations and after ``size`` distinct rows; blocks are numbered in order."""

    def cut(rows: Iterator[dict]) -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 32
        for conv, own in groupby(rows, key=lambda r: r["conv_id"]):
            while part := [row for _, row in zip(range(size), own, strict=False)]:
                codes, counts, turns = ([r[c] for r in part] for c in ("code", "n", "turn"))
                runs = runs_of(codes, counts)
                yield {
                    "conv_id": conv,
                    "block": number,
                    "turns": turns,
                    "roles": [r["role"] for r in part],
                    "digests": [r["digest"] for r in part],
                    "counts": counts,
                    "codes": codes,
                    "matrix": transition(runs),
                    **_summary(runs, turns),
                }
                number += 1

    order = ["conv_id", "turn", "role", "digest"]
    ordered = symbols.repartitionByRange(*order).sortWithinPartitions(*order)
    return _mapped(ordered, cut, pa.schema(_block_fields(*types)), 64)


def _chained_back(blocks: DataFrame) -> DataFrame:
    """block, after (costs behind it by state) and last (whether none of its conversation follows)."""

    def chain(rows: Iterator[dict]) -> Iterator[dict]:
        for _, own in groupby(rows, key=lambda r: r["conv_id"]):
            after, last = FINAL, True
            for row in own:
                yield {"number": row["block"], "after": after, "last": last}
                matrix = row["matrix"]
                after = tuple(min(a + b for a, b in zip(matrix[4 * s : 4 * s + 4], after, strict=True)) for s in range(4))
                last = False

    ordered = blocks.select("conv_id", "block", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    return _mapped(ordered, chain, pa.schema([("number", pa.int64()), ("after", pa.list_(pa.int64())), ("last", pa.bool_())]))


def _unrolled(blocks: DataFrame, types: tuple) -> DataFrame:
    """Blocks with audits and states behind them, for each state before them, and the costs of the whole rest."""

    def each(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            runs = runs_of(row["codes"], row["counts"])
            found = unroll(runs, tuple(row["after"]), row["last"])
            matrix = row["matrix"]
            cost = min(a + b for a, b in zip(matrix[:4], row["after"], strict=True))
            yield {**row, "audits": [a for a, _ in found], "ends": [s for _, s in found], "cost": cost}

    more = [("audits", pa.list_(pa.string())), ("ends", pa.list_(pa.int32())), ("cost", pa.int64())]
    kept = [field for field in _block_fields(*types) if field[0] != "matrix"]
    return _mapped(blocks, each, pa.schema([*kept, *more]), 64)


def _chained(unrolled: DataFrame, types: tuple) -> DataFrame:
    """number, state and place before each block; on the last of a conversation its report."""
    counts = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    report = pa.struct([*counts, ("audit", pa.string())])
    place = [("number", pa.int64()), ("state", pa.int32()), ("place", pa.int64())]
    schema = pa.schema([("conv_id", types[0]), *place, ("report", report)])

    def chain(rows: Iterator[dict]) -> Iterator[dict]:
        for conv, own in groupby(rows, key=lambda r: r["conv_id"]):
            state, place, audits, out, before = START, 0, [], None, None
            low = high = None
            distinct = 0
            sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
            for row in own:
                if out:
                    yield out
                else:
                    cost = row["cost"]
                out = {"conv_id": conv, "number": row["block"], "state": state, "place": place, "report": None}
                audit = row["audits"][state]
                place += len(audit) - audit.count("D")
                audits.append(audit)
                state = row["ends"][state]
                for name in sums:
                    sums[name] += row[name]
                sums["illegal"] += before is not None and (before, row["first"]) not in _ALLOWED
                before = row["final"]
                if row["low"] is not None:
                    distinct += row["distinct"] - (high == row["low"])
                    low = row["low"] if low is None else low
                    high = row["high"]
            gaps = 0 if low is None else high - low + 1 - distinct
            yield {**out, "report": {"gaps": gaps, **sums, "cost": cost, "audit": "".join(audits)}}

    columns = ["conv_id", "block", "audits", "ends", "cost", *[n for n, _ in _SUMMARY], "low", "high", "distinct"]
    ordered = unrolled.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return _mapped(ordered, chain, schema)


def _standing(unrolled: DataFrame, types: tuple) -> DataFrame:
    """Rows that stand after the repair: conv_id, place, edit, new_role, and of rows that aren't new their key."""
    conv, turn = types
    names = [("edit", pa.string()), ("new_role", pa.string()), ("turn", turn), ("role", pa.string()), ("digest", pa.string())]
    schema = pa.schema([("conv_id", conv), ("place", pa.int64()), *names])

    def each(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            state, place, audit = row["state"], row["place"], row["audits"][row["state"]]
            at, copies = -1, 0
            for edit in audit:
                if edit == "I":
                    own = {"edit": "I", "turn": None, "role": None, "digest": None}
                elif copies > 0:  # a further copy, which is always deleted
                    copies -= 1
                    continue
                else:
                    at += 1
                    copies = row["counts"][at] - 1
                    if edit == "D":
                        continue
                    own = {"edit": edit, "turn": row["turns"][at], "role": row["roles"][at], "digest": row["digests"][at]}
                if edit == "K":
                    role = own["role"]
                    state = (AFTER_S, AFTER_U, AFTER_A)[_CLASSES.index(role[0])]
                else:
                    state = _NEXT[state]
                    role = "assistant" if state == AFTER_A else "user"
                yield {"conv_id": row["conv_id"], "place": place, "new_role": role, **own}
                place += 1

    return _mapped(unrolled, each, schema, 4096)


def repair_conversations(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Reports and messages of the repaired conversations in ``rows`` (conv_id, turn, role, text).

    Reports have a row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit. Messages have a row per
    message that stands: conv_id, place (from 0), edit (K, R or I), role, text.

    Rows are taken by turn, nulls first; of one turn by role, then by the hash of the text. Null roles and texts count
    as one space; a role that doesn't begin with s, u or a can't be kept. A repeated row is a duplicate of the
    first. Null conv_ids are one conversation. A conversation whose rows are all deleted has a report and no messages.
    An empty table gives two empty results. Other columns, whatever their names, are ignored.
    """
    scratch = Scratch(rows.sparkSession, "conversation-repair")
    types = tuple(to_arrow_type(rows.schema[c].dataType) for c in ("conv_id", "turn"))
    blocks = scratch.table(_blocks(_symbols(rows, scratch), block_rows, types), "blocks")
    same_block = F.col("block") == F.col("number")
    unrolled = scratch.table(_unrolled(blocks.join(_chained_back(blocks), same_block), types), "unrolled")
    chained = scratch.table(_chained(unrolled, types), "chained")
    reports = chained.where("report IS NOT NULL").select("conv_id", "report.*")
    placed = unrolled.join(chained.select("number", "state", "place"), same_block)
    standing = _standing(placed, types).alias("s")
    texts = _keyed(rows).groupBy("conv_id", "turn", "role", "digest").agg(F.first("text").alias("text")).alias("t")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("conv_id", "turn", "role", "digest")]
    joined = standing.join(texts, same[0] & same[1] & same[2] & same[3], "left")
    text = F.coalesce("t.text", F.lit(""))
    messages = joined.select("s.conv_id", "s.place", "s.edit", F.col("s.new_role").alias("role"), text.alias("text"))
    return reports, messages


def text_digests(messages: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the lines ``role:text`` of a conversation in their order, joined by newlines.

    A hash runs through its text from front to end: a conversation's lines stream through one task, one by one.
    """
    schema = pa.schema([("conv_id", to_arrow_type(messages.schema["conv_id"].dataType)), ("repaired_sha256", pa.string())])

    def digest(rows: Iterator[dict]) -> Iterator[dict]:
        from hashlib import sha256

        for conv, own in groupby(rows, key=lambda r: r["conv_id"]):
            whole, between = sha256(), ""
            for row in own:
                whole.update(f"{between}{row['role']}:{row['text']}".encode("utf-8", "surrogatepass"))
                between = "\n"
            yield {"conv_id": conv, "repaired_sha256": whole.hexdigest()}

    lines = messages.select("conv_id", "place", "role", "text").repartition("conv_id")
    return _mapped(lines.sortWithinPartitions("conv_id", "place"), digest, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults: by crc32(``conv_id:turn``) % 20 a row is dropped (0), its text
    emptied (1) or without ``.!?`` (2), it is repeated (3), or its role is user (4). Nulls count as one space."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    drawn: Column = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    hurt = rows.select(
        "conv_id",
        "turn",
        F.when(drawn == 4, "user").otherwise(role).alias("role"),
        F.when(drawn == 1, "").when(drawn == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        drawn.alias("drawn"),
    )
    copies = F.array_repeat(F.lit(0), F.when(F.col("drawn") == 3, 2).otherwise(1))
    return hurt.where("drawn <> 0").withColumn("copy", F.explode(copies)).drop("drawn", "copy")


def damage_and_repair(rows: DataFrame) -> DataFrame:
    """A row per conv_id of ``rows``: the report of its damaged rows and the hash of the repaired text."""
    reports, messages = repair_conversations(damaged(rows))
    zero = {n: F.lit(0).cast("long") for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    default = {**zero, "audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    out = rows.select("conv_id").distinct().alias("r")
    for side in (reports, text_digests(messages)):
        own = side.withColumnRenamed("conv_id", "own_id")
        out = out.join(own, F.col("r.conv_id").eqNullSafe(F.col("own_id")), "left").drop("own_id").alias("r")
    return out.select("conv_id", *[F.coalesce(c, value).alias(c) for c, value in default.items()])

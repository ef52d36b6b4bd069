"""Splitting amounts so that the rounded parts of every row sum to the rounded amount.

Each part is cut down to whole cents; what is then missing goes, a cent each, to the parts with the largest
remainders (equal remainders: by channel). All of it happens inside one row's array of receivers: no row meets
another, nothing is shuffled, and the order of rows or partitions can't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marginloom.types import MONEY, cast, text

#: Shares below ten; with an amount in cents their product is exact.
CENT_SHARE = "DECIMAL(13,12)"
_CENTS, CENT_MONEY = "DECIMAL(20,2)", "DECIMAL(20,2)"
#: Shares are rounded at 12 digits: so near to one they mean the whole amount.
NEARLY_WHOLE = "0.000000001"


def receiver(channel: str, share: str) -> str:
    """An element of a receivers' array, as SQL text."""
    return f"struct({channel} AS channel, {cast(share, CENT_SHARE)} AS share)"


def receivers_of(shares: DataFrame, **arrays: str) -> DataFrame:
    """A table of one row per channel as a single row of arrays, by name that of a column of shares.

    By default ``receivers`` of the column share. Channels without a share are left out. Several arrays come from one
    pass, while a subquery for each would be computed by itself.
    """
    arrays = arrays or {"receivers": "share"}
    listed = lambda share: f"collect_list({receiver('channel', share)}) FILTER (WHERE {share} IS NOT NULL)"
    return shares.agg(*[F.expr(f"array_sort({listed(share)}) AS {name}") for name, share in arrays.items()])


def spread_in_cents(rows: DataFrame, receivers: str, rest: str, amount: str = "amount") -> DataFrame:
    """Each row of ``rows`` once per receiver: its other columns, ``amount`` in whole cents, ``channel``.

    ``receivers``: SQL text of an array of ``receiver``. Where the shares sum to one, the parts sum to the amount
    rounded to cents; otherwise to the rounded product of the amount and the sum. A row that nobody receives stays
    whole under the channel ``rest``; a NULL amount stays NULL for every receiver.
    """
    kept = [f"`{c}`" for c in rows.columns if c not in (amount, "channel")]
    whole = f"array({receiver(text(rest), '1')})"
    takers = f"if(coalesce(size({receivers}), 0) > 0, {receivers}, {whole})"
    hundredfold = cast(f"{cast(amount, MONEY)} * 100", _CENTS)
    rows = rows.selectExpr(*kept, f"{takers} AS _takers", f"{hundredfold} AS _hundredfold")
    # most rows have one receiver of all of it, and then there is nothing to cut or to compare
    alone = "size(_takers) = 1 AND _takers[0].share = 1"
    rounded = cast("round(_hundredfold)", "DECIMAL(22,0)")
    # the product once, the floor once; sort_array orders structs itself, array_sort by a function of two
    exact = "transform(_takers, r -> struct(_hundredfold * r.share AS part, r.channel AS channel))"
    floors = f"transform({exact}, e -> struct(e.part AS part, e.channel AS channel, floor(e.part) AS low))"
    cut = f"sort_array(transform({floors}, e -> struct(e.low - e.part AS behind, e.channel AS channel, e.low AS low)))"
    total = f"aggregate(_takers, {cast('0', 'DECIMAL(20,12)')}, (s, r) -> {cast('s + r.share', 'DECIMAL(20,12)')})"
    # amounts times the sum of other than whole shares: below 10 ** 15 with nine digits, which is exact
    odd = f"round(_hundredfold * {cast('t', 'DECIMAL(17,12)')})"
    target = f"get(transform(array({total}), t -> {cast(f'if(abs(t - 1) < {NEARLY_WHOLE}, round(_hundredfold), {odd})', 'DECIMAL(22,0)')}), 0)"
    split = rows.selectExpr(
        *kept, "_takers", f"if({alone}, {rounded}, {target}) AS _target", f"if({alone}, NULL, {cut}) AS _parts"
    )
    lows = f"aggregate(_parts, {cast('0', 'DECIMAL(22,0)')}, (s, p) -> {cast('s + p.low', 'DECIMAL(22,0)')})"
    missing = split.selectExpr(*kept, "_takers", "_target", "_parts", f"if(_parts IS NULL, 0, CAST(_target - {lows} AS INT)) AS _missing")
    money_of = lambda cents: f"{cast(f'({cents}) * 0.01', CENT_MONEY)} AS {amount}"
    many = f"transform(_parts, (p, i) -> struct({money_of('p.low + if(i < _missing, 1, 0)')}, p.channel AS channel))"
    one = f"array(struct({money_of('_target')}, _takers[0].channel AS channel))"
    return missing.selectExpr(*kept, f"inline(if(_parts IS NULL, {one}, {many}))")

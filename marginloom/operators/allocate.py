"""Splitting amounts over channels by shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marginloom.types import ALLOCATED, SHARE, cast, money, ratio, text, texts


def channel_array(channels: list[str]) -> str:
    return f"array({texts(channels)})"


def share_table(
    df: DataFrame, channels: list[str], amount: str = "amount", also: dict[str, list[str]] | None = None
) -> DataFrame:
    """``channel, share``: part of each listed channel in their common total, one row per channel.

    One global sum with partial sums on the map side. A channel without rows, or a zero
    total, gives a NULL share. ``also`` adds share columns over fewer channels (NULL for the
    others) from the same sums.
    """
    part = {c: f"_s{i}" for i, c in enumerate(channels)}
    sums = df.where(f"channel IN ({texts(channels)})").selectExpr(
        *[f"sum({amount}) FILTER (WHERE channel = {text(c)}) AS {s}" for c, s in part.items()]
    )
    tables = {"share": channels, **(also or {})}
    total = {name: "(" + " + ".join(f"coalesce({part[c]}, 0)" for c in group) + ")" for name, group in tables.items()}

    def row(channel: str) -> str:
        shares = [
            f"{text(name)}, {ratio(part[channel] if channel in group else 'NULL', total[name])}"
            for name, group in tables.items()
        ]
        return f"named_struct('channel', {text(channel)}, {', '.join(shares)})"

    return sums.selectExpr(f"inline(array({', '.join(row(c) for c in channels)}))")


def _other_columns(df: DataFrame, *replaced: str) -> list[str]:
    return [f"`{c}`" for c in df.columns if c not in replaced]


def allocate_by_share(df: DataFrame, shares: DataFrame, channels: list[str], amount: str = "amount") -> DataFrame:
    """Each row once per listed channel, its amount times the channel's share.

    ``shares`` comes from ``share_table`` and has one row per listed channel, which is what
    makes the broadcast safe. The fact rows are read once, not once per channel.
    """
    kept = _other_columns(df, "channel", amount)
    spread = df.selectExpr(*kept, amount, f"explode({channel_array(channels)}) AS channel")
    value = cast(f"{money(amount)} * share", ALLOCATED)
    return spread.join(F.broadcast(shares), "channel", "left").selectExpr(*kept, f"{value} AS {amount}", "channel")


def allocate_fixed(df: DataFrame, shares: dict[str, str], amount: str = "amount") -> DataFrame:
    """Each row once per channel, its amount times a constant share."""
    kept = _other_columns(df, "channel", amount)
    options = ", ".join(
        f"named_struct('channel', {text(c)}, 'share', {cast(text(s), SHARE)})" for c, s in shares.items()
    )
    spread = df.selectExpr(*kept, amount, f"inline(array({options}))")
    return spread.selectExpr(*kept, f"{cast(f'{money(amount)} * share', ALLOCATED)} AS {amount}", "channel")

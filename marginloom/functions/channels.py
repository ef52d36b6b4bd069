"""Channel rules on order numbers, and the paid status of an invoice."""

from __future__ import annotations

from dataclasses import dataclass

from marginloom.types import text

Prefixes = tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class OrderRules:
    """Prefix rules of one channel vocabulary; the labels belong to the user's data.

    ``plain`` applies to numbers without a dash, ``dashed`` to numbers with one; both are
    tried in the given order, so a longer prefix goes before a shorter one.
    """

    plain: Prefixes
    dashed: Prefixes
    no_order: str = "No SO"

    def channels(self) -> list[str]:
        labels = [label for _, label in self.plain + self.dashed] + [self.no_order]
        return list(dict.fromkeys(labels))


def prefix_branches(number: str, rules: Prefixes, also: str = "") -> str:
    """CASE branches, one per prefix, each under the condition ``also``."""
    return " ".join(f"WHEN {also}startswith({number}, {text(p)}) THEN {text(label)}" for p, label in rules)


def order_channel(number: str, rules: OrderRules) -> str:
    """Channel of an order number; missing or unknown numbers get ``rules.no_order``."""
    without_dash = f"instr({number}, '-') = 0 AND "
    return (
        f"CASE WHEN {number} IS NULL THEN {text(rules.no_order)} "
        f"{prefix_branches(number, rules.plain, without_dash)} "
        f"WHEN {without_dash}TRUE THEN {text(rules.no_order)} "
        f"{prefix_branches(number, rules.dashed)} ELSE {text(rules.no_order)} END"
    )


def order_channel_legacy(number: str, rules: OrderRules) -> str:
    """Older rule: the same prefixes, an empty text where nothing matches."""
    plain = f"CASE {prefix_branches(number, rules.plain)} ELSE '' END"
    dashed = f"CASE {prefix_branches(number, rules.dashed)} ELSE '' END"
    return f"if(instr({number}, '-') = 0, {plain}, {dashed})"


def paid_status(total: str, balance: str) -> str:
    """Paid / Partial / Not Paid; an unknown balance counts as Not Paid."""
    return f"CASE WHEN {balance} = 0 THEN 'Paid' WHEN {total} <> {balance} THEN 'Partial' ELSE 'Not Paid' END"

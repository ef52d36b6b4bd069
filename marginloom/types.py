"""Number types shared by every table, as Spark SQL text."""

MONEY = "DECIMAL(18,4)"
TOTAL_MONEY = "DECIMAL(28,4)"
QUANTITY = "DECIMAL(18,6)"
TOTAL_QUANTITY = "DECIMAL(28,6)"
# Shares are held at 12 decimals: money (scale 4) x share (scale 12) is an exact
# DECIMAL(37,16), so allocated amounts sum to the same value in any order.
SHARE = "DECIMAL(18,12)"
ALLOCATED = "DECIMAL(38,16)"


def cast(expr: str, kind: str) -> str:
    return f"CAST({expr} AS {kind})"


def money(expr: str) -> str:
    return cast(expr, MONEY)


def quantity(expr: str) -> str:
    return cast(expr, QUANTITY)


def text(value: str | None) -> str:
    """A text literal."""
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values) -> str:
    """A list of text literals for IN; an empty list matches nothing."""
    return ", ".join(text(v) for v in values) or "NULL"


def ratio(numerator: str, denominator: str) -> str:
    """Quotient of two exact sums as a SHARE; NULL when the base is zero or missing."""
    quotient = f"try_divide({cast(numerator, 'DOUBLE')}, {cast(denominator, 'DOUBLE')})"
    return cast(f"round({quotient}, 12)", SHARE)

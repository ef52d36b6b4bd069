"""Scalar functions: calendar keys, name parsing, channel rules, statuses.

Each takes and returns Spark SQL text, to be used in ``selectExpr``, ``where`` or ``expr``:
``df.selectExpr("*", f"{week_key('day')} AS year_week")``.
"""

from marginloom.functions.calendar import (
    as_date,
    in_later_week,
    iso_week_key,
    minutes_between,
    slash_date,
    wall_micros,
    week_end,
    week_key,
    week_number,
    week_start,
    week_text,
)
from marginloom.functions.channels import OrderRules, order_channel, order_channel_legacy, paid_status
from marginloom.functions.text import name_segment

__all__ = [
    "OrderRules",
    "as_date",
    "in_later_week",
    "iso_week_key",
    "minutes_between",
    "name_segment",
    "order_channel",
    "order_channel_legacy",
    "paid_status",
    "slash_date",
    "wall_micros",
    "week_end",
    "week_key",
    "week_number",
    "week_start",
    "week_text",
]

"""First event strictly after a point in time, per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BUCKET_SECONDS = 6 * 3600


def first_after(
    points: DataFrame,
    events: DataFrame,
    on: list[str],
    point_at: str,
    event_at: str,
    out: str,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """``points`` plus column ``out``: the smallest ``event_at`` above ``point_at``, or NULL.

    Times are microseconds; key columns must not be NULL. No pairs are built: points and
    events share one stream and a running minimum walks it from late to early. Every key is cut
    into time buckets, so a busy one is worked on by many tasks; what lies beyond a bucket comes
    from one row per key and bucket.
    """
    keys = ", ".join(on)
    marks = events.select(*on, event_at).distinct().selectExpr(*on, f"{event_at} AS _at", f"{event_at} AS _event")
    stream = points.selectExpr("*", f"{point_at} AS _at", "CAST(NULL AS BIGINT) AS _event").unionByName(
        marks, allowMissingColumns=True
    )
    stream = stream.selectExpr("*", f"_at DIV {bucket_seconds * 1_000_000} AS _bucket")
    # later rows first; at equal times the point goes first, so an equal event is not "after"
    inside = (
        f"min(_event) OVER (PARTITION BY {keys}, _bucket ORDER BY _at DESC, _event NULLS FIRST "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _inside"
    )
    beyond = (
        f"min(_first) OVER (PARTITION BY {keys} ORDER BY _bucket DESC "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _beyond"
    )
    # buckets without an event are there too: their points look at the later ones
    later = stream.groupBy(*on, "_bucket").agg(F.expr("min(_event) AS _first")).selectExpr(*on, "_bucket", beyond)
    return (
        stream.selectExpr("*", inside)
        .where("_event IS NULL")
        .join(later, [*on, "_bucket"], "left")
        .selectExpr(*points.columns, f"coalesce(_inside, _beyond) AS {out}")
    )

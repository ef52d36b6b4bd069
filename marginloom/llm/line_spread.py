"""Line dedup by distinct-site spread: lines that stand on many sites are boilerplate and go.

Per line hash (128 bits of the trimmed line) a HyperLogLog sketch counts the sites; sketches of a map task are
merged by the aggregation, so a line on every page costs one sketch per task. Estimates well above or below
the threshold decide; lines near it get an exact count of their distinct sites. The documents' lines then meet
the boilerplate lines in a join whose hot keys adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .rows import packed, row_key
from .scratch import Scratch

MIN_SITES = 10
SKETCH_BITS = 12
#: Share of the threshold within which an estimate is not trusted: six standard errors of the sketch.
NEAR = 0.1
_SPACE = " \t\n\x0b\f\r"


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """row, site, pos, k1, k2 of each line that isn't blank."""
    rows = docs.select(
        row_key(F.col("doc_id"), F.col("text")).alias("row"),
        F.col(site).cast("string").alias("site"),
        F.posexplode(_split(F.col("text"))).alias("pos", "line"),
    )
    line = F.btrim("line", F.lit(_SPACE))
    return rows.select(
        "row", "site", "pos", F.xxhash64(F.lit(1), line).alias("k1"), F.xxhash64(F.lit(2), line).alias("k2"), line.alias("line")
    ).where("line != ''").drop("line")


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate_lines(docs: DataFrame, site: str, min_sites: int, scratch: Scratch) -> DataFrame:
    """k1, k2 of the lines on at least ``min_sites`` distinct sites (a null site is none)."""
    lines = _lines(docs, site)
    sketch = F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch")
    spread = lines.groupBy("k1", "k2").agg(sketch).select("k1", "k2", F.hll_sketch_estimate("sketch").alias("sites"))
    low, high = min_sites - max(1, min_sites * NEAR), min_sites + max(1, min_sites * NEAR)
    likely = scratch.table(spread.where(F.col("sites") >= low), "likely-lines")
    near = likely.where(F.col("sites") <= high).select("k1", "k2")
    pairs = lines.select("k1", "k2", "site").join(near, ["k1", "k2"]).where("site IS NOT NULL").distinct()
    exact = pairs.groupBy("k1", "k2").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    sure = likely.where(F.col("sites") > high)
    return scratch.table(sure.select("k1", "k2").unionAll(exact.select("k1", "k2")), "boilerplate")


def drop_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with text less its boilerplate lines, and the columns n_lines and n_removed (blank lines count
    as lines and stay).

    Lines are compared without white space at their ends; null text counts as empty and stays null. A null
    site is no site. Repeated rows are all cleaned alike. If ``docs`` has columns named n_lines or n_removed,
    they are replaced; all other names are free. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "line-spread")
    found = _lines(docs, site).join(boilerplate_lines(docs, site, min_sites, scratch), ["k1", "k2"])
    # a set of line numbers of one text, so never larger than the text
    removed = found.groupBy("row").agg(F.collect_set("pos").alias("removed")).withColumnRenamed("row", "key")
    keyed = packed(docs, key=row_key(F.col("doc_id"), F.col("text"))).join(removed, "key", "left")
    joined = keyed.withColumn("lines", _split(F.col("row.text")))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    cleaned = F.array_join(F.transform(places, lambda i: F.col("lines")[i]), "\n")
    counts = {
        "n_lines": F.size("lines").cast("long").alias("n_lines"),
        "n_removed": F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    }
    made = counts | {"text": F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(cleaned).alias("text")}
    own = [made.get(c, F.col(f"row.`{c}`").alias(c)) for c in docs.columns]
    return joined.select(*own, *[value for name, value in counts.items() if name not in docs.columns])

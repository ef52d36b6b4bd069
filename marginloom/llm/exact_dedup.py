"""Exact dedup by deterministic block naming.

Each text, white space normalised, is cut into blocks of a fixed number of characters. The distinct blocks
are sorted into integer names; then adjacent names are paired and the distinct pairs sorted into integer
names again, until a document has one. Two documents of equal length in blocks have equal final names
exactly if their texts are equal, so (number of rounds, name) is an identity without collisions.

Blocks are compared by a 128-bit key in place of their content wherever rows move more than once. That the
key tells all blocks of the input apart is proven on the input itself, by one aggregate over the contents; if
it fails, the keys are drawn anew with the next seed. Equal blocks and pairs are combined before they are
shuffled; the joins that hand names back have an exchange on both sides, so that adaptive execution splits
the rows of a hot block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .rows import keep_rows, row_key
from .scratch import Scratch

BLOCK_CHARS = 2048
#: The sort runs in so many independent ranges; a name is its range and its rank there.
NAME_RANGES = 4096
_RANK_BITS = 40


def normalised(text) -> F.Column:
    """Null as empty; every run of ASCII white space as one space."""
    # single spaces, the usual case, are left alone
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _blocks(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """One row per block: id, digest, pos, n (blocks of the document), k1, k2, block."""
    texts = docs.select(F.col("doc_id").alias("id"), normalised(F.col("text")).alias("norm"))
    cut = F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    )
    cut_up = texts.select("id", F.unhex(F.sha2("norm", 256)).alias("digest"), cut.alias("blocks"))
    rows = cut_up.select(
        "id", "digest", F.size("blocks").cast("long").alias("n"), F.posexplode("blocks").alias("pos", "block")
    )
    return rows.select(
        "id",
        "digest",
        F.col("pos").cast("long").alias("pos"),
        "n",
        F.xxhash64(F.lit(2 * seed), "block").alias("k1"),
        F.xxhash64(F.lit(2 * seed + 1), "block").alias("k2"),
        "block",
    )


def _sorted_names(keys: DataFrame, *by: str) -> DataFrame:
    """Distinct rows ``by`` with the integer ``name`` of their place in the sort (from 1 in each range)."""
    ranged = keys.withColumn("range", F.pmod(F.xxhash64(*by), F.lit(NAME_RANGES)))
    rank = F.row_number().over(Window.partitionBy("range").orderBy(*by))
    name = F.shiftleft(F.col("range").cast("long"), _RANK_BITS) + rank
    return ranged.select(*keys.columns, name.alias("name"))


def _block_names(docs: DataFrame, scratch: Scratch, size: int) -> tuple[DataFrame, DataFrame]:
    """Names by key, and the occurrences of the keys in the documents."""
    seed = 0
    while True:
        blocks = _blocks(docs, size, seed)
        contents = blocks.select("k1", "k2", "block").distinct()
        keys = contents.groupBy("k1", "k2").agg(F.count("*").alias("contents"))
        names = scratch.table(_sorted_names(keys, "k1", "k2"), "block-names")
        if names.where("contents > 1").isEmpty():
            return names.drop("contents"), scratch.table(blocks.drop("block"), "blocks")
        seed += 1


def _identities(docs: DataFrame, scratch: Scratch, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, digest) of the input, and the identity (level, name) of each distinct one."""
    names, occurrences = _block_names(docs, scratch, size)
    rows = occurrences.where("pos = 0").select("id", "digest")
    level = 0
    named = scratch.table(
        occurrences.join(names, ["k1", "k2"]).select("id", "digest", "pos", "n", "name"), "level-0"
    )
    done = [named.where("n = 1").select("id", "digest", F.lit(level).alias("level"), "name").distinct()]
    blocks = named.agg(F.max("n")).first()[0] or 0
    while blocks > 1:
        level, blocks = level + 1, (blocks + 1) // 2
        half = F.expr("pos div 2")
        name_at = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = (
            named.where("n > 1")
            .groupBy("id", "digest", half.alias("pos"), F.expr("(n + 1) div 2").alias("n"))
            .agg(name_at(0).alias("a"), F.coalesce(name_at(1), F.lit(0)).alias("b"))  # 0 is no name: no right half
        )
        pair_names = _sorted_names(pairs.select("a", "b").distinct(), "a", "b")
        named = scratch.table(
            pairs.join(pair_names, ["a", "b"]).select("id", "digest", "pos", "n", "name"), f"level-{level}"
        )
        done.append(named.where("n = 1").select("id", "digest", F.lit(level).alias("level"), "name"))
    identities = done[0]
    for more in done[1:]:
        identities = identities.unionAll(more)
    return rows, identities


def exact_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text; others are ignored, whatever their names):
    doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and empty texts are equal like any other. Of equal texts the row with the
    smallest doc_id stays. A null doc_id is larger than any other: it stays only where all are null. Of
    repeated rows (same doc_id and text) one is marked as kept; each counts in group_size. Rows of one
    doc_id with different texts are different documents. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows, identities = _identities(docs, scratch, block_chars)
    rows, other = rows.alias("r"), identities.alias("i")
    same = F.col("r.id").eqNullSafe(F.col("i.id")) & (F.col("r.digest") == F.col("i.digest"))
    repeat = F.row_number().over(Window.partitionBy("id", "digest").orderBy("level"))
    named = scratch.table(
        rows.join(other, same).select("r.id", "r.digest", "level", "name").withColumn("repeat", repeat), "identities"
    )
    groups = named.groupBy("level", "name").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = scratch.table(groups, "groups")  # read back, the join has an exchange on both sides
    return named.join(groups, ["level", "name"]).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns.

    Of repeated rows of the kept doc_id that differ in other columns, the first by the hash of all columns stays.
    """
    kept = exact_dedup(docs, block_chars).where("kept")
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return keep_rows(
        docs, kept.select(F.concat_ws("/", doc_id, "text_sha256")), row_key(F.col("doc_id"), normalised(F.col("text")))
    )

"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked at a few differing bits.

Pigeonhole blocks: a fingerprint is cut into six blocks. If two differ in at most three bits, at least three
blocks are equal, so both meet in one of the twenty tables keyed by three blocks (32 bits on average; with
four blocks and one table each, keys of 16 bits would hold ever more fingerprints as the input grows). The
tables are joined on the key and the Hamming distance of each candidate is verified.

Only distinct fingerprints are joined, so exact copies cost nothing. A key shared by more than ``JOIN_LIMIT``
distinct fingerprints (a large group of near copies) would pair all of them: they are compared in one task,
which passes on a spanning forest of their links. Beyond ``GROUP_LIMIT`` the bits outside of the key are cut into
blocks and the key is lengthened by each choice of these, in the same way. About 16 bits are then free, 18 at most
for three differing bits, so that a group can't exceed their 2^18 values, however many documents there are; large
groups look up the values at each pattern of flipped bits instead of comparing pairs. A fingerprint is copied 20
times, and 20 times again for each hot key, at any size of the input. Classes are the connected components of the
links.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from .components import components
from .rows import keep_rows, row_key
from .scratch import Scratch, send_few_texts

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
#: Distinct fingerprints of one key that are joined pair by pair; beyond, they are compared in one task.
JOIN_LIMIT = 64
#: Distinct fingerprints of one key that are compared in one task; beyond, the key is lengthened.
GROUP_LIMIT = 2048
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_AT_ONCE = 1 << 15


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each shingle: words between ASCII white space, A-Z lower-cased, joined by one space."""
    # byte strings: split() without arguments cuts at exactly the six ASCII white-space characters
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    line, width = b" ".join(words), min(width, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(line[a:b], HASH_SEED) for a, b in spans), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit integer; zero for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _AT_ONCE):
        part = hashes[at : at + _AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(texts, width: int = SHINGLE_WORDS):
    @F.pandas_udf(LongType())
    def prints(column: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(shingle_hashes(t, width)) for t in column], dtype="int64")

    return prints(texts)


def _masks(places: list[int], max_bits: int, kept: int = 0) -> list[int]:
    """``kept`` and all but ``max_bits`` of 2 * ``max_bits`` blocks of the places (signed)."""
    edges = np.linspace(0, len(places), max(1, 2 * max_bits) + 1).round().astype(int)
    blocks = [sum(1 << p for p in places[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [kept | sum(chosen) for chosen in combinations(blocks, max(1, max_bits))]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _longer_masks(mask: int, max_bits: int) -> list[int]:
    mask %= 1 << 64
    return _masks([p for p in range(64) if not mask >> p & 1], max_bits, mask)


def _settle(step: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """The least member of each one's class; ``step`` gives the least label among a member's neighbours."""
    label = np.arange(n)
    while True:
        lower = np.minimum(label, step(label))
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _classes_by_pairs(prints: np.ndarray, max_bits: int) -> np.ndarray:
    n = len(prints)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= max_bits
    return _settle(lambda label: np.where(near, label[None, :].astype(np.int32), np.int32(n)).min(axis=1), n)


def _classes_by_flips(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """As by pairs, for distinct fingerprints that differ in few places only."""
    free = int(np.bitwise_or.reduce(prints ^ prints[0]))
    places = [p for p in range(64) if free >> p & 1]
    value, n = np.zeros(len(prints), np.int64), len(prints)
    for i, p in enumerate(places):
        value |= ((prints >> np.uint64(p)) & np.uint64(1)).astype(np.int64) << i
    who = np.full(1 << len(places), n)
    who[value] = np.arange(n)
    flips = [sum(1 << i for i in chosen) for k in range(1, max_bits + 1) for chosen in combinations(range(len(places)), k)]

    def step(label: np.ndarray) -> np.ndarray:
        least, known = np.full(n, n), np.append(label, n)
        for flip in flips:
            np.minimum(least, known[who[value ^ flip]], out=least)
        return least

    return _settle(step, n)


def _forest(prints: np.ndarray, max_bits: int, group_limit: int) -> pd.DataFrame:
    """Edges from each fingerprint to the first of its class among these."""
    label = (_classes_by_pairs if len(prints) <= group_limit else _classes_by_flips)(prints, max_bits)
    moved = label != np.arange(len(label))
    return pd.DataFrame({"a": prints[label][moved].view("<i8"), "b": prints[moved].view("<i8")})


def _met(tables: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Rows (t, k, fp) of keys that at least two fingerprints share, with their number n."""
    shared = scratch.table(tables.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1"), f"shared-{name}")
    return scratch.table(tables.join(shared, ["t", "k"]), name)


def _links(met: DataFrame, max_bits: int, join_limit: int, group_limit: int) -> DataFrame:
    """Links between the fingerprints of each key, or a spanning forest of them; columns a, b."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        return _forest(np.sort(rows["fp"].to_numpy().astype("<i8").view("<u8")), max_bits, group_limit)

    few = met.where(F.col("n") <= join_limit)
    left, right = few.select("t", "k", F.col("fp").alias("a")), few.select("t", "k", F.col("fp").alias("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    joined = left.join(right, ["t", "k"]).where(near).select("a", "b")
    many = met.where(F.col("n") > join_limit).select("t", "k", "fp")
    return joined.unionAll(many.groupBy("t", "k").applyInPandas(compare, "a long, b long"))


def fingerprint_links(prints: DataFrame, scratch: Scratch, max_bits: int, join_limit: int, group_limit: int) -> DataFrame:
    """Edges a, b between distinct fingerprints (column fp), with the components of all links."""
    masks = _masks(list(range(64)), max_bits)
    longer = [_longer_masks(m, max_bits) for m in masks]
    place = F.posexplode(F.array(*map(F.lit, masks))).alias("t", "mask")
    key = F.col("fp").bitwiseAND(F.col("mask")).alias("k")
    met = _met(prints.select("fp", place).select("t", key, "fp"), scratch, "keyed")
    hot = met.where(F.col("n") > group_limit)
    wider = F.array(*[F.array(*map(F.lit, ms)) for ms in longer])
    place = F.posexplode(wider[F.col("t")]).alias("u", "mask")
    again = hot.select("fp", "t", place).select((F.col("t") * len(longer[0]) + F.col("u")).alias("t"), key, "fp")
    links = _links(met.where(F.col("n") <= group_limit), max_bits, join_limit, group_limit)
    return links.unionAll(_links(_met(again, scratch, "keyed-again"), max_bits, join_limit, group_limit))


def simhash_classes(
    docs: DataFrame,
    width: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    join_limit: int = JOIN_LIMIT,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text; others are ignored): doc_id, fingerprint,
    component_id, row_key, class (a fingerprint that stands for the whole class).

    Null text counts as empty; a text without words has fingerprint zero and links like any other; a text of
    fewer words than a shingle has one shingle of all its words. Repeated rows each give a row. component_id is
    the smallest doc_id reachable over links of at most ``max_bits`` differing bits; null ids are passed over,
    and it is null only if all of the class are. An empty table gives an empty result.
    """
    send_few_texts(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "simhash")
    key = row_key(F.col("doc_id"), F.col("text"))
    printed = docs.select(F.col("doc_id").alias("doc_id"), key.alias("row_key"), fingerprints(F.col("text"), width).alias("fp"))
    printed = scratch.table(printed, "prints")
    links = fingerprint_links(printed.select("fp").distinct(), scratch, max_bits, join_limit, group_limit)
    roots = components(links, scratch).toDF("fp", "root")
    rooted = scratch.table(
        printed.join(roots, "fp", "left").select("doc_id", "row_key", "fp", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    ids = scratch.table(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return rooted.join(ids, "root").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "row_key",
        F.col("root").alias("class"),
    )


def drop_near_copies(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each class, that with the smallest doc_id, with all columns.

    Rows without doc_id come last; among rows of one doc_id the least row key stays, and among repeated rows
    the least hash of all columns.
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = simhash_classes(docs, width, max_bits).groupBy("class").agg(F.min(order).alias("first"))
    return keep_rows(docs, first.select("first.row_key"), row_key(F.col("doc_id"), F.col("text")))

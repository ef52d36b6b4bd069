"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all normalised benchmark texts.

A text is normalised byte by byte (A-Z to a-z, ASCII signs to spaces), its words are joined by single spaces and
the line is scanned once. Every match ends between two words, so its place is a range of word numbers; word
numbers lead back to places in the original text, which are looked up only in texts with a match.

The automaton goes to every worker, so its size is checked: windows are dealt by a hash into parts of at most
``PART_BYTES`` of text. One part is one scan; a larger benchmark takes a scan for each part, and what they find
is united, so the result is the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch

WIDTH = 10
#: Bytes of windows that one automaton holds; a worker needs up to about ninety times as much for it.
PART_BYTES = 4_000_000
_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _ALNUM else 32 for c in range(256))
#: Words of the original text: what the normal form keeps, and A-Z.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOUND = "struct<n_words:long,n_hit:long,items:array<string>,spans:array<struct<first:int,last:int,start:int,end:int>>>"
_SPAN = pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")])
_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))])


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def windows(words: list[bytes], width: int) -> set[bytes]:
    """Every ``width`` consecutive words, joined by spaces; all words if they are fewer; nothing if there are none."""
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


class Scanner:
    """Finds windows in texts; ``found``: pairs of a window and the id of an item that has it."""

    def __init__(self, found: list[tuple[str, str]]):
        import ahocorasick

        self.automaton, items = ahocorasick.Automaton(), {}
        for window, item in found:
            items.setdefault(window, []).append(item)
        for window, ids in items.items():
            # a space at either end: windows match whole words only
            self.automaton.add_word(f" {window} ", (window.count(" ") + 1, tuple(ids)))
        if items:
            self.automaton.make_automaton()

    def scan(self, text: str | None, before: dict | None = None) -> dict:
        """n_words, n_hit, items and spans of a text, with what an earlier part has found (``before``)."""
        words = normal_words(text)
        out = {"n_words": len(words), "n_hit": 0, "items": [], "spans": []}
        if not words:
            return out
        line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        matches = list(self.automaton.iter(line)) if len(self.automaton) else []
        if not matches:
            return before or out
        items = set(before["items"]) if before else set()
        edges = np.zeros(len(words) + 1, np.int64)
        for span in before["spans"] if before else ():
            edges[span["first"]] += 1
            edges[span["last"] + 1] -= 1
        # a match ends at the space after its last word; before it stand as many spaces as words
        spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4") == 32)
        after = np.searchsorted(spaces, [end for end, _ in matches])
        for end, (_, (size, ids)) in zip(after.tolist(), matches, strict=True):
            edges[end - size] += 1
            edges[end] -= 1
            items.update(ids)
        hit = np.cumsum(edges[:-1]) > 0
        turns = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
        places = [m.span() for m in _WORD.finditer(text)]
        for first, past in turns.reshape(-1, 2).tolist():
            out["spans"].append({"first": first, "last": past - 1, "start": places[first][0], "end": places[past - 1][1]})
        out["n_hit"] = int(hit.sum())
        out["items"] = sorted(items, key=lambda i: i.encode("utf-8", "surrogatepass"))
        return out


_last: dict = {}


def _scanner(key: str, found: list[tuple[str, str]]) -> Scanner:
    """The scanner of the part that this worker looks for; only one is held."""
    if key not in _last:
        _last.clear()
        _last[key] = Scanner(found)
    return _last[key]


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """window, item: the windows of every row of ``items`` (item_id, text), ids as texts, null ids as empty ones."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, text in zip(ids, texts, strict=True):
                found = [w.decode("utf-8", "surrogatepass") for w in windows(normal_words(text.as_py()), width)]
                yield pa.RecordBatch.from_pydict({"window": pa.array(found, pa.string()), "item": pa.array([i] * len(found), pa.string())})

    ids = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    return items.select(ids.alias("item"), F.col("text").alias("text")).mapInArrow(cut, "window string, item string").distinct()


def _looked_through(rows: DataFrame, found: list[tuple[str, str]], key: str) -> DataFrame:
    """``rows`` with the column found, which holds what an earlier part has found too."""
    part = rows.sparkSession.sparkContext.broadcast(found)

    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        scanner = _scanner(key, part.value)
        return pa.array([scanner.scan(t.as_py(), b.as_py()) for t, b in zip(texts, before, strict=True)], _FOUND)

    before = F.col("found") if "found" in rows.columns else F.lit(None).cast(FOUND)
    return rows.select("row", F.arrow_udf(scan, FOUND)("row.text", before).alias("found"))


def find_passages(docs: DataFrame, items: DataFrame, width: int = WIDTH, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per row of ``docs`` (with a column text): row (a struct of all its columns) and found, a struct of

    n_words, n_hit (words inside a window of an item), items (ids of items with such windows, as texts, sorted)
    and spans (stretches of hit words: numbers of the first and last word, and start and end in code points of the
    original text). ``items``: item_id, text; other columns are ignored.

    A window is ``width`` consecutive words of an item, or all words of a shorter one. Null texts, and texts
    without words, have no words and no hits. Repeated rows of ``docs`` each give a row; repeated items count once,
    an id that stands for several texts counts as one item, null ids as an empty text. An empty table of items
    leaves every row without hits; an empty table of docs gives an empty result. All names of columns are free.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    cut = scratch.table(item_windows(items, width), "windows")
    # length of a window in bytes, and what an id takes beside it
    size = F.octet_length("window") + F.octet_length("item")
    total = cut.agg(F.sum(size).alias("b")).first().b or 0
    parts = max(1, -(-total // part_bytes))
    dealt = F.pmod(F.xxhash64("window", "item"), F.lit(parts))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    for k in range(parts):
        found = [tuple(r) for r in cut.where(dealt == k).collect()]
        rows = _looked_through(rows, found, f"{scratch.folder}/{k}")
        if k + 1 < parts:
            rows = scratch.table(rows, "looked-through")
    return rows


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` without a hit word, with all their columns."""
    return find_passages(docs, items, width).where("found.n_hit = 0").select("row.*")


def cut_passages(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """All rows of ``docs``, each hit stretch of a text replaced by one space."""
    found = find_passages(docs, items, width)
    text = F.aggregate(
        F.reverse("found.spans"),
        F.col("row.text"),
        lambda t, s: F.concat(F.substr(t, F.lit(1), s["start"]), F.lit(" "), F.substr(t, s["end"] + 1)),
    )
    return found.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])

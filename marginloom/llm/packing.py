"""Packing documents into sequences of a fixed number of tokens.

Documents are tokenised once and cut into pieces; what is packed are the pieces' lengths. Sum-of-squares
packing keeps, for every residual gap, the number of open sequences with that gap, and places a piece where
the sum of the squares of these numbers becomes smallest; longest pieces first, and a new sequence is opened
only where none has room. The state has one number per gap, so it doesn't grow with the input.

Pieces are dealt by their row number into groups of about ``GROUP_PIECES``, whose number grows with the
input; each group is packed by itself, in one bounded task. A group leaves about one badly filled
sequence in a few hundred, so the total stays within about half a percent of one group for all.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .rows import packed
from .scratch import Scratch, send_few_texts

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 8192
#: Chunks of text a worker remembers, none longer than ``LONG_CHUNK`` characters, so that the limit is one of bytes too;
#: at the limit it forgets those that aren't in use just then, which costs time only.
REMEMBERED, LONG_CHUNK = 400_000, 64
#: Words, and characters, of several texts that are looked up together.
WORDS_AT_ONCE, CHARS_AT_ONCE = 100_000, 4_000_000
#: Fixed value: how byte-level BPE with use_regex cuts texts into words.
WORD_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# a space that the next word does not take along, or a run of them
_ODD_SPACE = re.compile(r" (?:\s|\Z)")


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a visible character: itself if it has one, else from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class ByteTokenizer:
    """Ids of whole texts, as the tokenizers library gives them for the file.

    A space before a non-space always begins a new word of the tokenizer, so texts are cut there and each
    distinct chunk is encoded once, many at a time. If the file is a plain byte-level BPE whose ids follow the
    merges, as here, new chunks go to tiktoken's engine with the file's own vocabulary, several times as fast;
    chunks with special tokens, and those of other files, go to the tokenizers library.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as f:
            parts = json.load(f)
        self.special = [t["content"] for t in parts["added_tokens"]]
        self.fast = self._fast(parts)
        self.newline = self.fast.encode_ordinary("\n") if self.fast else []
        self.known: dict[str, bytes] = {}  # by chunk, without the space before it
        self.first: dict[str, bytes] = {}  # by chunk at the beginning of a text

    @staticmethod
    def _fast(parts: dict):
        before, model = parts["pre_tokenizer"] or {}, parts["model"]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", ())]
        if (
            parts["normalizer"]
            or any(before.get(k) != v for k, v in plain.items())
            or model.get("type") != "BPE"
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            or [model["vocab"].get(a + b) for a, b in merges] != list(range(256, 256 + len(merges)))
        ):
            return None
        import tiktoken

        byte = _byte_of_character()
        ranks = {bytes(byte[c] for c in word): i for word, i in model["vocab"].items()}
        return tiktoken.Encoding("file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, each by itself."""
        out: dict[str, bytes] = {}
        rest = chunks
        if self.fast:
            # one call for all of them: between chunks a newline, which is a word and an id of its own
            plain = [c for c in chunks if c[:1] == " " and "\n" not in c]
            joined = "\n".join(plain)
            if any(s in joined for s in self.special):
                plain = [c for c in plain if not any(s in c for s in self.special)]
                joined = "\n".join(plain)
            if plain and len(self.newline) == 1:
                ids = np.array(self.fast.encode_ordinary(joined), "<u4")
                ends = np.append(np.flatnonzero(ids == self.newline[0]), len(ids)).tolist()
                if len(ends) == len(plain):
                    data, bounds = ids.tobytes(), [-1, *ends]
                    out.update(zip(plain, [data[4 * a + 4 : 4 * b] for a, b in pairwise(bounds)], strict=True))
            rest = [c for c in chunks if c not in out]
            for chunk in rest:
                if not any(s in chunk for s in self.special):
                    out[chunk] = np.array(self.fast.encode_ordinary(chunk), "<u4").tobytes()
            rest = [c for c in rest if c not in out]
        if rest:
            found = self.tokenizer.encode_batch(rest, add_special_tokens=False)
            out.update((c, np.array(x.ids, "<u4").tobytes()) for c, x in zip(rest, found, strict=True))
        return [out[c] for c in chunks]

    @staticmethod
    def chunks(text: str) -> list[str]:
        parts = text.split(" ")
        if not _ODD_SPACE.search(text):
            return parts
        out = parts[:1]
        for part in parts[1:]:
            if part and not part[0].isspace():
                out.append(part)
            else:
                out[-1] += " " + part
        return out

    def _learn(self, known: dict[str, bytes], chunks: dict[str, None], before: str) -> dict[str, bytes]:
        new = [c for c in chunks if c not in known]
        if len(known) + len(new) > REMEMBERED:
            known = {c: known[c] for c in chunks if c in known}
        known.update(zip(new, self._encode([before + c for c in new]), strict=True))
        return known

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text; none for a null or empty text."""
        group, size, chars = [], 0, 0
        for text in texts:
            group.append(self.chunks(text) if text else None)
            size += len(group[-1] or ())
            chars += len(text or "")
            if size >= WORDS_AT_ONCE or chars >= CHARS_AT_ONCE:
                yield from self._encode_group(group)
                group, size, chars = [], 0, 0
        yield from self._encode_group(group)

    def _encode_group(self, group: list[list[str] | None]) -> Iterator[bytes]:
        later, begun = {}, {}
        for g in group:
            if g:
                begun[g[0]] = None
                later.update(dict.fromkeys(g[1:]))
        self.known, self.first = self._learn(self.known, later, " "), self._learn(self.first, begun, "")
        known, first = self.known.__getitem__, self.first
        for g in group:
            yield first[g[0]] + b"".join(map(known, g[1:])) if g else b""
        # long chunks, a text without spaces for one, hardly come again
        for table, chunks in ((self.known, later), (self.first, begun)):
            for chunk in chunks:
                if len(chunk) > LONG_CHUNK:
                    table.pop(chunk, None)


_tokenizers: dict[str, ByteTokenizer] = {}


def _tokenizer(file: str) -> ByteTokenizer:
    if file not in _tokenizers:
        _tokenizers[file] = ByteTokenizer(file)
    return _tokenizers[file]


def piece_lengths(tokens: int, capacity: int) -> list[int]:
    """Only documents that are too long are cut; then the first piece has what is left over."""
    if tokens <= capacity:
        return [tokens]
    rest = tokens % capacity
    return [rest] * (rest > 0) + [capacity] * (tokens // capacity)


def token_pieces(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids, of every row of ``docs``.

    A document's ids are those of its whole text (none if it is null or empty) and ``end_id``.
    """
    send_few_texts(docs.sparkSession)
    fields = [
        StructField("doc_id", docs.schema["doc_id"].dataType),
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
    ]
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_file)
        for batch in batches:
            rows: list[tuple] = []
            for i, ids in enumerate(tokenizer.encode(text.as_py() for text in batch.column(1))):
                ids += end
                start = 0
                for k, n in enumerate(piece_lengths(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + n)]
                    rows.append((i, k, start, n, zlib.crc32(own), own))
                    start += n
            at, *columns, own = zip(*rows, strict=True) if rows else [()] * 6
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [batch.column(0).take(pa.array(at, pa.int64()))]
            arrays += [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            names = [f.name for f in fields]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype("<i4") for x in own], pa.list_(pa.int32())))
                names = [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = StructType(fields)
    schema = kind.simpleString()[7:-1]
    return docs.select("doc_id", "text").mapInArrow(cut, schema + (",ids:array<int>" if with_ids else ""))


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, in the given order."""
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap; full ones are not counted
    sequence, offset, opened = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        if size == capacity:
            sequence[i], offset[i], opened = opened, 0, opened + 1
            continue
        # change of the sum of squares if the gap size + k becomes k
        change = 2 * (count[: capacity + 1 - size] - count[size:]) + 2
        change[0] = 1 - 2 * count[size]
        change[count[size:] == 0] = np.iinfo(np.int64).max
        k = int(change.argmin())
        if count[size + k]:
            gap = size + k
            count[gap] -= 1
            own = open_by_gap[gap].pop()
        else:
            gap, k, own, opened = capacity, capacity - size, opened, opened + 1
        sequence[i], offset[i] = own, capacity - gap
        if k:
            count[k] += 1
            open_by_gap[k].append(own)
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset: gapless sequences of at most ``capacity`` tokens.

    Needs a column length (1 to ``capacity``); other columns are passed on, whatever their names, but for
    sequence_id and offset, which are replaced. Rows that repeat, and ids that are null, are packed like any other.
    An empty table gives an empty result.
    """
    scratch = Scratch(pieces.sparkSession, "packing")
    pieces = pieces.drop("sequence_id", "offset")
    # the number is written with the row, so that it stays whatever is computed again
    rows = scratch.table(packed(pieces, number=F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-rows.count() // group_pieces))
    schema = StructType(
        [*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )

    def place(key: tuple, table: pa.Table) -> pa.Table:
        whole = pa.Table.from_batches([pa.RecordBatch.from_struct_array(c) for c in table.column("row").chunks])
        length, number = whole.column("length").to_numpy(), table.column("number").to_numpy()
        order = np.lexsort((number, -length))
        sequence, offset = pack_lengths(length[order], capacity)
        ids = pa.array(sequence + (int(key[0].as_py()) << 32))
        return whole.take(pa.array(order)).append_column("sequence_id", ids).append_column("offset", pa.array(offset))

    group = F.pmod(F.xxhash64("number"), F.lit(groups))
    return rows.withColumn("part", group).groupBy("part").applyInArrow(place, schema)

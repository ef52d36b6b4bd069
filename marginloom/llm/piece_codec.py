"""SentencePiece BPE encoding and decoding with numpy.

A normalised text falls into words at the first of each run of spaces, which no piece crosses. New words of a
batch are encoded together by vectorised merge rounds: all symbols lie in one flat array; each round finds the
best-ranked pair of every word (a segmented minimum), merges its occurrences from the left without overlap,
compacts the array, and sets words without a pair aside. The library merges one pair at a time, best score
first, leftmost among equals. Rounds give the same where a merge can't bring up a better pair than itself and
where no two pieces share a score; pieces for which either fails are merged one occurrence a round.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

SPACE = "▁"
#: Words a worker remembers, none longer than ``LONG_WORD`` characters, so that the limit is one of bytes too; at the
#: limit it forgets those that aren't in use just then, which costs time only.
REMEMBERED, LONG_WORD = 250_000, 64
#: Words, and characters, of several texts that are looked up together.
WORDS_AT_ONCE, CHARS_AT_ONCE = 100_000, 4_000_000
#: Symbols of new words that are encoded at once.
SYMBOLS_AT_ONCE = 1 << 20
_CODE_POINTS = 0x110000
_NONE = np.iinfo(np.int32).max

codecs.register_error("one-by-one", lambda e: ("�", e.start + 1))


class PieceCodec:
    """Encoder and decoder of one BPE model file with byte fallback and no normalisation."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self._check(model, pieces, normal)
        ids = {pieces[i]: i for i in normal}
        self.symbol_of = np.arange(n, n + _CODE_POINTS, dtype=np.int64)  # characters that aren't pieces stay apart
        for p, i in ids.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        self.n, self.width = n, n + _CODE_POINTS
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.surface = [p.replace(SPACE, " ").encode() for p in pieces]
        for b, i in enumerate(self.byte_ids):
            self.surface[i] = bytes([b])
        self.is_control = np.array([model.is_control(i) for i in range(n)])
        self.surface[model.unk_id()] = " ⁇ ".encode()
        #: ids whose text may begin with a space that is their own
        self.unspaced = frozenset([*self.byte_ids, model.unk_id()])
        self._pairs(ids, {i: model.get_score(i) for i in normal})
        self._space_runs(ids)
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _check(model, pieces: list[str], normal: list[int]) -> None:
        if any(SPACE in pieces[i].lstrip(SPACE) for i in normal):
            raise ValueError("a piece crosses a word boundary: words can't be encoded one by one")
        for probe, plain in (("a  b ", f"{SPACE}a{SPACE}{SPACE}b{SPACE}"), ("ﬁⅣ", f"{SPACE}ﬁⅣ")):
            if "".join(model.id_to_piece(model.encode(probe))).replace("<0xE2><0x85><0xA3>", "Ⅳ") != plain:
                raise ValueError("the model normalises texts; only the identity is supported")

    def _pairs(self, ids: dict[str, int], scores: dict[int, float]) -> None:
        """Sorted keys of all mergeable pairs, with the piece and rank of each."""
        ranks = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        symbol = lambda s: ids.get(s, int(self.symbol_of[ord(s)]) if len(s) == 1 else None)
        found = []
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    found.append((left * self.width + right, i, ranks[scores[i]], left, right))
        found.sort()
        columns = np.array(found, dtype=np.int64).reshape(-1, 5)
        self.keys, self.merged, self.ranks = columns[:, 0].copy(), columns[:, 1].copy(), columns[:, 2].astype(np.int32)
        rank_of = np.full(self.width, -1, np.int64)
        for i, s in scores.items():
            rank_of[i] = ranks[s]
        #: ranks whose merges are made one at a time
        self.single = np.zeros(len(ranks), bool)
        count = np.bincount([ranks[s] for s in scores.values()], minlength=len(ranks))
        self.single[count > 1] = True
        for end in (3, 4):
            made = rank_of[columns[:, end]]
            better = (made >= 0) & (columns[:, 2] < made)
            self.single[made[better]] = True

    def _space_runs(self, ids: dict[str, int]) -> None:
        """Runs of spaces have a closed form if their pieces come last: then the run is all that is left of them."""
        self.space = ids.get(SPACE, -1)
        runs = {len(p): i for p, i in ids.items() if not p.strip(SPACE)}
        spaces = np.array([runs[k] for k in runs], np.int64)
        of_runs = np.isin(self.merged, spaces)
        others = self.ranks[~of_runs]
        mixed = any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in ids)
        last = of_runs.any() and not mixed and (not len(others) or self.ranks[of_runs].min() > others.max())
        last = last and len(set(self.ranks[of_runs].tolist())) == 1
        self.longest, self.run_ids = max(runs, default=1), {}
        if not last:
            return
        cut = lambda n: [self.longest] * (n // self.longest) + self._merge_run(n % self.longest, runs)
        if all(cut(n) == self._merge_run(n, runs) for n in range(3 * self.longest + 1)):
            self.run_ids = {n: [runs[k] for k in self._merge_run(n, runs)] for n in range(self.longest + 1)}
            self.keys, self.merged, self.ranks = (x[~of_runs] for x in (self.keys, self.merged, self.ranks))

    @staticmethod
    def _merge_run(n: int, runs: dict[int, int]) -> list[int]:
        """Lengths of the pieces of n spaces, merged one leftmost pair at a time."""
        parts = [1] * n
        while at := [i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in runs]:
            parts[at[0] : at[0] + 2] = [parts[at[0]] + parts[at[0] + 1]]
        return parts

    # --- encoding ---

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and rank of each pair; rank _NONE where there is no such piece."""
        if not len(self.keys):
            return np.zeros(len(left), np.int64), np.full(len(left), _NONE, np.int32)
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        return self.merged[at], np.where(hit, self.ranks[at], _NONE)

    def _merge_words(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words after all merges, and the word of each; words must be in order."""
        done_symbols, done_words = [], []
        merged, rank = self._lookup(symbols[:-1], symbols[1:])
        rank = np.append(np.where(word[:-1] == word[1:], rank, _NONE), np.int32(_NONE))[: len(symbols)]
        merged = np.append(merged, 0)[: len(symbols)]
        while len(symbols):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(rank, first)
            if (best == _NONE).any():  # words without a pair are done
                live = np.repeat(best != _NONE, size)
                done_symbols.append(symbols[~live])
                done_words.append(word[~live])
                symbols, word, rank, merged = symbols[live], word[live], rank[live], merged[live]
                best, size = best[best != _NONE], size[best != _NONE]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            # of a run of overlapping pairs every second one, from the left
            run = np.flatnonzero(np.append(True, np.diff(at) != 1))
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            # of pairs that must be merged one at a time the leftmost of each word
            at = at[~self.single[rank[at]] | np.append(True, word[at[1:]] != word[at[:-1]])]
            symbols[at] = merged[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, rank, merged = symbols[keep], word[keep], rank[keep], merged[keep]
            # only the pairs that a merged symbol is part of are new
            made = at - np.arange(len(at))
            beside = np.zeros(len(symbols), bool)
            beside[made] = True
            beside[made[made > 0] - 1] = True
            touched = np.flatnonzero(beside)
            inner = touched[touched < len(symbols) - 1]
            new, new_rank = self._lookup(symbols[inner], symbols[inner + 1])
            rank[touched] = _NONE
            rank[inner] = np.where(word[inner] == word[inner + 1], new_rank, _NONE)
            merged[inner] = new
        word = np.concatenate(done_words) if done_words else word
        order = np.argsort(word, kind="stable")
        return (np.concatenate(done_symbols) if done_symbols else symbols)[order], word[order]

    def _fill_runs(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = symbols == self.space
        if not self.run_ids or not (space[1:] & space[:-1] & (word[1:] == word[:-1])).any():
            return symbols, word
        out, of = [], []
        change = np.flatnonzero(np.append(True, (symbols[1:] != symbols[:-1]) | (word[1:] != word[:-1])))
        for a, b in zip(change, np.append(change[1:], len(symbols)), strict=True):
            got = symbols[a:b].tolist()
            if space[a] and b - a > 1:
                got = [self.run_ids[self.longest][0]] * ((b - a) // self.longest) + self.run_ids[(b - a) % self.longest]
            out += got
            of += [word[a]] * len(got)
        return np.array(out, np.int64), np.array(of, np.int64)

    def _fall_back(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that aren't pieces as the pieces of their bytes."""
        odd = np.flatnonzero(symbols >= self.n)
        if not len(odd):
            return symbols, word
        as_bytes = [[self.byte_ids[b] for b in chr(int(symbols[i]) - self.n).encode()] for i in odd]
        count = np.ones(len(symbols), np.int64)
        count[odd] = [len(x) for x in as_bytes]
        out, start = np.repeat(symbols, count), np.cumsum(count) - count
        for i, got in zip(odd, as_bytes, strict=True):
            out[start[i] : start[i] + len(got)] = got
        return out, np.repeat(word, count)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of words that each begin with their run of SPACE."""
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        symbols, word = self._merge_words(self.symbol_of[points], word)
        symbols, word = self._fall_back(*self._fill_runs(symbols, word))
        data, ends = symbols.astype("<i4").tobytes(), (np.cumsum(np.bincount(word, minlength=len(words))) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _words(self, text: str) -> list[str]:
        """Words without their first space."""
        text = text.replace(SPACE, " ")
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in re.findall(" +[^ ]*", " " + text)]
        return text.split(" ")

    def _learn(self, words: list[str]) -> None:
        full, at, size = [SPACE + w.replace(" ", SPACE) for w in words], 0, 0
        for k, w in enumerate(full):
            size += len(w)
            if size >= SYMBOLS_AT_ONCE or k == len(full) - 1:
                self.known.update(zip(words[at : k + 1], self.encode_words(full[at : k + 1]), strict=True))
                at, size = k + 1, 0

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null text counts as empty. New words of some texts are learned together."""
        out, group, size, chars = [], [], 0, 0
        for text in texts:
            group.append(self._words(text or ""))
            size += len(group[-1])
            chars += len(text or "")
            if size >= WORDS_AT_ONCE or chars >= CHARS_AT_ONCE:
                out += self._encode_group(group)
                group, size, chars = [], 0, 0
        return out + self._encode_group(group)

    def _encode_group(self, group: list[list[str]]) -> list[np.ndarray]:
        distinct = dict.fromkeys(w for words in group for w in words)
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {w: self.known[w] for w in distinct if w in self.known}
        self._learn(new)
        known = self.known.__getitem__
        out = [np.frombuffer(b"".join(map(known, words)), "<i4") for words in group]
        for word in distinct:  # long words, a text without spaces for one, hardly come again
            if len(word) > LONG_WORD:
                del self.known[word]
        return out

    # --- decoding ---

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: surfaces joined, the space before the first word left out, broken bytes as U+FFFD."""
        ids = np.asarray(ids if isinstance(ids, np.ndarray) else list(ids), np.int64)
        parts = [ids]
        if self.is_control[ids].any():  # bytes on both sides of a control id don't form a character
            parts = [p[~self.is_control[p]] for p in np.split(ids, np.flatnonzero(self.is_control[ids]))]
        first = next((int(p[0]) for p in parts if len(p)), None)
        skip = first is not None and first not in self.unspaced and self.surface[first].startswith(b" ")
        surface = self.surface.__getitem__
        texts = [b"".join(map(surface, p.tolist())).decode("utf-8", "one-by-one") for p in parts]
        return "".join(texts)[skip:] if len(texts) > 1 else texts[0][skip:]


_codecs: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """One codec of a file per Python worker."""
    if model_file not in _codecs:
        _codecs[model_file] = PieceCodec(model_file)
    return _codecs[model_file]


def encode_pieces(text: Column, model_file: str) -> Column:
    """Ids of a text column as array<int>. Null and empty texts give no ids; texts are encoded whole."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(codec(model_file).encode(texts), dtype=object)

    return encode(text)


def decode_pieces(ids: Column, model_file: str) -> Column:
    """Text of an id column. Null and empty lists give the empty text; a null id is an error."""

    @F.pandas_udf(StringType())
    def decode(column: pd.Series) -> pd.Series:
        to_text = codec(model_file).decode
        return pd.Series(["" if x is None else to_text(x) for x in column], dtype=object)

    return decode(ids)


def round_trip(text: Column, model_file: str) -> Column:
    """Struct of the ids of a text column and the text they decode to, both made in one Python worker."""

    @F.pandas_udf("ids array<int>, decoded string")
    def both(texts: pd.Series) -> pd.DataFrame:
        own = codec(model_file)
        ids = own.encode(texts)
        return pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": [own.decode(x) for x in ids]})

    return both(text)

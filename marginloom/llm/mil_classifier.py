"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (windows of its UTF-8 bytes), of which only the whole has a label. Each
passage's hashed byte trigrams, and how much its words repeat, are encoded to a short vector; gated attention, softmax over the document of
w . (tanh(V h) * sigmoid(U h)), weights the passages, and the weighted mean of their vectors is scored.
Encoder, attention and score are learned together from the labels of documents, with Adam, on a bounded
sample of labelled documents (``SAMPLE_DOCS`` of at most ``SAMPLE_BYTES`` bytes each); every document is
scored over its whole text, passage block by passage block, so memory doesn't grow with a text's length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from .rows import packed
from .scratch import send_few_texts

PASSAGE_BYTES = 1024
TRIGRAMS = 1024
#: Besides trigrams: words, words like the one before, words like one of the four before, distinct trigrams.
FEATURES = TRIGRAMS + 4
HIDDEN = 32
ATTENTION = 16
SAMPLE_DOCS = 3000
SAMPLE_BYTES = 16 * 1024
EPOCHS = 25
BATCH = 64
LEARNING_RATE = 3e-3
KEEP_SCORE = 0.3
FOLDS = 5
_BLOCK = 1024
#: Numbers without a pattern: multiples of one number would give words alike whose bytes are shuffled evenly.
_PLACES = np.random.default_rng(64).integers(1 << 63, 1 << 64, 64, np.uint64) | np.uint64(1)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _word_repeats(data: np.ndarray, text: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
    """Per passage: words, words equal to the one before, words equal to one of the four before."""
    letter = data > 32
    begins = np.flatnonzero(letter & np.append(True, ~letter[:-1] | (text[1:] != text[:-1])))
    if not len(begins):
        return np.zeros((3, n))
    # a word's hash: the sum of its bytes, each times the number drawn for its place in the word
    word = np.cumsum(np.bincount(begins, minlength=len(data))) - 1
    place = np.arange(len(data)) - begins[np.maximum(word, 0)]
    terms = np.where(letter & (word >= 0), data.astype(np.uint64) * _PLACES[place & 63], np.uint64(0))
    hashes, own = np.add.reduceat(terms, begins), text[begins]
    like = [np.append(np.zeros(k, bool), (hashes[k:] == hashes[:-k]) & (own[k:] == own[:-k]))[: len(begins)] for k in range(1, 5)]
    of = passage[begins]
    return np.stack([np.bincount(of[x], minlength=n) for x in (slice(None), like[0], like[0] | like[1] | like[2] | like[3])])


def passage_features(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of the texts, and the number of passages of each text (1 at least)."""
    size = np.array([len(r) for r in raw], np.int64)
    passages = np.maximum(1, -(-size // PASSAGE_BYTES))
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    n = int(passages.sum())
    out = np.zeros((n, FEATURES), np.float32)
    if not len(data):
        return out, passages
    place = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
    passage = np.repeat(np.cumsum(passages) - passages, size) + place // PASSAGE_BYTES
    # of three bytes in a row, within one text and counted to the passage of the first
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    feature = ((code * np.uint32(2654435761)) >> np.uint32(32 - 10)).astype(np.int64)
    whole = (place < np.repeat(size, size) - 2)[: len(feature)]
    flat = passage[: len(feature)][whole] * TRIGRAMS + feature[whole]
    counts = np.sqrt(np.bincount(flat, minlength=n * TRIGRAMS).reshape(n, TRIGRAMS).astype(np.float32))
    distinct = (counts > 0).sum(axis=1)
    squares = (counts * counts).sum(axis=1)
    out[:, :TRIGRAMS] = counts / np.maximum(np.sqrt(squares), 1e-9)[:, None]
    words, same, near = _word_repeats(data, np.repeat(np.arange(len(raw)), size), passage, n)
    out[:, TRIGRAMS] = np.log1p(words) / 4
    out[:, TRIGRAMS + 1] = same / np.maximum(words, 1)
    out[:, TRIGRAMS + 2] = near / np.maximum(words, 1)
    out[:, TRIGRAMS + 3] = distinct / np.maximum(squares, 1)
    return out, passages


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class AttentionModel:
    """Weights; ``None`` in place of a model means that there was nothing to learn from."""

    weights: dict[str, np.ndarray]

    @classmethod
    def drawn(cls, seed: int = 7) -> AttentionModel:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        return cls(
            {
                "E": draw(FEATURES, HIDDEN) * 4,
                "e": np.zeros(HIDDEN, np.float32),
                "V": draw(HIDDEN, ATTENTION),
                "U": draw(HIDDEN, ATTENTION),
                "w": draw(ATTENTION),
                "c": draw(HIDDEN),
                "d": np.zeros(1, np.float32),
            }
        )

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passage vectors and unnormalised attention."""
        p = self.weights
        h = np.tanh(x @ p["E"] + p["e"])
        return h, (np.tanh(h @ p["V"]) * _sigmoid(h @ p["U"])) @ p["w"]

    def pooled(self, h: np.ndarray, s: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Attention weights of the passages and score of each document."""
        first = np.concatenate(([0], np.cumsum(passages)[:-1]))
        top = np.repeat(np.maximum.reduceat(s, first), passages)
        e = np.exp(s - top)
        a = e / np.repeat(np.add.reduceat(e, first), passages)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return a, _sigmoid(z @ self.weights["c"] + self.weights["d"])

    def gradients(self, x: np.ndarray, passages: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross entropy of the documents' scores."""
        p = self.weights
        first, doc = np.concatenate(([0], np.cumsum(passages)[:-1])), np.repeat(np.arange(len(y)), passages)
        h, s = self.encode(x)
        a, score = self.pooled(h, s, passages)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        dlogit = (weight * (score - y) / len(y)).astype(np.float32)
        dz = dlogit[:, None] * p["c"]
        da = (h * dz[doc]).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, first)[doc])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        dt, dg = (ds[:, None] * p["w"]) * g * (1 - t * t), (ds[:, None] * p["w"]) * t * g * (1 - g)
        dh = a[:, None] * dz[doc] + dt @ p["V"].T + dg @ p["U"].T
        dpre = dh * (1 - h * h)
        return {
            "E": x.T @ dpre, "e": dpre.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg,
            "w": (t * g).T @ ds, "c": z.T @ dlogit, "d": dlogit.sum(keepdims=True),
        }

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Scores of whole texts; texts are gone through in blocks of passages."""
        out, group, size = [], [], 0
        for raw in map(_bytes, texts):
            n = max(1, -(-len(raw) // PASSAGE_BYTES))
            if group and size + n > _BLOCK:
                out.append(self._score_group(group))
                group, size = [], 0
            if n > _BLOCK:
                out.append(self._score_long(raw))
            else:
                group.append(raw)
                size += n
        if group:
            out.append(self._score_group(group))
        return np.concatenate(out) if out else np.empty(0)

    def _score_group(self, raw: list[bytes]) -> np.ndarray:
        x, passages = passage_features(raw)
        return self.pooled(*self.encode(x), passages)[1]

    def _score_long(self, raw: bytes) -> np.ndarray:
        """One long text; a passage's trigrams reach two bytes into the next, also at the end of a block."""
        parts, step = [], _BLOCK * PASSAGE_BYTES
        for at in range(0, len(raw), step):
            x, _ = passage_features([raw[at : at + step + 2]])
            parts.append(self.encode(x[:_BLOCK]))
        h, s = (np.concatenate(c) for c in zip(*parts, strict=True))
        return self.pooled(h, s, np.array([len(s)]))[1]


def _sample_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the sample, some texts at a time and kept in half precision: the driver is small."""
    half = []
    for at in range(0, len(texts), 100):
        x, passages = passage_features(list(map(_bytes, texts[at : at + 100])))
        half.append((x.astype(np.float16), passages))
    return np.concatenate([x for x, _ in half]), np.concatenate([n for _, n in half])


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> AttentionModel | None:
    """A model of the labelled texts, the rarer class weighted up; None if they have one class only."""
    y = labels.astype(np.float32)
    if len(y) == 0 or y.min() == y.max():
        return None
    x, passages = _sample_features(texts)
    first = np.concatenate(([0], np.cumsum(passages)))
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    model, rng, step = AttentionModel.drawn(seed), np.random.default_rng(seed), 0
    mean = {k: np.zeros_like(v) for k, v in model.weights.items()}
    square = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            docs = order[at : at + BATCH]
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in docs])
            step += 1
            for k, g in model.gradients(x[rows].astype(np.float32), passages[docs], y[docs], weight[docs]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                change = (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                model.weights[k] = (model.weights[k] - LEARNING_RATE * change).astype(np.float32)
    return model


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS (null as the empty text); rows of fold 0 are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> AttentionModel | None:
    """A model of labelled rows of ``docs`` outside fold 0.

    ``labels``: doc_id, quality (0 or 1; rows with nulls are passed over, of repeated ids the highest counts).
    The sample: of the labelled ids with a text of at most ``SAMPLE_BYTES`` bytes in ``docs``, the first
    ``sample_docs`` in the order of their hash.
    """
    send_few_texts(docs.sparkSession)
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(fold(F.col("doc_id")) != 0)
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    # ids first, so that no text is shuffled; labels grow with the documents, so neither side is broadcast
    there = known.join(texts.select("doc_id").hint("merge"), "doc_id", "left_semi")
    sample = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    rows = texts.join(F.broadcast(sample), "doc_id")  # at most sample_docs
    found = rows.orderBy("doc_id", F.xxhash64("text")).limit(2 * sample_docs).toPandas()
    return train(found["text"].tolist(), found["quality"].to_numpy())


def quality_scores(text: Column, model: AttentionModel | None) -> Column:
    """Score of a text column, 0 to 1; 0.5 for all without a model."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()), dtype="float64").round(6)

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text; others are ignored): doc_id, held_out, score, predicted.

    Null text counts as empty; an empty text is one passage without features and gets the score of that.
    Repeated rows get equal scores. Without labelled rows of both classes every score is 0.5. An empty table
    gives an empty result.
    """
    model = learn(docs, labels, sample_docs)
    scored = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), quality_scores(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= keep_score, 1).otherwise(0))


def keep_classified(
    docs: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE, learn_from: DataFrame | None = None
) -> DataFrame:
    """The rows of ``docs`` that score ``keep_score`` or more, with all their columns, whatever their names.

    The model learns from labelled rows of ``learn_from`` (doc_id, text), by default of ``docs``. Where an earlier
    filter has made ``docs``, give the table before it: the filter leaves hardly any negative example.
    """
    model = learn(docs if learn_from is None else learn_from, labels)
    return packed(docs, score=quality_scores(F.col("text"), model)).where(F.col("score") >= keep_score).select("row.*")

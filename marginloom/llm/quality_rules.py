"""Quality rules: base counts of a text, and a log-likelihood ratio of hashed n-grams.

The n-grams are the last two characters of each word, those of two adjacent words, and two adjacent characters from
inside of each word, hashed to a fixed number of features. Where these stand in a word its hash decides, so a
word always gives the same ones and a text is read at every place of its words. Whole words are too rare for a
ratio: most occur in a few documents only, and then it says no more than whether one of these happens to be trusted.
Counts over the trusted documents and over the whole
corpus give two multinomials; a document's score is the mean, over its features, of the logarithm of their
ratio, so that it doesn't depend on the length. Documents below a threshold are rejected; nothing is drawn at
random. The threshold comes from the trusted documents' own scores, which spread more the fewer words were counted:
it lies below their low quantile by the quantile's distance from the median, and by more the fewer they are.

Everything is DataFrame expressions. The counts are combined before the shuffle into one row per feature;
the weights (one number per feature, a fixed number of them) reach the scoring pass as a scalar subquery.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .rows import packed
from .scratch import Scratch

FEATURES = 10_000
#: Features of their own for what stands inside of words, since pairs of endings are so many that they fill all others.
INSIDES = 4096
#: Added to each count and to what is expected of it, against chance in features that are rare.
ADDED = 10
ENDING = 2
#: Of the trusted documents' scores; the threshold lies below it by a margin, see ``score_threshold``.
LOW_QUANTILE = 0.005
#: Digits of the scores that the quantiles are exact for: so many distinct values, however many documents.
SCORE_DIGITS = 4
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
_SPACE = r"[\x20\x09-\x0D]"


def _name(column: str) -> str:
    """A name that doesn't clash with the documents' columns."""
    return f"_quality_{column}"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{_SPACE}+"), "")


def _joined(hashes: Column, n: Column, step: int) -> Column:
    """Hashes of stretches twice as long: each with the one ``step`` further; ``n`` come out, none if n < 1."""
    count = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, count), F.slice(hashes, step + 1, count), lambda a, b: F.xxhash64(a, b))


def _ending(word: Column) -> Column:
    """Hash of a word's ending."""
    return F.xxhash64(F.substring(word, -ENDING, ENDING))


def _inside(word: Column, hashed: Column) -> Column:
    """Hash of two adjacent characters of a word, at a place that the word's own hash draws."""
    place = (F.pmod(hashed, F.greatest(F.length(word) - 1, F.lit(1))) + 1).cast("int")
    return F.xxhash64(F.lit(1), F.substr(word, place, F.lit(2)))


def _endings(words: Column) -> Column:
    return F.transform(words, _ending)


def _insides(words: Column, hashes: Column) -> Column:
    return F.zip_with(words, hashes, _inside)


def _feature(gram: Column, features: int) -> Column:
    return F.pmod(gram, F.lit(features)).cast("int")


def feature_counts(docs: DataFrame, trusted: DataFrame, scratch: Scratch, features: int = FEATURES) -> DataFrame:
    """feature, c (count over all texts), t (count over the trusted ones), in one pass over the words."""
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    marked = scratch.table(ids, "trusted").withColumn("trusted", F.lit(1))
    # labels grow with the documents: never broadcast, at any size
    known = docs.select("doc_id", "text").join(marked.hint("merge"), "doc_id", "left")
    texts = known.select("trusted", _words(F.coalesce(F.col("text"), F.lit(""))).alias("words"))
    # a row per word and its next one: generated code hashes rows several times as fast as a function in an array
    following = F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0)))
    pairs = texts.select("trusted", F.inline(F.arrays_zip(F.col("words").alias("word"), following.alias("next"))).alias("word", "next"))
    word, after = F.col("word"), F.col("next")
    # columns of their own: written into the features, an ending would be computed anew for each use
    hashed = pairs.select("trusted", "word", F.xxhash64(word).alias("hash"), _ending(word).alias("end"), F.when(after.isNotNull(), _ending(after)).alias("next_end"))
    pair = F.when(F.col("next_end").isNotNull(), F.xxhash64("end", "next_end"))
    numbers = F.array(
        _feature(F.col("end"), features),
        _feature(pair, features),
        _feature(_inside(word, F.col("hash")), INSIDES) + features,
    )
    counts = hashed.select("trusted", F.explode(numbers).alias("feature")).where("feature IS NOT NULL").groupBy("feature")
    return counts.agg(F.count("*").alias("c"), F.count("trusted").alias("t"))


def feature_weights(docs: DataFrame, trusted: DataFrame, scratch: Scratch, features: int = FEATURES) -> DataFrame:
    """One row, one array: the log of a feature's count in trusted documents over what the corpus lets expect.

    ADDED is added to both. ``trusted`` has the doc_ids of the trusted documents; null ids match nothing.
    Without any trusted document all weights are zero.
    """
    counted = scratch.table(feature_counts(docs, trusted, scratch, features), "counts")
    every = docs.sparkSession.range(features + INSIDES).select(F.col("id").cast("int").alias("feature"))
    known = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    counts = every.join(counted, "feature", "left").select("feature", known("t"), known("c"))
    # the totals are sums of their own: inside the function they would be added up again for every feature
    totals = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    expected = F.col("c") * F.lit(totals.t / max(totals.c, 1))
    ratio = F.log((F.col("t") + ADDED) / (expected + ADDED))
    rows = F.sort_array(F.collect_list(F.struct("feature", ratio.alias("ratio"))))
    return scratch.table(counts.agg(rows.alias("rows")).select(F.col("rows.ratio").alias("weights")), "weights")


def _repeat_words(words: Column, half: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more; ``half`` has the hashes of half windows.

    Where all stretches of half a window, or all windows, have different hashes, as in nearly all
    texts, there are none. In others the windows themselves are sorted, equal neighbours give the
    places of repeated windows, and their lengths without overlap are added.
    """
    n = F.size(words)
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    windows = F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("i")))
    following = lambda s: F.slice(s, 2, F.size(s))
    none = F.array().cast("array<int>")
    twice = lambda s: F.flatten(
        F.zip_with(s, following(s), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(none))
    )
    covered = lambda p: F.aggregate(
        F.zip_with(p, following(p), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
        F.lit(0),
        lambda s, x: s + x,
    )
    exact = _let(F.sort_array(windows), lambda s: _let(F.sort_array(F.array_distinct(twice(s))), lambda p: F.when(F.size(p) > 0, covered(p)).otherwise(0)))
    alike = lambda hashes: F.size(F.array_distinct(hashes)) < F.size(hashes)
    whole = _let(_joined(half, n - (WINDOW - 1), WINDOW // 2), lambda hashes: F.when(alike(hashes), exact).otherwise(0))
    return F.when(alike(half), whole).otherwise(0)


def _judged(docs: DataFrame, weights: DataFrame, features: int) -> tuple[DataFrame, list[str]]:
    """``docs`` with the columns of the verdict, under names that don't clash; and those names, in order.

    Its last column, passed, is that of the base rules alone.
    """
    name = _name
    text, words, ends, end_pairs, insides, half, ratios = (
        F.col(name(c)) for c in ("text", "words", "ends", "end_pairs", "insides", "half", "weights")
    )
    split = docs.withColumn(name("text"), F.coalesce(F.col("text"), F.lit(""))).withColumn(name("words"), _words(text))
    hashed = split.withColumn(name("ends"), _endings(words))
    hashed = hashed.withColumn(name("end_pairs"), _joined(ends, F.size(words) - 1, 1))
    # of a half window: the hashes of its words joined to pairs, the pairs to fours
    hashed = hashed.withColumn(name("hashes"), F.transform(words, lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn(name("insides"), _insides(words, F.col(name("hashes"))))
    hashed = hashed.withColumn(name("pairs"), _joined(F.col(name("hashes")), F.size(words) - 1, 1))
    halves = F.when(F.size(words) > WINDOW, _joined(F.col(name("pairs")), F.size(words) - (WINDOW // 2 - 1), 2))
    hashed = hashed.withColumn(name("half"), F.coalesce(halves, F.array().cast("array<bigint>")))
    hashed = hashed.withColumn(name("weights"), weights.scalar())
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{_SPACE[1:]}"))
    at = lambda grams, n, first=0: F.aggregate(grams, F.lit(0.0), lambda s, g: s + F.get(ratios, _feature(g, n) + first))
    grams = 2 * F.size(words) + F.greatest(F.size(words) - 1, F.lit(0))
    added = at(ends, features) + at(end_pairs, features) + at(insides, INSIDES, features)
    ratio = added / F.greatest(grams, F.lit(1))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": _let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))),
        "n_repeat_words": _repeat_words(words, half),
    }
    judged = hashed.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[value.cast("long").alias(name(c)) for c, value in counts.items()],
        ratio.alias(name("log_ratio")),
    )
    n_words, repeated = F.col(name("n_words")), F.col(name("n_repeat_words"))
    failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)
    judged = judged.withColumn(name("base_failed"), failed)
    # a partition's number is never negative, but where it stands the optimizer leaves a filter: below it,
    # the words would be split anew in every function that looks at them
    settled = F.spark_partition_id() >= 0
    judged = judged.withColumn(name("passed"), ~failed & settled)
    return judged, [name(c) for c in (*counts, "base_failed", "log_ratio", "passed")]


def score_threshold(scores: DataFrame, trusted: DataFrame) -> float:
    """Least score to keep, from ``scores`` (doc_id, score; of documents that pass the base rules).

    The low quantile of the n trusted ones, less its distance from the median times 1 + 1 / sqrt(n * LOW_QUANTILE):
    the root is the relative chance error of how many lie below the quantile. Without any trusted one there is
    nothing to judge by: -inf.
    """
    # labels grow with the documents: never broadcast, at any size
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().hint("merge")
    own = scores.select("doc_id", F.round("score", SCORE_DIGITS).alias("score")).join(ids, "doc_id", "left_semi")
    counted = own.groupBy("score").agg(F.count("*").alias("n"))
    quantiles = F.percentile("score", F.array(F.lit(LOW_QUANTILE), F.lit(0.5)), F.col("n"))
    found = counted.agg(quantiles.alias("q"), F.sum("n").alias("n")).first()
    if found.q is None:
        return float("-inf")
    low, middle = found.q
    return low - (middle - low) * (1 + 1 / math.sqrt(found.n * LOW_QUANTILE))


def quality_rules(
    docs: DataFrame, trusted: DataFrame, features: int = FEATURES, threshold: float | None = None
) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text; others are ignored): doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_ratio.

    ``trusted``: doc_ids of trusted documents; unknown, null and repeated ids don't matter. Null text counts
    as empty; a text without words has log_ratio 0 and fails the base rules. Every row, repeated ones too, is
    counted in the corpus and judged by itself. An empty table gives an empty result. ``threshold``: least
    log_ratio to keep, in place of ``score_threshold``.
    """
    scratch = Scratch(docs.sparkSession, "quality-rules")
    weights = feature_weights(docs, trusted, scratch, features)
    judged, names = _judged(docs.select("doc_id", "text"), weights, features)
    scored = scratch.table(judged.select("doc_id", *names), "scores")
    if threshold is None:
        threshold = score_threshold(scored.where(F.col(_name("passed"))).select("doc_id", F.col(_name("log_ratio")).alias("score")), trusted)
    kept = F.col(_name("passed")) & (F.col(_name("log_ratio")) >= threshold)
    plain = lambda c: F.col(_name(c)).alias(c)
    counts = [plain(n.removeprefix("_quality_")) for n in names[:-2]]
    return scored.select("doc_id", *counts, kept.alias("kept"), plain("log_ratio"))


def keep_quality(
    docs: DataFrame, trusted: DataFrame, features: int = FEATURES, threshold: float | None = None
) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns, whatever their names."""
    scratch = Scratch(docs.sparkSession, "quality-rules")
    weights = feature_weights(docs, trusted, scratch, features)
    judged, names = _judged(packed(docs, text=F.col("text"), doc_id=F.col("doc_id")), weights, features)
    score = _name("log_ratio")
    # written once, so that the scores are there for the threshold and for the rows
    passed = scratch.table(judged.where(_name("passed")).select("row", "doc_id", score), "passed")
    if threshold is None:
        threshold = score_threshold(passed.select("doc_id", F.col(score).alias("score")), trusted)
    return passed.where(F.col(score) >= threshold).select("row.*")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_ids that ``labels`` marks as quality 1."""
    return labels.where("quality = 1").select("doc_id")

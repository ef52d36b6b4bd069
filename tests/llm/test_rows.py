"""Columns of any name survive every operator that hands rows on; caches and settings stay within bounds."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from marginloom.llm import packing, piece_codec
from marginloom.llm.decontaminate import cut_passages, drop_contaminated
from marginloom.llm.exact_dedup import drop_exact_copies
from marginloom.llm.line_spread import drop_boilerplate
from marginloom.llm.mil_classifier import keep_classified
from marginloom.llm.packing import pack
from marginloom.llm.quality_rules import keep_quality
from marginloom.llm.simhash import drop_near_copies

NAMES = (
    "row key place number part score lines removed found fp class root row_key t k n site pos line k1 k2 name item window feature "
    "words weights passed kept label quality trusted gram h g a b _row _row_key _row_place _lines _removed _mil_score _group "
    "_quality_log_ratio _quality_words _quality_text _quality_passed _quality_base_failed Row Key odd.name"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    """Some given documents with a column of every name that any step uses inside."""
    plain = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60 OR doc_id % 3 = 0")
    return plain.select("doc_id", "text", "source", *[F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in NAMES if n not in ("Row", "Key")])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


STEPS = {
    "drop_exact_copies": lambda d, _: drop_exact_copies(d),
    "drop_near_copies": lambda d, _: drop_near_copies(d),
    "drop_boilerplate": lambda d, _: drop_boilerplate(d).drop("n_lines", "n_removed"),
    "keep_quality": lambda d, q: keep_quality(d, q.where("quality = 1").select("doc_id")),
    "keep_classified": lambda d, q: keep_classified(d, q),
    "drop_contaminated": lambda d, _: drop_contaminated(d, d.limit(2).select(F.col("doc_id").alias("item_id"), "text")),
    "cut_passages": lambda d, _: cut_passages(d, d.limit(2).select(F.col("doc_id").alias("item_id"), "text")),
}


@pytest.mark.parametrize("step", STEPS)
def test_names_are_free(docs, labels, step):
    kept = STEPS[step](docs, labels)
    assert kept.columns == docs.columns
    plain = STEPS[step](docs.select("doc_id", "text", "source"), labels)
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect()) and rows
    assert all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in docs.columns[3:])


def test_packing_hands_on_any_column(spark):
    fields = [n for n in NAMES if n not in ("Row", "Key")]
    rows = spark.range(50).selectExpr("id AS doc_id", "CAST(id % 7 * 100 + 1 AS BIGINT) AS length")
    pieces = rows.select("*", *[F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in fields], F.lit("old").alias("offset"))
    packed = pack(pieces, group_pieces=16)
    assert packed.columns == [c for c in pieces.columns if c != "offset"] + ["sequence_id", "offset"]
    found = packed.collect()
    assert len(found) == 50 and all(r[n] == f"{n}:{r.doc_id}" for r in found for n in fields)
    assert all(isinstance(r.offset, int) for r in found)
    assert pack(pieces.limit(0)).count() == 0


def unspaced(n):
    rng = random.Random(n)
    return ["".join(rng.choice("漢字仮名交文章abc") for _ in range(3000)) for _ in range(n)]


def held(table):
    return sum(len(k) for k in table), max((len(k) for k in table), default=0)


def test_caches_hold_no_texts_without_spaces():
    tokenizer = packing.ByteTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    texts = unspaced(2000)
    ids = list(tokenizer.encode([*texts, "a few words, a few"]))
    for table in (tokenizer.known, tokenizer.first):
        chars, longest = held(table)
        assert chars < 100 and longest <= packing.LONG_CHUNK
    plain = tokenizer.tokenizer.encode(texts[7], add_special_tokens=False).ids
    assert np.frombuffer(ids[7], "<u4").tolist() == plain
    codec = piece_codec.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    some = texts[:60]
    found = codec.encode([*some, "a few words, a few"])
    chars, longest = held(codec.known)
    assert chars < 100 and longest <= piece_codec.LONG_WORD and len(found) == 61

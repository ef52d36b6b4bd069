"""The pipeline's stages on the smallest tables: columns, decisions that take effect, every row accounted for."""

import re

import corpus_pipeline
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marginloom.llm.mil_classifier import fold, learn, quality_scores
from marginloom.llm.quality_rules import quality_rules, trusted_ids
from marginloom.llm.scratch import Scratch
from marginloom.llm.simhash import fingerprint, shingle_hashes

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scratch, found = Scratch(spark, "stages"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(scratch.table(stage(spark, found[-1], FOLDER), name))
    return found


def test_filters_take_effect(spark, stages):
    docs, ruled, classified, *_ = stages
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert all(s.columns == docs.columns for s in stages[:-1])
    kept = {r.doc_id for r in quality_rules(docs, trusted_ids(labels)).where("kept").collect()}
    assert {r.doc_id for r in ruled.collect()} == kept and 0 < len(kept) < docs.count()
    # the stage learns from the whole input, which has examples of both kinds
    model = learn(docs, labels)
    scores = {r.doc_id: r.score for r in docs.select("doc_id", quality_scores(F.col("text"), model).alias("score")).collect()}
    assert min(scores.values()) < 0.3 < max(scores.values())
    assert {r.doc_id for r in classified.collect()} == {i for i in kept if scores[i] >= 0.3}


def test_classifier_rejects_junk_when_the_rules_leave_no_negative(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    negative = labels.where("quality = 0")
    held = negative.where(fold(F.col("doc_id")) == 0)
    left = docs.join(negative.where(fold(F.col("doc_id")) != 0), "doc_id", "left_anti")
    kept = corpus_pipeline.quality_classifier(spark, left, folder)
    assert kept.columns == docs.columns
    junk, good = left.join(held, "doc_id", "left_semi"), left.join(labels.where("quality = 1"), "doc_id", "left_semi")
    assert junk.count() > 5 and kept.join(held, "doc_id", "left_semi").count() < 0.2 * junk.count()
    assert kept.join(good, "doc_id", "left_semi").count() > 0.9 * good.count()


def test_dedup_stages_against_brute_force(stages):
    _, _, classified, exact, near, _ = (s.toPandas() for s in stages)
    squashed = classified.assign(key=[re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in classified.text])
    assert sorted(exact.doc_id) == sorted(squashed.groupby("key").doc_id.min())
    ids = exact.doc_id.tolist()
    prints = [fingerprint(shingle_hashes(t, 3)) % (1 << 64) for t in exact.text]
    label = dict(zip(ids, ids, strict=True))
    changed = True
    while changed:
        changed = False
        for i, a in zip(ids, prints, strict=True):
            for j, b in zip(ids, prints, strict=True):
                if (a ^ b).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    assert sorted(near.doc_id) == sorted(set(label.values()))


def test_packing_holds_every_document(stages):
    near, packed = stages[-2].toPandas(), stages[-1].toPandas()
    assert set(packed.doc_id) == set(near.doc_id)
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    last = packed.sort_values("piece").groupby("doc_id").tail(1)
    assert isinstance(last, pd.DataFrame) and (last.start + last.length).min() >= 1


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    order = lambda df: df.select(*key).toPandas().sort_values(key).reset_index(drop=True)
    assert order(corpus_pipeline.run(spark, FOLDER)).equals(order(stages[-1]))

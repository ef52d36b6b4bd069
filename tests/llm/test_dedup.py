"""Exact dedup, SimHash and components against brute force, with nulls, empty tables and clashing columns."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marginloom.llm.components import components
from marginloom.llm.exact_dedup import drop_exact_copies, exact_dedup
from marginloom.llm.scratch import Scratch
from marginloom.llm.simhash import (
    _classes_by_flips,
    _classes_by_pairs,
    _longer_masks,
    _masks,
    drop_near_copies,
    fingerprint,
    fingerprint_links,
    shingle_hashes,
    simhash_classes,
)

DOCS = "doc_id long, text string, name string, n long, pos int"


def docs_of(spark, texts):
    rows = [(i, t, f"n{i}", 1, 2) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def squashed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(squashed(t), []).append(i)
    out = []
    seen = set()
    for i, t in rows:
        ids = groups[squashed(t)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        kept = i == keep and (i, squashed(t)) not in seen
        seen.add((i, squashed(t)))
        out.append((i, keep, len(ids), kept))
    return sorted(out, key=str)


CASES = [
    (1, "a b"), (2, "a  b"), (3, "a\tb"), (4, None), (5, ""), (6, " "), (7, "\n\x0b\x0c\r "), (8, "abcdefgh" * 40),
    (9, "abcdefgh" * 40), (10, "abcdefgh" * 39 + "abcdefgx"), (11, "abcdefgh" * 41), (12, "x" * 8), (13, "x" * 16), (14, "x" * 17),
    (14, "x" * 17), (14, "x" * 18), (None, "q"), (None, "q"), (None, "a b"), (15, "ab\x85c"), (16, "ab c"), (17, "é" * 9), (18, "é" * 9),
]


@pytest.mark.parametrize("block", [8, 2048])
def test_exact_dedup(spark, block):
    got = exact_dedup(docs_of(spark, CASES), block)
    rows = sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()], key=str)
    assert rows == expected_exact(CASES)


def test_exact_dedup_random(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab ") for _ in range(rng.randint(0, 9)))) for i in range(150)]
    rows += [(1000 + i, "ab" * rng.randint(0, 20) + rng.choice(["", "c"])) for i in range(60)]
    got = exact_dedup(docs_of(spark, rows), 4)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()], key=str) == expected_exact(rows)


def test_exact_dedup_draws_new_keys_when_contents_collide(spark, monkeypatch):
    import marginloom.llm.exact_dedup as module

    real, seeds = module._blocks, []

    def colliding(docs, size, seed):
        seeds.append(seed)
        blocks = real(docs, size, seed)
        return blocks.withColumns({"k1": F.lit(0).cast("long"), "k2": F.lit(0).cast("long")}) if seed == 0 else blocks

    monkeypatch.setattr(module, "_blocks", colliding)
    rows = [(1, "a"), (2, "b"), (3, "a")]
    got = exact_dedup(docs_of(spark, rows))
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()], key=str) == expected_exact(rows)
    assert seeds == [0, 1]


def test_drop_exact_copies_keeps_columns(spark):
    docs = docs_of(spark, CASES)
    kept = drop_exact_copies(docs, 8)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(
        (i, t) for i, t in dict.fromkeys((i, t) for i, t in CASES) if (i, len([0 for j, u in CASES if squashed(u) == squashed(t)])) and i is not None
        and i == min(j for j, u in CASES if j is not None and squashed(u) == squashed(t))
    )
    assert kept.where("doc_id IS NULL").count() == 1


def test_empty_tables(spark):
    none = docs_of(spark, [])
    assert exact_dedup(none).count() == 0
    assert drop_exact_copies(none).columns == none.columns and drop_exact_copies(none).count() == 0
    assert simhash_classes(none).count() == 0
    assert drop_near_copies(none).count() == 0


# --- SimHash ---


def brute_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


def expected_classes(rows, bits=3):
    prints = [brute_print(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= bits]
    found = roots(len(rows), links)
    smallest = {r: min((rows[k][0] for k in range(len(rows)) if found[k] == r and rows[k][0] is not None), default=None) for r in found}
    return sorted([(i, f"{p:016x}", smallest[r]) for (i, _), p, r in zip(rows, prints, found, strict=True)], key=str)


def near_texts(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "One  two"), (5, "ONE TWO"), (None, "null id"), (None, None), (3, "one")]
    for k in range(n):
        base = [word() for _ in range(rng.randint(30, 120))]
        for c in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(c % 4):
                copy[rng.randrange(len(copy))] = word()
            rows.append((100 * (k + 1) + c, " ".join(copy)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"join_limit": 1}, {"join_limit": 1, "group_limit": 2}, {"join_limit": 2, "group_limit": 3}])
def test_simhash_classes(spark, limits):
    rows = near_texts(5, 12)
    got = simhash_classes(docs_of(spark, rows), **limits)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got.collect()], key=str) == expected_classes(rows)


@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_classes_of_a_hot_key(max_bits):
    rng = random.Random(max_bits)
    for n in (1, 2, 40, 300):
        # all alike in most places; sparse enough for several classes, dense enough for links by way of others
        places = rng.sample(range(64), 11 if n > 40 else 16)
        base = rng.getrandbits(64)
        values = {base ^ sum(1 << p for p in places if rng.random() < 0.4) for _ in range(n)}
        prints = np.sort(np.array(sorted(values), np.uint64))
        links = [(a, b) for a in range(len(prints)) for b in range(a) if int(prints[a] ^ prints[b]).bit_count() <= max_bits]
        want = roots(len(prints), links)
        assert _classes_by_pairs(prints, max_bits).tolist() == want
        assert _classes_by_flips(prints, max_bits).tolist() == want


@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_longer_keys_lose_no_pair(max_bits):
    """Any two fingerprints within the distance share a key in both cuts, and few values fit one."""
    rng = random.Random(max_bits)
    masks = _masks(list(range(64)), max_bits)
    for _ in range(300):
        differ = sum(1 << p for p in rng.sample(range(64), max_bits))
        shared = [m for m in masks if not m % (1 << 64) & differ]
        assert shared
        for m in shared:
            assert any(not k % (1 << 64) & differ and k & m == m for k in _longer_masks(m, max_bits))
    assert max(64 - (k % (1 << 64)).bit_count() for m in masks for k in _longer_masks(m, max_bits)) <= 18


def test_large_group_of_near_copies(spark):
    """Thousands of fingerprints under one key, in classes that only the longer keys and flips compare."""
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(3)]
    values = {b ^ sum(1 << p for p in rng.sample(range(20, 46), rng.randint(0, 4))) for b in base for _ in range(900)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in sorted(values)]
    prints = spark.createDataFrame(signed, "fp long")
    links = fingerprint_links(prints, Scratch(spark, "t"), 3, 8, 100)
    found = {r.node: r.root for r in components(links, Scratch(spark, "t")).collect()}
    own = np.array([v for (v,) in signed], np.int64).view(np.uint64)
    near = np.bitwise_count(own[:, None] ^ own[None, :]) <= 3
    want = roots(len(own), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    group = {}
    for (v,), w in zip(signed, want, strict=True):
        group.setdefault(w, set()).add(found.get(v, v))
    assert all(len(g) == 1 for g in group.values())
    assert len(set().union(*group.values())) == len(group)


def test_spark_hash_is_the_same(spark):
    text = "Some wörds hereé and more"
    spark_hash = spark.range(1).select(F.xxhash64(F.lit("some wörds hereé"))).first()[0]
    assert int(shingle_hashes(text, 3)[0]) == spark_hash % (1 << 64)


def test_long_text_fingerprint():
    words = [f"w{i % 977}" for i in range(70_000)]
    whole = fingerprint(shingle_hashes(" ".join(words), 3)) % (1 << 64)
    hashes = shingle_hashes(" ".join(words), 3)
    assert whole == sum(1 << b for b in range(64) if 2 * int(((hashes >> b) & 1).sum()) > len(hashes))


def test_drop_near_copies(spark):
    rows = near_texts(6, 5)
    docs = docs_of(spark, rows)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    classes = {(c, i) for i, _, c in expected_classes(rows)}
    assert kept.count() == len({c for c, _ in classes})
    assert {r.doc_id for r in kept.collect()} == {c for c, _ in classes}


# --- components ---


@pytest.mark.parametrize("kind", ["path", "star", "random", "text"])
def test_components(spark, kind):
    rng = random.Random(8)
    n = 60
    links = {
        "path": [(i, i + 1) for i in range(n - 1)],
        "star": [(0, i) for i in range(1, n)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(40)] + [(5, 5), (6, 7), (7, 6), (6, 7)],
        "text": [(1, 2), (2, 3), (7, 8)],
    }[kind]
    if kind == "text":
        edges = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in links] + [(None, "n1"), ("n9", None)], "a string, b string")
    else:
        edges = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(edges, Scratch(spark, "t")).collect()}
    found = roots(n, links)
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    name = (lambda x: f"n{x}") if kind == "text" else (lambda x: x)
    assert set(got) == {name(x) for x in nodes}
    assert all((got[name(a)] == got[name(b)]) == (found[a] == found[b]) for a in nodes for b in nodes)

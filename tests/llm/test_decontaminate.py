"""Passages of benchmark items against a plain search."""

import random
import re
from hashlib import sha256

import duckdb
import pytest

from marginloom.llm.decontaminate import cut_passages, drop_contaminated, find_passages
from marginloom.llm.queries import ORACLES, op13_decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, row string, found string, n_hit int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(docs, items, width):
    listed = []
    for i, text in items:
        words = WORD.findall(lowered(text or ""))
        size = min(width, len(words))
        listed += [("" if i is None else str(i), words[a : a + size]) for a in range(len(words) - size + 1) if size]
    out = []
    for doc, text in docs:
        places = [m.span() for m in WORD.finditer(text or "")]
        words = [lowered(text[a:b]) for a, b in places]
        hit, found = set(), set()
        for item, window in listed:
            for a in range(len(words) - len(window) + 1):
                if words[a : a + len(window)] == window:
                    hit.update(range(a, a + len(window)))
                    found.add(item)
        runs = []
        for w in sorted(hit):
            if runs and runs[-1][1] == w - 1:
                runs[-1][1] = w
            else:
                runs.append([w, w])
        spans = [(a, b, places[a][0], places[b][1]) for a, b in runs]
        out.append((doc, len(words), len(hit), sorted(found), spans))
    return sorted(out, key=str)


def found(df):
    rows = [(r.row.doc_id, r.found.n_words, r.found.n_hit, r.found["items"], [tuple(s) for s in r.found.spans]) for r in df.collect()]
    return sorted(rows, key=str)


def tables(spark, docs, items):
    rows = [(i, t, "r", "f", 1) for i, t in docs]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")


@pytest.mark.parametrize("width,part_bytes", [(3, 10_000), (3, 40), (10, 10_000)])
def test_random(spark, width, part_bytes):
    rng = random.Random(width)
    words = ["a", "B", "é", "ß1", "漢字", "x", "😀", "q"]
    line = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--", "\x00", "_"]) for _ in range(n))
    items = [(i, line(rng.randint(0, 6))) for i in range(12)] + [(None, "x q x q"), (3, "é é é é"), (4, None), (5, ""), (5, ".,"), (12, line(14))]
    items += [(20, "A b"), (21, "a, B!")]
    docs = [(i, line(rng.randint(0, 40))) for i in range(60)] + [(1, None), (1, ""), (2, " .- "), (None, "x q x q"), (70, items[-3][1].upper())]
    docs += [(71, "😀 A-b c É"), (71, "😀 A-b c É")]
    frame, listed = tables(spark, docs, items)
    assert found(find_passages(frame, listed, width, part_bytes)) == plain(docs, items, width)


def test_words_match_whole(spark):
    docs, items = [(1, "xab cd"), (2, "ab cdx"), (3, "AB, (cd)"), (4, "ab  cd ab cd")], [(9, "ab cd")]
    assert [r[2] for r in found(find_passages(*tables(spark, docs, items)))] == [0, 0, 2, 4]


def test_empty_tables(spark):
    docs, items = [(1, "a b"), (2, None)], [(1, "a b")]
    frame, listed = tables(spark, docs, items)
    assert found(find_passages(frame, listed.limit(0))) == plain(docs, [], 10)
    assert find_passages(frame.limit(0), listed).count() == 0
    assert drop_contaminated(frame, listed).columns == frame.columns


def test_drop_and_cut(spark):
    docs, items = [(1, "one 😀 Two, three; four"), (2, "clean"), (3, None), (4, "two three two three")], [(1, "two THREE")]
    frame, listed = tables(spark, docs, items)
    assert sorted(r.doc_id for r in drop_contaminated(frame, listed).collect()) == [2, 3]
    cut = cut_passages(frame, listed)
    assert cut.columns == frame.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "one 😀  ; four", 2: "clean", 3: None, 4: " "}


def test_very_long_text(spark):
    text = "lorem ipsum " * 300_000 + "needle in the hay " + "x" * 1_000_000
    frame, listed = tables(spark, [(1, text)], [(1, "Needle in the hay")])
    ((_, n, hit, items, spans),) = found(find_passages(frame, listed))
    assert (n, hit, items) == (600_005, 4, ["1"]) and text[spans[0][2] : spans[0][3]] == "needle in the hay"


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    got = op13_decontaminate(spark, folder)
    want = duck.execute(ORACLES["op13_decontaminate"])
    assert got.columns == [d[0] for d in want.description]
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == sorted(want.fetchall()) and any(r[5] for r in rows)
    assert rows[0][4] == sha256(b"").hexdigest() or rows[0][5]

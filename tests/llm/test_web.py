"""URL filter and WARC archives against brute force and exact round trips."""

import gzip
import hashlib
import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from marginloom.llm.queries import URL_RULES
from marginloom.llm.url_filter import filter_urls, link_edges, without_dots
from marginloom.llm.warc import (
    archive_pages,
    gzip_member,
    page_records,
    read_warc,
    record_bytes,
    write_warc,
)
from marginloom.llm.scratch import Scratch

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string, html string, verdict string, host int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], PAGES)


def parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def own_rule(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def judged(rows, rules, edges):
    group = {}

    def find(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            group[find(a)] = find(b)
    blocked = {find(u) for u in list(group) if own_rule(u, rules)[1] == "block"}
    out = []
    for i, url, _ in rows:
        rule, verdict = own_rule(url, rules)
        alias = url is not None and url in group and find(url) in blocked
        out.append((i, *parts(url), rule, verdict or ("block" if alias else "allow")))
    return sorted(out, key=str)


URLS = [
    "http://a.com/x", "http://example.com/en/1", "http://www.example.com/en/1", "https://WWW.Example.COM/en/2?q=1#f", "http://m.example.com/en",
    "http://m.example.com/en/z", "http://b.net/es/1", "http://b.net/ES/1", "http://net/fr/", "http://x.org/1", "http://x.org/2", "http://y.org/",
    "no scheme", "", None, "http://", "http://com", "http://com/", "http://a.com?x=/en/", "http://a.com:80/x", "ftp://xcom/", "a://b://c.com/d", "http://é.com/ü",
]


def test_filter_urls(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(3, URLS[3], ""), (None, URLS[1], None)]
    edges = [("http://x.org/1", "http://b.net/es/1"), ("http://x.org/2", "http://x.org/1"), ("http://www.example.com/en/1", "http://x.org/2"),
             ("http://y.org/", "http://a.com/x"), (None, "http://y.org/"), ("http://y.org/", "http://y.org/")]
    table = spark.createDataFrame(edges, "from_url string, to_url string")
    got = filter_urls(pages_of(spark, rows), spark.createDataFrame(URL_RULES, RULES), table)
    found = sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()], key=str)
    assert found == judged(rows, URL_RULES, edges)
    assert {r.page_id: r.verdict for r in got.collect()}[9] == "block"


def test_chains_of_aliases(spark):
    rng = random.Random(2)
    urls = [f"http://h{i}.org/{'en/' if i % 2 else ''}{i}" for i in range(40)] + ["http://bad.net/es/1", "http://ok.com/"]
    edges = [(rng.choice(urls), rng.choice(urls)) for _ in range(25)] + [(urls[i], urls[i + 1]) for i in range(9)]
    rows = [(i, u, None) for i, u in enumerate(urls)]
    got = filter_urls(pages_of(spark, rows), spark.createDataFrame(URL_RULES, RULES), spark.createDataFrame(edges, "from_url string, to_url string"))
    assert sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()], key=str) == judged(rows, URL_RULES, edges)


def test_link_edges(spark):
    rows = [
        (1, "http://a.org/1?x=1", '<head><link rel="canonical" href="http://a.org/1"></head>'),
        (2, "https://a.org/2", "<LINK HREF='/two?a=1&amp;b=2' REL=canonical>"),
        (3, "https://a.org/3", '<meta http-equiv="refresh" content="0; url=//b.net/es/9">'),
        (4, "https://a.org/4", '<link rel="stylesheet" href="x.css"> canonical'),
        (5, "https://a.org/5", '<link rel="canonical" href="five">'),
        (6, None, '<link rel="canonical" href="http://a.org/1">'),
        (7, "https://a.org/7", None),
        (8, "https://a.org/8", '<link rel="canonical" data-href="no" href="eight"><link data-rel="canonical" href="no">'),
        (9, "https://a.org/9", '<link rel="canonical" href="#top"><link rel="canonical" href="mailto:x@a.org">'),
    ]
    pages = pages_of(spark, rows)
    assert {(r.from_url, r.to_url) for r in link_edges(pages).collect()} == {
        ("http://a.org/1?x=1", "http://a.org/1"), ("https://a.org/2", "https://a.org/two?a=1&b=2"), ("https://a.org/3", "https://b.net/es/9"),
        ("https://a.org/5", "https://a.org/five"), ("https://a.org/8", "https://a.org/eight"),
    }
    verdicts = {r.page_id: r.verdict for r in filter_urls(pages, spark.createDataFrame(URL_RULES, RULES)).collect()}
    assert verdicts == {i: "block" if i == 3 else "allow" for i in range(1, 10)}


BASES = ["http://b.net/es/x", "http://b.net/es/", "http://b.net/es/x/y?q=1#f", "http://b.net", "http://b.net?q=a/b", "https://b.net/a/b/c"]
LINKS = ["five", "../x", "?p=2", "./x", ".", "..", "../..", "../../../x/./y/../z", "/a/../b/.", "//c.org/../x", "http://c.org/a/../b", "x/?a/../b", "/"]
LINKS += ["x#f", "#f", "x/.hidden", "..x/y", "x..", "...", "/..", "/../fr/1", "es/../../es/1?u=http://c.org/"]


def test_relative_links_are_resolved(spark, tmp_path):
    """Against the standard library, in the query, in its SQL twin and by verdicts."""
    import duckdb

    from marginloom.llm.queries import ORACLES

    pairs = [(b, k) for b in BASES for k in LINKS]
    rows = [(i, f"{b}{'&' if '?' in b else '?'}i={i}" if "#" not in b else b, f'<link rel="canonical" href="{k}">') for i, (b, k) in enumerate(pairs)]
    pages = pages_of(spark, rows)
    found = {(r.from_url, r.to_url) for r in link_edges(pages).collect()}
    keeps_dots = ("//", "http:")  # what names its own host is taken as it stands
    want = {
        (url, k if k.startswith("http:") else url.split("//")[0] + k if k.startswith("//") else urljoin(url, k).split("#")[0])
        for (_, url, _), (_, k) in zip(rows, pairs, strict=True)
        if not k.startswith("#")
    }
    assert found == want and any(k.startswith(keeps_dots) for _, k in pairs)
    pages.select("page_id", "url", "html").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    twin = con.execute("SELECT page_id, host, path, rule, verdict FROM (" + ORACLES["op7_url_filter"] + ")").fetchall()
    got = filter_urls(pages, spark.createDataFrame(URL_RULES, RULES)).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(twin, key=str)
    assert sorted(map(tuple, got.collect()), key=str) == judged(rows, URL_RULES, sorted(found))


def test_empty_segments_stay(spark):
    paths = {"/a//b/c": "/a//b/c", "/a//../b": "/a/b", "//..": "/", "/a//.": "/a//", "/./": "/", "/a/..": "/", "/a/b/..": "/a/"}
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select("p", without_dots(F.col("p")).alias("q"))
    assert {r.p: r.q for r in rows.collect()} == paths


def test_sql_twin_follows_links_too(spark, tmp_path):
    import duckdb

    from marginloom.llm.queries import ORACLES, QUERIES

    link = lambda to: f'<html><link rel="canonical" href="{to}"></html>'
    rows = [(i, u, None) for i, u in enumerate(URLS)]
    rows += [(50, "http://p.org/1", link("http://p.org/2")), (51, "http://p.org/2", link("/3")), (52, "http://p.org/3", link("//b.net/fr/x"))]
    rows += [(53, "http://www.example.com/en/9", link("http://p.org/1")), (54, "http://q.org/", link("http://a.com/"))]
    pages_of(spark, rows).select("page_id", "url", "html").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute("SELECT page_id, host, path, rule, verdict FROM (" + ORACLES["op7_url_filter"] + ")").fetchall()
    got = [tuple(r) for r in QUERIES["op7_url_filter"](spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[0]: r[4] for r in got}[50] == "block" and {r[0]: r[4] for r in got}[53] == "allow"


def test_every_link_of_a_page_counts(spark, tmp_path):
    import duckdb

    from marginloom.llm.queries import ORACLES, QUERIES

    canonical, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        (1, "http://p.org/1", canonical.format("http://p.org/ok") + "<p>" + canonical.format("http://b.net/es/1")),
        (2, "http://p.org/2", refresh.format("/ok") + refresh.format("//b.net/fr/x")),
        (3, "http://p.org/3", canonical.format("http://q.org/a") + canonical.format("http://q.org/b")),
        (4, "http://p.org/4", "canonical"),
    ]
    pages = pages_of(spark, rows)
    assert link_edges(pages).count() == 6
    pages.select("page_id", "url", "html").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute("SELECT page_id, host, path, rule, verdict FROM (" + ORACLES["op7_url_filter"] + ")").fetchall()
    got = [tuple(r) for r in QUERIES["op7_url_filter"](spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[0]: r[4] for r in got} == {1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_no_pages_and_no_rules(spark):
    none = pages_of(spark, [])
    assert filter_urls(none, spark.createDataFrame(URL_RULES, RULES)).count() == 0
    got = filter_urls(pages_of(spark, [(1, "http://a.com/", "")]), spark.createDataFrame([], RULES)).collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "allow")]


# --- WARC ---


def archive_rows():
    big, rng = "ü" * 500 + "x", random.Random(1)
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, "http://a/3", big), (4, "u", "x" * 999), (5, "u", "x" * 999), (6, None, None)]
    rows += [(7, "bad\r\nurl: %41", ""), (8, "http://ü/", "\r\n\r\nWARC/1.1\r\n"), (9, "", "y" * 1000), (10, "", "y" * 1000), (10, "", "y" * 1000)]
    rows += [(11, "l", "".join(rng.choice("abc<>\n") for _ in range(300_000))), (None, "n", "z" * 1000), (None, "n", "z" * 1000), (None, "n", big)]
    return rows


def expected_archive(rows):
    out, groups = [], {}
    for i, _, h in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    for i, _, h in rows:
        data = (h or "").encode()
        newest = max((x for x in groups[data] if x is not None), default=None)
        again = len(data) >= 1000 and newest is not None and i != newest
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", newest if again else None))
    return sorted(out, key=str)


def test_archive_pages(spark):
    rows = archive_rows()
    got = archive_pages(pages_of(spark, rows)).collect()
    assert sorted([tuple(r) for r in got], key=str) == expected_archive(rows)
    assert archive_pages(pages_of(spark, [])).count() == 0


def test_round_trip_and_pushdown(spark):
    rows = archive_rows()
    scratch = Scratch(spark, "warc-test")
    path = scratch.path("archive")
    records = scratch.table(page_records(pages_of(spark, rows), scratch), "records")
    write_warc(records.repartition(3), path)
    back = read_warc(spark, path)
    columns = ["record_id", "record_type", "refers_to", "payload_digest", "payload_length", "payload"]
    same = lambda df: sorted([tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.select(*columns).collect()], key=str)
    assert same(back) == same(records)
    urls = {r.record_id: r.target_uri for r in back.collect()}
    assert urls["<urn:x-page:7>"] == "bad%0D%0Aurl: %2541" and urls["<urn:x-page:8>"] == "http://ü/"
    revisits = read_warc(spark, path, ["record_id", "record_type"]).where("record_type = 'revisit'")
    assert revisits.count() == records.where("record_type = 'revisit'").count()
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]  # the reader has taken the predicates
    one = read_warc(spark, path).where(F.col("payload_digest").isin("sha1:" + hashlib.sha1(b"").hexdigest(), "none"))
    assert {r.record_id for r in one.collect()} >= {"<urn:x-page:6>", "<urn:x-page:7>"}


@pytest.mark.parametrize("kind", ["plain", "gzip", "sl"])
def test_archives_of_others(spark, tmp_path, kind):
    rows = [
        {"record_id": f"<urn:x-page:{i}>", "record_type": "response", "target_uri": "http://u", "refers_to": None,
         "payload_digest": "sha1:x", "payload_length": n, "payload": bytes([65 + i]) * n}
        for i, n in enumerate((0, 10, 200_000, 70_000))
    ]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\nab: c\r\n\r\n"
    pack = {"plain": bytes, "gzip": gzip.compress, "sl": gzip_member}[kind]
    name = tmp_path / ("x.warc" if kind == "plain" else "x.warc.gz")
    name.write_bytes(pack(info) + b"".join(pack(record_bytes(r)) for r in rows))
    got = read_warc(spark, str(tmp_path)).collect()
    assert [(r.record_type, r.payload_length) for r in got] == [("warcinfo", 5)] + [("response", len(x["payload"])) for x in rows]
    assert [bytes(r.payload) for r in got[1:]] == [x["payload"] for x in rows]
    assert gzip.decompress(gzip_member(info)) == info
    assert [r.payload_length for r in read_warc(spark, str(tmp_path), ["payload_length"]).collect()] == [5, 0, 10, 200_000, 70_000]


def records(spark, *ids):
    rows = [(f"<urn:x-page:{i}>", "response", f"http://a.org/{i}", None, "sha1:x", 3, bytearray(b"abc")) for i in ids]
    kind = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_length long, payload binary"
    return spark.createDataFrame(rows, kind)


def read_ids(spark, path):
    return sorted(int(r.record_id[12:-1]) for r in read_warc(spark, path, ["record_id"]).collect())


def test_commits_of_an_archive(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    write_warc(records(spark, 1, 2), path)
    write_warc(records(spark, 3).limit(0), path)
    write_warc(records(spark, 4), path)
    assert read_ids(spark, path) == [1, 2, 4]
    write_warc(records(spark, 5), path, "overwrite")
    write_warc(records(spark, 6), path)
    assert read_ids(spark, path) == [5, 6]
    with pytest.raises(Exception, match="lost"):
        write_warc(records(spark, 7, 8, 9).selectExpr("if(record_id LIKE '%9>', raise_error('lost'), record_id) AS record_id", "* EXCEPT (record_id)"), path)
    assert read_ids(spark, path) == [5, 6]


def test_appending_to_an_archive_from_elsewhere(spark, tmp_path):
    path = tmp_path / "archive"
    path.mkdir()
    row = {"record_type": "response", "record_id": "<urn:x-page:1>", "target_uri": "u", "payload_digest": "sha1:x", "refers_to": None}
    (path / "crawl-0.warc.gz").write_bytes(gzip_member(record_bytes({**row, "payload": b"abc", "payload_length": 3})))
    (path / ("0" * 32 + ".warc.gz")).write_bytes(b"left over")
    write_warc(records(spark, 2), f"file://{path}")
    write_warc(records(spark, 3), f"file://{path}")
    assert read_ids(spark, f"file://{path}") == [1, 2, 3]

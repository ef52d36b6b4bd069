"""The queries of this subpackage, one per operator, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .conversation_repair import damage_and_repair
from .decontaminate import WIDTH, find_passages
from .exact_dedup import exact_dedup
from .line_spread import MIN_SITES, drop_boilerplate
from .main_text import extract_main_text
from .mil_classifier import classify
from .packing import pack, token_pieces
from .piece_codec import round_trip
from .quality_rules import quality_rules, trusted_ids
from .scratch import send_few_texts
from .sharded_lloyd import K, ROUNDS, lloyd
from .simhash import simhash_classes
from .url_filter import filter_urls
from .warc import archive_pages

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(_table(spark, folder, "documents"))


def op2_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as pages of the site in ``source``: per document the lines, those removed, and the text left."""
    cleaned = drop_boilerplate(_table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(_table(spark, folder, "documents"), trusted_ids(_table(spark, folder, "labels")))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_classes(_table(spark, folder, "documents")).drop("row_key", "class")


def op5_mil_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    send_few_texts(spark)
    both = round_trip(F.col("text"), public_tokenizers.path("piece_bpe_32k.model")).alias("both")
    coded = _table(spark, folder, "documents").select("doc_id", both).select("doc_id", "both.*")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(_table(spark, folder, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    send_few_texts(spark)
    texts = _table(spark, folder, "pages").select("page_id", "url", extract_main_text(F.col("html")).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_pages(_table(spark, folder, "pages"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(token_pieces(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return damage_and_repair(_table(spark, folder, "conversations"))


def op12_sharded_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    assigned, centroids = lloyd(_table(spark, folder, "embeddings"))
    # one row per centroid
    sums = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    rows = [
        (c, sums.get(c, 0), sum(sums.values()), sha256(",".join(map(str, numbers)).encode()).hexdigest())
        for c, numbers in enumerate(centroids.tolist())
    ]
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster").select("vec_id", "cluster", "distance", *clusters.columns[1:])


def op13_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = find_passages(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "row.doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_line_spread,
        op3_quality_rules,
        op4_simhash,
        op5_mil_classifier,
        op6_pieces,
        op7_url_filter,
        op8_main_text,
        op9_warc,
        op10_packing,
        op11_conversation_repair,
        op12_sharded_lloyd,
        op13_decontaminate,
    )
}

_BLANKS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"



def _attribute(name: str) -> str:
    return f"""replace(regexp_extract(tag, '(?is)(?:^|[^-\\w]){name}\\s*=\\s*["'']?([^"''\\s>]+)', 1), '&amp;', '&')"""


def _lloyd_rounds(rounds: int) -> str:
    """Rounds of assignments a0, a1, ... and centroids c0, c1, ... as common table expressions."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
            SELECT k.vec_id, k.v, c.c, list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
            FROM kept k CROSS JOIN c{i} c QUALIFY row_number() OVER (PARTITION BY k.vec_id ORDER BY d, c.c) = 1)""")
        if i < rounds:
            steps.append(f"""u{i} AS (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{i}),
        m{i} AS (SELECT c, p, floor(sum(x) / count(*))::BIGINT AS x FROM u{i} GROUP BY c, p),
        n{i} AS (SELECT c, list(x ORDER BY p) AS v FROM m{i} GROUP BY c),
        c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.v, o.v) AS v FROM c{i} o LEFT JOIN n{i} n ON n.c = o.c)""")
    return ",\n        ".join(steps)


_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def _url_part(group: int) -> str:
    return f"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', {group})"


ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH norm AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ), spread AS (
            SELECT doc_id, text_sha256, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
            FROM norm WINDOW same AS (PARTITION BY text_sha256)
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM spread""",
    "op2_line_spread": f"""
        WITH cut AS (
            SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
        ), lines AS (
            SELECT doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut
        ), spread AS (
            SELECT trim(line, {_BLANKS}) AS line FROM lines WHERE trim(line, {_BLANKS}) <> ''
            GROUP BY ALL HAVING count(DISTINCT source) >= {MIN_SITES}
        )
        SELECT doc_id, count(*) AS n_lines, count(s.line) AS n_removed,
            sha256(coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (s.line IS NULL), '')) AS text_sha256
        FROM lines l LEFT JOIN spread s ON trim(l.line, {_BLANKS}) = s.line GROUP BY doc_id""",
    "op7_url_filter": rf"""
        WITH RECURSIVE rules AS (
            SELECT * FROM (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}) v(rule_host, rule_path, verdict)
        ), tags AS (
            SELECT url, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\b[^>]*>')) AS tag
            FROM pages WHERE url IS NOT NULL
        ), links AS (
            SELECT url, {_attribute("href")} AS link FROM tags
            WHERE regexp_matches(tag, '(?is)^<link') AND regexp_matches(tag, '(?is)[^-\w]rel\s*=\s*["'']?canonical\b')
            UNION ALL
            SELECT url, {_attribute("url")} FROM tags
            WHERE regexp_matches(tag, '(?is)^<meta') AND regexp_matches(tag, '(?is)[^-\w]http-equiv\s*=\s*["'']?refresh\b')
        ), aims AS (
            SELECT url, split_part(link, '#', 1) AS aim, regexp_extract(url, '(?s)^(.*?://[^/?#]*)([^?#]*)', ['origin', 'path']) AS own
            FROM links WHERE split_part(link, '#', 1) <> '' AND contains(url, '://')
        ), told AS (
            SELECT url, CASE WHEN aim LIKE '//%' THEN split_part(url, '://', 1) || ':' || aim ELSE aim END AS b
            FROM aims WHERE aim LIKE '//%' OR regexp_matches(aim, '^[A-Za-z][A-Za-z0-9+.-]*://')
            UNION ALL SELECT url, own.origin || own.path || aim FROM aims WHERE aim LIKE '?%'
        ), walked(url, origin, p, q) AS (
            SELECT url, own.origin, (CASE WHEN aim LIKE '/%' THEN '' WHEN own.path = '' THEN '/' ELSE regexp_extract(own.path, '(?s)^.*/') END)
                || split_part(aim, '?', 1), regexp_extract(aim, '\?.*$')
            FROM aims WHERE aim NOT LIKE '//%' AND aim NOT LIKE '?%' AND NOT regexp_matches(aim, '^[A-Za-z][A-Za-z0-9+.-]*:')
            UNION SELECT url, origin, CASE
                WHEN regexp_matches(p, '/\.(/|$)') THEN regexp_replace(p, '/\.(/|$)', '/')
                WHEN regexp_matches(p, '^/\.\.(/|$)') THEN regexp_replace(p, '^/\.\.(/|$)', '/')
                ELSE regexp_replace(p, '/[^/]*/\.\.(/|$)', '/') END, q
            FROM walked WHERE regexp_matches(p, '/\.\.?(/|$)')
        ), edges AS (
            SELECT url AS a, b FROM told
            UNION ALL SELECT url, origin || p || q FROM walked WHERE NOT regexp_matches(p, '/\.\.?(/|$)')
        ), both_ways AS (
            SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b
        ), reach(a, b) AS (
            SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
        ), urls AS (
            SELECT url FROM pages UNION SELECT a FROM both_ways
        ), parts AS (
            SELECT url, {_url_part(1)} AS own_host, {_url_part(2)} AS path FROM urls
        ), hosts AS (
            SELECT url, translate(own_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
        ), ruled AS (
            SELECT url, any_value(host) AS host, any_value(path) AS path,
                arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM hosts LEFT JOIN rules ON starts_with(path, rule_path) AND (host = rule_host OR ends_with(host, '.' || rule_host))
            GROUP BY url
        ), aliases AS (
            SELECT DISTINCT r.a AS url, 'block' AS alias FROM reach r JOIN ruled b ON b.url = r.b WHERE b.verdict = 'block'
        )
        SELECT page_id, host, path, rule, coalesce(verdict, alias, 'allow') AS verdict
        FROM pages p JOIN ruled r ON r.url IS NOT DISTINCT FROM p.url LEFT JOIN aliases a ON a.url = p.url""",
    "op9_warc": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), kept AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS newest FROM payloads
        ), typed AS (SELECT *, payload_bytes >= 1000 AND page_id <> newest AS again FROM kept)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN again THEN newest END AS refers_to
        FROM typed""",
    "op12_sharded_lloyd": f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM kept QUALIFY c < {K}
        ), {_lloyd_rounds(ROUNDS)}
        SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
            sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(k.v, ',')) AS centroid_sha256
        FROM a{ROUNDS} a JOIN c{ROUNDS} k USING (c)""",
    "op13_decontaminate": f"""
        WITH items AS (
            SELECT item_id::VARCHAR AS item_id, {_WORDS} AS words FROM benchmark WHERE text IS NOT NULL
        ), sized AS (
            SELECT item_id, words, least(len(words), {WIDTH}) AS size FROM items WHERE len(words) > 0
        ), starts AS (
            SELECT item_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM sized
        ), patterns AS (
            SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS w FROM starts
        ), docs AS MATERIALIZED (
            SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {_WORDS} END AS words FROM documents
        ), places AS (
            SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i
            FROM docs, (SELECT DISTINCT size FROM patterns) WHERE len(words) >= size
        ), hits AS MATERIALIZED (
            SELECT doc_id, i, size, item_id
            FROM (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS w FROM places) JOIN patterns USING (size, w)
        ), covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hits)
            GROUP BY doc_id
        ), listed AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
            FROM hits GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)""",
}

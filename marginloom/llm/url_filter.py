"""URL filter: host and path rules, and block decisions that follow redirects and canonical links.

A rule fits a host and all its subdomains if the path of the url starts with that of the rule; the longest
rule wins. Urls that redirect to each other or name each other as canonical are one class, found as connected
components of these edges. If a rule blocks any url of a class, its other urls are blocked too, unless a
rule allows them by themselves: an explicit allow goes before what aliases bring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .scratch import Scratch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^[\s\S]*?://([^/?#]*)([^?#]*)"
_CANONICAL = r"(?is)<link\b(?=[^>]*(?<![-\w])rel\s*=\s*[\"']?canonical\b)[^>]*?(?<![-\w])href\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*(?<![-\w])http-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ? or #, A-Z in lower case; empty for null and without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty for null and without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def without_dots(path: Column) -> Column:
    """A path that begins with /, less its segments . and .. and what these take back."""
    segments = F.split(F.substr(path, F.lit(2)), "/")
    none = F.array().cast("array<string>")

    def step(kept: Column, segment: Column) -> Column:
        back = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(segment == ".", kept).when(segment == "..", back).otherwise(F.concat(kept, F.array(segment)))

    kept = F.aggregate(segments, none, step)
    # a path that ends in dots names the folder
    folder = F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0)
    plain = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(folder, "/").otherwise(""))
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), plain).otherwise(path)


def resolved(url: Column, link: Column) -> Column:
    """The url that a link on the page ``url`` leads to, without fragment; null for links within the page, to another
    kind of address (``mailto:``) and on a page whose url has no ://."""
    scheme, origin = F.regexp_extract(url, r"^[\s\S]*?(?=://)", 0), F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*", 0)
    base = F.regexp_extract(url, _PARTS, 2)
    target = F.regexp_extract(link, r"^[^#]*", 0)
    path, query = F.regexp_extract(target, r"^[^?]*", 0), F.regexp_extract(target, r"\?.*$", 0)
    # what stands beside the page: its path up to the last /
    beside = F.concat(F.regexp_extract(F.when(base == "", "/").otherwise(base), r"^.*/", 0), path)
    return (
        F.when((target == "") | (origin == ""), None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(origin, without_dots(path), query))
        .when(target.startswith("?"), F.concat(origin, base, query))
        .otherwise(F.concat(origin, without_dots(beside), query))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """Edges from_url, to_url of ``pages`` (url, html): all canonical links and refresh redirects.

    Relative links are resolved against the page's url: its scheme, host, folder or path, dot segments taken back.
    Fragments are left out, since they name a place within a page.
    """
    url = F.col("url")
    links = F.concat(*[F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in (_CANONICAL, _REFRESH)])
    # most pages have neither word, which a plain search finds sooner than a pattern
    marked = pages.where("url IS NOT NULL").where(r"html RLIKE '(?i)canonical|http-equiv'")
    found = marked.select(url.alias("from_url"), F.explode(links).alias("link")).where("link != ''")
    to_url = resolved(F.col("from_url"), F.replace("link", F.lit("&amp;"), F.lit("&")))
    return found.select("from_url", to_url.alias("to_url")).where("to_url IS NOT NULL")


def rule_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, rule, verdict of the longest fitting rule for each distinct url that has one.

    ``rules``: host, path, verdict (allow or block); of equal rules with both verdicts, allow wins.
    """
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    ends = urls.where("url IS NOT NULL").distinct().select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ends = ends.select("url", "path", F.explode(suffixes).alias("host")).where("host != ''")
    named = rules.select("host", F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    fitting = ends.join(named, "host").where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), (F.col("rule_verdict") == "allow").alias("allow")))
    chosen = fitting.groupBy("url").agg(best.alias("best"))
    return chosen.select("url", "best.rule", F.when(F.col("best.allow"), "allow").otherwise("block").alias("verdict"))


def judge_urls(urls: DataFrame, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """url, rule, verdict for each distinct url that a rule or an alias decides.

    ``edges``: from_url, to_url. Urls that only occur as the end of an edge count too: a page that redirects to
    a blocked url is blocked. Self-loops, repeated edges and null ends don't matter.
    """
    scratch = Scratch(urls.sparkSession, "url-filter")
    edges = scratch.table(edges.select("from_url", "to_url"), "edges")
    ends = edges.select(F.col("from_url").alias("url")).unionAll(edges.select("to_url"))
    ruled = scratch.table(rule_verdicts(urls.select("url").unionAll(ends), rules), "ruled")
    classes = components(edges.toDF("a", "b"), scratch).toDF("url", "root")
    members = scratch.table(classes.join(ruled, "url", "left"), "members")
    blocked = members.where("verdict = 'block'").select("root").distinct()
    aliases = members.where("verdict IS NULL").join(blocked, "root", "left_semi")
    passed_on = aliases.select("url", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"))
    return scratch.table(ruled.unionAll(passed_on), "verdicts")


def filter_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url and, without ``edges``, html; others are ignored): page_id,
    host, path, rule, verdict.

    rule is the longest rule that fits, as host and path, or null; then the verdict is block if an alias is
    blocked, else allow. A null or relative url has empty host and path, no rule and no alias. Repeated rows
    are judged alike. An empty table gives an empty result; without rules everything is allowed.
    """
    edges = link_edges(pages) if edges is None else edges
    verdicts = judge_urls(pages.select("url"), rules, edges)
    judged = pages.select("page_id", "url").join(verdicts, "url", "left")
    return judged.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )

"""URL filters with redirect equivalence.

Rules (verdict, host, path) fit a host and its subdomains where the path
starts with the rule's path; the longest rule wins.  Pages that redirect to
each other or name a canonical address are the same page for blocking: their
addresses form a graph, connected components are found on Spark, and a page
without a rule of its own takes its component's decision.  In a component an
explicit allow goes before any block; without either the page is allowed.

Address keys drop scheme, fragment, ``utm_`` parameters and a trailing slash;
pages with the same key are one node.  Link targets that are not pages of the
table count too: a rule that fits the target decides the component.

Defined cases: null url or a url without ``://`` has empty host and path, no
rule and no links (verdict allow); null html has no links; repeated rows give
repeated result rows; an empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialise, pick, table
from tidewatch.llm.components import connected_components

#: The rules of the query: (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

_HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_TARGET = r"(?is)\burl\s*=\s*['\"]?([^\s\"'>]+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST_PATH, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _HOST_PATH, 2)


def fit(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:], r[0])):
        hit = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def address_key(url: Column) -> Column:
    """Node of the link graph, null where the url has no ``://``."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    query = F.regexp_replace(query, r"(?<=[?&])utm_[^&]*(&|$)", "")
    query = F.regexp_replace(query, r"[?&]$", "")
    return F.when(url.contains("://"), F.concat(host(url), F.regexp_replace(path(url), "/+$", ""), query))


def resolve(base: Column, href: Column) -> Column:
    """Absolute address of a link found on page ``base``."""
    href = F.regexp_replace(F.trim(href), "&amp;", "&")
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(base, _HOST_PATH, 1))
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
             .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
             .when(href.startswith("/"), F.concat(root, href))
             .when((href != "") & ~href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:|^[#?]"),
                   F.concat(root, F.regexp_replace(path(base), "[^/]*$", ""), href)))


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst) addresses: canonical links and meta redirects of each page's html."""
    p = pick(pages, "url", "html").filter(F.col("url").contains("://") & F.col("html").isNotNull())
    p = p.filter(F.lower("html").contains("canonical") | F.lower("html").contains("refresh"))
    tag = F.regexp_extract("html", _LINK, 0)
    href = F.concat(*[F.regexp_extract(tag, _HREF, k) for k in (1, 2, 3)])
    refresh = F.regexp_extract(F.regexp_extract("html", _REFRESH, 0), _TARGET, 1)
    both = p.select("url", F.explode(F.array(href, refresh)).alias("href")).filter("href <> ''")
    return both.select(F.col("url").alias("src"), resolve(F.col("url"), F.col("href")).alias("dst")).filter("dst IS NOT NULL")


def url_filter(pages: DataFrame, links: DataFrame | None = None,
               rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Every page with host, path, rule, key, component and verdict.

    ``links`` (src, dst: addresses) are redirects known from elsewhere, such as
    a crawl log; they are added to those found in the html.
    """
    found = page_links(pages)
    if links is not None:
        found = found.union(pick(links, "src", "dst"))
    found = materialise(found.filter("src IS NOT NULL AND dst IS NOT NULL").distinct(), "url-links")
    edges = found.select(address_key(F.col("src")).alias("u"), address_key(F.col("dst")).alias("v"))
    parts = connected_components(edges.filter("u IS NOT NULL AND v IS NOT NULL"), "url-components")

    p = pick(pages, "page_id", "url").withColumns({"host": host(F.col("url")), "path": path(F.col("url")),
                                                   "key": address_key(F.col("url"))})
    p = p.withColumn("fit", fit(F.col("host"), F.col("path"), rules))
    # decisions of addresses: pages and link ends, one row per key and kind after a partial aggregate
    ends = found.select(F.explode(F.array("src", "dst")).alias("url"))
    ends = ends.select(address_key(F.col("url")).alias("key"), fit(host(F.col("url")), path(F.col("url")), rules).alias("fit"))
    said = p.select("key", "fit").union(ends).filter("key IS NOT NULL AND fit IS NOT NULL").groupBy("key").agg(
        F.max((F.col("fit.verdict") == "allow").cast("int")).alias("allow"),
        F.max((F.col("fit.verdict") == "block").cast("int")).alias("block"))
    parts = materialise(parts, "url-parts")
    said = said.join(parts, said["key"] == parts["node"], "left").select(
        F.coalesce("component", "key").alias("component"), "allow", "block")
    said = said.groupBy("component").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    decided = parts.join(said, "component").select("node", "component", "allow", "block")
    alone = said.join(parts, said["component"] == parts["node"], "left_anti").select(
        F.col("component").alias("node"), "component", "allow", "block")
    decided = materialise(decided.union(alone), "url-decisions")
    out = p.join(decided, p["key"] == decided["node"], "left")
    verdict = (F.when(F.col("fit").isNotNull(), F.col("fit.verdict")).when(F.col("allow") == 1, "allow")
               .when(F.col("block") == 1, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"),
                      F.coalesce("component", "key").alias("component"))


def q_op9(spark, sf_dir):
    return url_filter(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


_SORTED = sorted(RULES, key=lambda r: -len(r[1] + r[2]))


def _case(value) -> str:
    return "CASE " + " ".join(
        f"WHEN (h = '{h}' OR ends_with(h, '.{h}')) AND starts_with(p, '{p}') THEN '{value(v, h, p)}'" for v, h, p in _SORTED) + " END"


_PARTS = r"translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h, " \
         r"regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS p, " \
         r"regexp_replace(regexp_replace(regexp_extract({u}, '(?s)^[^?#]*(\?[^#]*)', 1), '([?&])(utm_[^&]*(&|$))+', '\1', 'g'), '[?&]$', '') AS q"
ORACLE_OP9 = rf"""
WITH RECURSIVE raw AS (SELECT url,
    regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>') AS tag,
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*[''"]?([^\s"''>]+)', 1) AS refresh
  FROM pages WHERE contains(url, '://') AND html IS NOT NULL),
hrefs AS (SELECT url, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^\s>"'']*)', 1) AS href FROM raw UNION ALL SELECT url, refresh FROM raw),
links AS (SELECT url AS src, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
    WHEN starts_with(href, '/') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*') || href END AS dst FROM hrefs WHERE href <> ''),
ends AS (SELECT src AS url FROM links UNION SELECT dst FROM links WHERE dst IS NOT NULL),
a AS (SELECT page_id, url, {_PARTS.format(u="coalesce(url, '')")} FROM pages),
b AS (SELECT NULL AS page_id, url, {_PARTS.format(u="url")} FROM ends),
n AS (SELECT *, CASE WHEN contains(url, '://') THEN h || regexp_replace(p, '/+$', '') || q END AS key,
    {_case(lambda v, h, p: h + p)} AS rule, {_case(lambda v, h, p: v)} AS said FROM (SELECT * FROM a UNION ALL SELECT * FROM b)),
e AS (SELECT DISTINCT x.key AS u, y.key AS v FROM links JOIN n x ON x.url = links.src JOIN n y ON y.url = links.dst),
s AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach(node, other) AS (SELECT DISTINCT u, u FROM s UNION SELECT reach.node, s.v FROM reach JOIN s ON s.u = reach.other),
comp AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
said AS (SELECT coalesce(component, key) AS c, max(said = 'allow') AS allow, max(said = 'block') AS block
  FROM n LEFT JOIN comp ON key = node WHERE said IS NOT NULL AND key IS NOT NULL GROUP BY 1)
SELECT page_id, h AS host, p AS path, rule, coalesce(said, CASE WHEN allow THEN 'allow' WHEN block THEN 'block' END, 'allow') AS verdict
FROM n LEFT JOIN comp ON key = node LEFT JOIN said ON c = coalesce(component, key) WHERE page_id IS NOT NULL
"""

"""URL filter over redirect equivalence (operator 11).

A rule (host, path, verdict) fits its host and all subdomains when the url's path starts
with the rule's path; of the rules that fit, the one with the longest host and path decides
(then the one with the longer host, then allow before block).  Rules are looked up once per
distinct host, by the host's suffixes, so a hot host is one row of that join.

Urls that no rule fits are judged by their aliases:

1. Two urls are one node when they agree after dropping the scheme (http and https only),
   default port, fragment, tracking parameters (``TRACKING``) and writing an empty path as
   ``/``; nodes are 128-bit digests of that text.
2. Edges are the canonical links and the meta refreshes of the pages (outside of comments),
   and any redirects given as (from_url, to_url) rows.  References are resolved against
   the page's url; ``..`` is compared as it stands.
3. Connected components of the edges come from distributed star contraction
   (``graph.components``); a hub that a third of all pages name is one row per edge, and
   its minima are taken in the tasks first.
4. A component in which a rule allows some url (page or target) allows all its urls that
   no rule fits; else one in which a rule blocks some url blocks them.  A page's own rule
   always stands.

Defined cases: a url that is null or has no ``://`` has an empty host and path, is no node
and is allowed unless a rule fits the empty host (none does); null html has no edges; a
page that points to itself has no edge; rows of equal url are one node and each get the
result; a null page_id is kept; empty tables (pages, rules or redirects) give no rows, no
rule or no edges; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm.common import read_table, workspace, written
from lapforge.llm.graph import components

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = "utm_[^=]*|gclid|fbclid"
KEY = ["k1", "k2"]

# The rules of the registered query (fixed values)
RULES = [("net", "/", BLOCK), ("example.net", "/en/", ALLOW), ("example.com", "/de/", BLOCK), ("org", "/fr/", ALLOW)]

_TAG = r"(?i)<(?:link|meta)\b[^>]*>"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_CANONICAL = r"""(?i)\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""
_TO = r"""(?i)\burl\s*=\s*["']?([^"'\s>;]+)"""


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The text that urls of one node share; null without ``://``."""
    scheme = F.lower(F.substring_index(url, "://", 1))
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?:{TRACKING})(?:=|$)")), "&")
    path = path_of(url)
    return F.when(F.instr(url, "://") > 0, F.concat(
        F.when(scheme.isin("http", "https"), F.lit("")).otherwise(F.concat(scheme, F.lit(":"))),
        F.regexp_replace(host_of(url), ":(?:80|443)$", ""), F.when(path == "", F.lit("/")).otherwise(path),
        F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept))))


def resolved(url: Column, to: Column) -> Column:
    """The reference ``to`` of a page at ``url`` as a url of its own; null where it is none."""
    to = F.replace(to, F.lit("&amp;"), F.lit("&"))
    scheme = F.substring_index(url, "://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_replace(path_of(url), "[^/]*$", "")
    return F.when(F.instr(to, "://") > 0, to).when(F.instr(url, "://") == 0, F.lit(None).cast("string")) \
        .when(to.startswith("//"), F.concat(scheme, F.lit(":"), to)) \
        .when(to.rlike("^(?:#|[A-Za-z][A-Za-z0-9+.-]*:)"), F.lit(None).cast("string")) \
        .when(to.startswith("/"), F.concat(site, to)).when(to.startswith("?"), F.concat(site, path_of(url), to)) \
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), to))


def page_edges(pages: DataFrame) -> DataFrame:
    """from_url, to_url of the canonical links and refreshes in the pages."""
    tags = F.regexp_extract_all(F.regexp_replace("html", _COMMENT, ""), F.lit(_TAG), F.lit(0))
    tag = F.col("tag")
    to = F.when(tag.rlike("(?i)^<link") & tag.rlike(_CANONICAL), F.regexp_extract(tag, _HREF, 1)) \
        .when(tag.rlike("(?i)^<meta") & tag.rlike(_REFRESH), F.regexp_extract(tag, _TO, 1))
    return pages.where(F.col("url").isNotNull() & F.col("html").rlike("(?i)canonical|refresh")) \
        .select("url", F.explode(tags).alias("tag")).select(F.col("url").alias("from_url"), to.alias("to")) \
        .where("to <> ''").select("from_url", resolved(F.col("from_url"), F.col("to")).alias("to_url"))


def with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with a column url) with host, path, rule and ruled (its verdict; null where none fits)."""
    urls = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    hosts = urls.select("host").where("host <> ''").distinct()
    parts = F.split("host", r"\.")
    suffixes = hosts.select("host", parts.alias("parts")).select(
        "host", F.explode(F.transform(F.sequence(F.lit(1), F.size("parts")),
                                      lambda i: F.array_join(F.slice("parts", i, F.size("parts")), "."))).alias("suffix"))
    known = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "verdict")
    length = F.length("suffix") + F.length("prefix")
    fitting = suffixes.join(known, "suffix").groupBy("host").agg(F.sort_array(F.collect_set(F.struct(
        (-length).alias("shorter"), (-F.length("suffix")).alias("narrower"), (F.col("verdict") == BLOCK).alias("blocks"),
        F.concat("suffix", "prefix").alias("rule"), "prefix", "verdict"))).alias("fitting"))
    first = F.get(F.filter("fitting", lambda r: F.col("path").startswith(r["prefix"])), F.lit(0))
    return urls.join(fitting, "host", "left").withColumn("first", first) \
        .select(*urls.columns, F.col("first.rule").alias("rule"), F.col("first.verdict").alias("ruled"))


def keyed(urls: DataFrame, column: str = "url", names: list[str] = KEY) -> DataFrame:
    """``urls`` with the 128-bit digest of the url's node (null where it has none)."""
    node = urls.withColumn("_node", node_of(F.col(column)))
    return node.select(*urls.columns, *(F.when(F.col("_node").isNotNull(), F.xxhash64(F.lit(i), "_node")).alias(n)
                                        for i, n in enumerate(names)))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    rows = pages.select("page_id", pages["url"].cast("string").alias("url"))
    links = page_edges(pages.select(pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html")))
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    with workspace(spark, "url-filter") as write:
        ends = keyed(keyed(links, "from_url", ["a1", "a2"]), "to_url", ["b1", "b2"])
        ends = write(ends.where("a1 is not null and b1 is not null and (a1 <> b1 or a2 <> b2)"), "links")
        sides = [ends.select(F.col(f"{e}_url").alias("url"), F.col(f"{s}1").alias("k1"), F.col(f"{s}2").alias("k2"))
                 for e, s in (("from", "a"), ("to", "b"))]
        nodes = write(sides[0].unionByName(sides[1]).select(*KEY).distinct()
                      .withColumn("id", F.monotonically_increasing_id()), "nodes")
        edges = ends.select("a1", "a2", "b1", "b2").distinct()
        for s in "ab":
            edges = edges.join(nodes.select(F.col("k1").alias(f"{s}1"), F.col("k2").alias(f"{s}2"),
                                            F.col("id").alias(s)), [f"{s}1", f"{s}2"])
        label = components(edges.select("a", "b"), write)
        judged = write(keyed(with_rules(rows, rules)), "judged")
        explicit = judged.select(*KEY, "ruled").where("ruled is not null and k1 is not null").unionByName(
            with_rules(sides[1].dropDuplicates(["url"]), rules).select(*KEY, "ruled").where("ruled is not null")).distinct()
        blocked = nodes.join(label.withColumnRenamed("node", "id"), "id").select(*KEY, "label")
        decided = blocked.join(explicit, KEY).groupBy("label").agg(
            F.max(F.col("ruled") == ALLOW).alias("allowed")).where("not allowed").select("label")
        blocked = blocked.join(decided, "label").select(*KEY, F.lit(BLOCK).alias("found"))
        open_rows = judged.where("ruled is null").join(blocked, KEY, "left") \
            .withColumn("verdict", F.coalesce("found", F.lit(ALLOW)))
        out = ["page_id", "host", "path", "rule", "verdict"]
        return written(judged.where("ruled is not null").withColumn("verdict", F.col("ruled")).select(*out)
                       .unionByName(open_rows.select(*out)), "url-verdicts")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(read_table(spark, sf_dir, "pages"), rules)


def _sql_parts(url: str) -> dict[str, str]:
    """SQL for the parts of a url."""
    rest = f"CASE WHEN contains({url}, '://') THEN substr({url}, instr({url}, '://') + 3) END"
    host = f"coalesce(translate(regexp_extract({rest}, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '')"
    path = f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')"
    kept = f"""array_to_string(list_filter(string_split(regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1), '&'),
        lambda p: p <> '' AND NOT regexp_matches(p, '^(?:{TRACKING})(?:=|$)')), '&')"""
    scheme = f"lower(split_part({url}, '://', 1))"
    node = f"""CASE WHEN contains({url}, '://') THEN
        (CASE WHEN {scheme} IN ('http', 'https') THEN '' ELSE {scheme} || ':' END)
        || regexp_replace({host}, ':(?:80|443)$', '') || (CASE WHEN {path} = '' THEN '/' ELSE {path} END)
        || (CASE WHEN {kept} = '' THEN '' ELSE '?' || {kept} END) END"""
    return {"host": host, "path": path, "node": node}


def _sql_ruled(rows: str, columns: str) -> str:
    """SQL for ``columns``, rule, verdict of rows with url, host and path."""
    return f"""
  SELECT {columns}, (SELECT r.host || r.path FROM rules r
      WHERE ('.' || t.host) LIKE ('%.' || r.host) AND starts_with(t.path, r.path)
      ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, verdict LIMIT 1) AS rule,
    (SELECT r.verdict FROM rules r WHERE ('.' || t.host) LIKE ('%.' || r.host) AND starts_with(t.path, r.path)
      ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, verdict LIMIT 1) AS ruled
  FROM {rows} t"""


_P, _T = _sql_parts("url"), _sql_parts("to_url")
OP11_SQL = f"""
WITH RECURSIVE rules(host, path, verdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
p AS (SELECT page_id, url, html, {_P['host']} AS host, {_P['path']} AS path, {_P['node']} AS node FROM pages),
judged AS ({_sql_ruled('p', 't.page_id, t.host, t.path, t.node')}),
tags AS (
  SELECT url, host, path, node, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?(?:-->|\\z)', '', 'g'),
    '(?i)<(?:link|meta)\\b[^>]*>')) AS tag FROM p WHERE regexp_matches(html, '(?i)canonical|refresh')),
refs AS (
  SELECT *, replace(CASE
    WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, '{_CANONICAL.replace("'", "''")}')
      THEN regexp_extract(tag, '{_HREF.replace("'", "''")}', 1)
    WHEN regexp_matches(tag, '(?i)^<meta') AND regexp_matches(tag, '{_REFRESH.replace("'", "''")}')
      THEN regexp_extract(tag, '{_TO.replace("'", "''")}', 1) END, '&amp;', '&') AS ref FROM tags),
targets AS (
  SELECT node AS a, CASE WHEN contains(ref, '://') THEN ref WHEN NOT contains(url, '://') THEN NULL
    WHEN starts_with(ref, '//') THEN split_part(url, '://', 1) || ':' || ref
    WHEN regexp_matches(ref, '^(?:#|[A-Za-z][A-Za-z0-9+.-]*:)') THEN NULL
    WHEN starts_with(ref, '/') THEN split_part(url, '://', 1) || '://' || host || ref
    WHEN starts_with(ref, '?') THEN split_part(url, '://', 1) || '://' || host || path || ref
    ELSE split_part(url, '://', 1) || '://' || host || CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/'
      ELSE regexp_replace(path, '[^/]*$', '') END || ref END AS to_url FROM refs WHERE ref <> ''),
parts AS (SELECT a, to_url AS url, {_T['host']} AS host, {_T['path']} AS path, {_T['node']} AS b FROM targets),
named AS ({_sql_ruled('parts', 't.a, t.b')}),
edges AS (SELECT a, b FROM named WHERE a <> b UNION SELECT b, a FROM named WHERE a <> b),
reach AS (SELECT a AS x, a AS y FROM edges UNION SELECT r.x, e.b FROM reach r JOIN edges e ON r.y = e.a),
said AS (SELECT node, ruled FROM judged UNION SELECT b, ruled FROM named),
found AS (
  SELECT x, CASE WHEN bool_or(ruled = '{ALLOW}') THEN '{ALLOW}' WHEN bool_or(ruled = '{BLOCK}') THEN '{BLOCK}' END AS v
  FROM reach JOIN said ON said.node = y GROUP BY x)
SELECT page_id, host, path, rule, coalesce(ruled, v, '{ALLOW}') AS verdict FROM judged LEFT JOIN found ON x = node
"""

"""URL filters with redirect equivalence.

A url's own verdict comes from the longest rule that fits its host and path.
Redirects and canonical links make urls aliases of each other: distributed
connected components over those edges carry a block to every alias that no rule
judges, unless an alias is explicitly allowed.  A url's own rule always wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, written
from tidemark.llm.graph import components

#: (verdict, host, path start).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)^(.*?://)([^/?#]*)([^?#]*)([^#]*)"
_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"""(?is)\srel\s*=\s*["']?[^"'>]*\bcanonical\b"""
_REFRESH = r"""(?is)\shttp-equiv\s*=\s*["']?\s*refresh\b"""
_HREF = r"""(?is)\shref\s*=\s*["']?\s*([^"'\s>]+)"""
_TARGET = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)"""


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, group), F.lit(""))


def host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end,
    with A-Z lower-cased; empty for a null url or one without ``://``."""
    return F.translate(_part(url, 2), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return _part(url, 3)


def node(url: Column) -> Column:
    """The name under which a url's aliases are tied: scheme and host
    lower-cased, no fragment.  Null without ``://``."""
    return F.when(F.instr(url, "://") > 0, F.concat(
        F.translate(_part(url, 1), _UPPER, _LOWER), host(url), path(url), _part(url, 4)))


def rule(host_: Column, path_: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as ``struct(rule, verdict)``, or null; of
    equally long ones an allow comes first."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow")):
        fits = ((host_ == h) | F.endswith(host_, F.lit("." + h))) & F.startswith(path_, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def page_edges(pages: DataFrame) -> DataFrame:
    """``src, dst``: a page's url and the url that its canonical link or refresh
    names.  Targets that start with ``//``, ``/``, ``?`` or a name are resolved
    against the page's url; ``..`` stays as it is.  Pages without html, url or
    such a tag give no edge."""
    tags = pages.where("html is not null and url is not null").select(
        "url", F.explode(F.regexp_extract_all("html", F.lit(_TAG), F.lit(0))).alias("tag"))
    to = F.when(F.col("tag").rlike(_CANONICAL), F.regexp_extract("tag", _HREF, 1)).when(
        F.col("tag").rlike(_REFRESH), F.regexp_extract("tag", _TARGET, 1))
    edges = tags.withColumn("to", F.replace(to, F.lit("&amp;"), F.lit("&"))).where(
        "to is not null and to <> '' and not startswith(to, '#')")
    u = F.col("url")
    top = F.concat(_part(u, 1), _part(u, 2))
    full = (F.when(F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
            .when(F.startswith("to", F.lit("//")), F.concat(F.regexp_extract(u, r"^[^:]*:", 0), "to"))
            .when(F.startswith("to", F.lit("/")), F.concat(top, "to"))
            .when(F.startswith("to", F.lit("?")), F.concat(top, path(u), "to"))
            .otherwise(F.concat(top, F.regexp_replace(F.concat(path(u), F.lit("")), r"[^/]*$", ""),
                                F.when(F.instr(path(u), "/") > 0, "").otherwise("/"), "to")))
    return edges.select(F.col("url").alias("src"), full.alias("dst"))


def filter_urls(pages: DataFrame, edges: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, component`` for every row of
    ``pages`` (``page_id, url``), given alias edges (``src, dst`` urls).

    ``verdict`` is the url's own rule's; else, over all urls that edges tie to
    it, ``allow`` if a rule allows one, ``block`` if a rule blocks one; else
    ``allow``.  Urls that are only targets of edges count like pages.  A null
    url, or one without ``://``, has empty host and path and no aliases.
    Repeated rows get a row each; repeated edges and loops count once; either
    table may be empty.
    """
    ends = edges.select(node(F.col("src")).alias("u"), node(F.col("dst")).alias("v"))
    tied = written(components(ends, "url-aliases"), "url-components")
    own = rule(host(F.col("node")), path(F.col("node")), rules)["verdict"]
    verdicts = tied.withColumn("own", own).groupBy("component").agg(
        F.max(F.when(F.col("own") == "allow", "allow")).alias("_allow"),
        F.max(F.when(F.col("own") == "block", "block")).alias("_block"))
    known = tied.join(verdicts, "component").select(
        F.col("node").alias("_node"), "component", F.coalesce("_allow", "_block").alias("_alias"))
    rows = pages.select("page_id", "url").select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        node(F.col("url")).alias("_node"))
    rows = rows.withColumn("_rule", rule(F.col("host"), F.col("path"), rules))
    return rows.join(known, "_node", "left").select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_alias", F.lit("allow")).alias("verdict"),
        F.coalesce("component", "_node").alias("component"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, page_edges(pages))


ORACLE = r"""
WITH RECURSIVE u AS (
  SELECT page_id, url, html, lower_host AS host, coalesce(regexp_extract(url, '(?s)^(.*?://)([^/?#]*)([^?#]*)', 3), '') AS path,
    CASE WHEN instr(url, '://') > 0 THEN
      translate(regexp_extract(url, '(?s)^(.*?://)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      || lower_host || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS node
  FROM (SELECT *, translate(coalesce(regexp_extract(url, '(?s)^(.*?://)([^/?#]*)([^?#]*)', 2), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_host FROM pages)),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM u
         WHERE html IS NOT NULL AND url IS NOT NULL),
tos AS (SELECT url, replace(CASE
    WHEN regexp_matches(tag, '(?is)\srel\s*=\s*["'']?[^"''>]*\bcanonical\b')
      THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)\shttp-equiv\s*=\s*["'']?\s*refresh\b')
      THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1) END, '&amp;', '&') AS dest FROM tags),
dst AS (SELECT url AS src, CASE
    WHEN regexp_matches(dest, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN dest
    WHEN starts_with(dest, '//') THEN regexp_extract(url, '^[^:]*:') || dest
    WHEN starts_with(dest, '/') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*') || dest
    WHEN starts_with(dest, '?') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*') || dest
    ELSE regexp_extract(url, '(?s)^.*?://[^/?#]*')
      || regexp_replace(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '[^/]*$', '')
      || CASE WHEN instr(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/') > 0 THEN '' ELSE '/' END || dest
    END AS dst FROM tos WHERE dest IS NOT NULL AND dest <> '' AND NOT starts_with(dest, '#')),
ends AS (SELECT translate(regexp_extract(x, '(?s)^(.*?://[^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_extract(x, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS u,
    translate(regexp_extract(y, '(?s)^(.*?://[^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_extract(y, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS v
  FROM (SELECT src AS x, dst AS y FROM dst WHERE instr(src, '://') > 0 AND instr(dst, '://') > 0)),
e AS (SELECT u, v FROM ends WHERE u <> v UNION SELECT v, u FROM ends WHERE u <> v),
reach AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM reach r JOIN e ON r.v = e.u),
own AS (SELECT DISTINCT v AS node, regexp_extract(v, '(?s)^.*?://([^/?#]*)', 1) AS host,
               regexp_extract(v, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM reach),
rules AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) t(verdict, h, p)),
alias AS (SELECT u AS node, min(v) AS component,
    coalesce(max(CASE WHEN verdict = 'allow' THEN 'allow' END), max(CASE WHEN verdict = 'block' THEN 'block' END)) AS verdict
  FROM reach LEFT JOIN (
    SELECT node, arg_max(r.verdict, length(h || p)) AS verdict FROM own JOIN rules r
      ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY node) o ON o.node = reach.v
  GROUP BY u),
fit AS (SELECT page_id, arg_max(r.verdict, length(h || p)) AS verdict, arg_max(h || p, length(h || p)) AS rule
  FROM u JOIN rules r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, alias.verdict, 'allow') AS verdict,
       coalesce(alias.component, u.node) AS component
FROM u LEFT JOIN fit USING (page_id) LEFT JOIN alias ON alias.node = u.node
"""

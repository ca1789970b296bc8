"""URL filters over redirect equivalence, in DataFrame functions only.

A rule is a host and the start of a path; it fits the host and its subdomains, and the longest that fits decides. Pages are
also tied to what they redirect to or name as their canonical page. Connected components over these links carry
decisions to aliases that no rule fits: an explicit allow among a page's aliases comes first, then a block.

Rules are matched once for each distinct host and path, by a join on the host's suffixes; links are read from the pages'
markup. Components come from ``components``.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule fits it and it is allowed; null
markup has no links; links without a host are left out; a page that no rule fits and that has no aliases is allowed; two
rules of one length that fit: the longer host, then the block; repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.chunks import settled
from parley.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>;]+)"""
#: Rules up to which they are broadcast, some 100 bytes each.
BROADCAST_RULES = 100_000


def with_parts(rows: DataFrame, url: str) -> DataFrame:
    """rows with host, path and address of the url column. An address is host, path and query, without the fragment; it
    tells pages apart in the graph and is null without a host. One step at a time, so that no expression is repeated."""
    found = F.instr(url, "://")
    return (
        rows.withColumn("rest", F.coalesce(F.when(found > 0, F.col(url).substr(found + 3, F.length(url))), F.lit("")))
        .withColumn("host", F.regexp_extract("rest", "^[^/?#]*", 0))
        .withColumn("after", F.expr("substring(rest, length(host) + 1)"))
        .withColumn("host", F.translate("host", UPPER, LOWER))
        .withColumn("path", F.regexp_extract("after", "^[^?#]*", 0))
        .withColumn("address", F.when(F.col("host") != "", F.concat("host", F.regexp_extract("after", "^[^#]*", 0))))
        .drop("rest", "after")
    )


def resolved(link: Column, scheme: Column, host: Column, path: Column, url: Column) -> Column:
    """A link as a whole url, seen from a page with these parts."""
    site = F.concat(scheme, F.lit("://"), host)
    return (
        F.when(F.instr(link, "://") > 0, link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(site, path, link))
        .when(link.startswith("#"), url)
        .otherwise(F.concat(site, F.when(path == "", "/").otherwise(F.regexp_extract(path, "^.*/", 0)), link))
    )


def links(pages: DataFrame) -> DataFrame:
    """(a, b): addresses of pages and of what they redirect to or name canonical."""
    found = F.array(F.regexp_extract(F.regexp_extract("html", CANONICAL, 0), HREF, 1), F.regexp_extract(F.regexp_extract("html", REFRESH, 0), TARGET, 1))
    linked = pages.where("html is not null and url is not null").select("url", F.explode(found).alias("link")).where("link <> ''")
    linked = with_parts(linked.withColumn("link", F.regexp_replace("link", "&amp;", "&")), "url").withColumn("scheme", F.regexp_extract("url", "^([^:/?#]*):", 1))
    # Written once, as Spark would else repeat the whole chain of expressions in every filter that it moves down.
    linked = settled(linked.select("url", "link", "scheme", "host", "path", "address"))
    whole = linked.select(F.col("address").alias("a"), resolved(F.col("link"), F.col("scheme"), F.col("host"), F.col("path"), F.col("url")).alias("target"))
    return with_parts(whole, "target").select("a", F.col("address").alias("b")).where("a is not null and b is not null and a <> b").distinct()


def decided(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of those distinct hosts and paths that a rule fits; rules: (rule_host, rule_path, rule_verdict)."""
    if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        rules = F.broadcast(rules)
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = places.distinct().where("host <> ''").withColumn("suffix", F.explode(suffixes)).join(rules, F.col("suffix") == F.col("rule_host")).where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    longest = F.max(F.struct(F.length(rule).alias("long"), F.length("rule_host").alias("of_host"), (F.col("rule_verdict") == "block").alias("block"), rule.alias("rule"), "rule_verdict"))
    return fits.groupBy("host", "path").agg(longest.alias("best")).select("host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("verdict"))


def judged(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and reason (rule, alias or default) of every page; edges: more (a, b) addresses."""
    pages = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    edges = links(pages) if edges is None else links(pages).unionByName(edges.select("a", "b"))
    aliases = settled(components(edges))
    places = aliases.select("component", "node", F.regexp_extract("node", "^[^/?]*", 0).alias("host"), F.regexp_replace(F.regexp_replace("node", "^[^/?]*", ""), r"\?.*$", "").alias("path"))
    shown = with_parts(pages.select("page_id", "url"), "url").select("page_id", "host", "path", F.col("address").alias("node"))
    found = settled(decided(shown.select("host", "path").unionByName(places.select("host", "path")), rules))
    # Of a component's decisions the least word comes first: allow before block.
    carried = places.join(found, ["host", "path"]).groupBy("component").agg(F.min("verdict").alias("carried"))
    carried = aliases.join(carried, "component").select("node", "carried")
    return (
        shown.join(found, ["host", "path"], "left")
        .join(carried, "node", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("verdict", "carried", F.lit("allow")).alias("verdict"),
            F.when(F.col("rule").isNotNull(), "rule").when(F.col("carried").isNotNull(), "alias").otherwise("default").alias("reason"),
        )
    )


def oracle_sql(rules: list[tuple[str, str, str]]) -> str:
    """The same over the table pages as DuckDB SQL, with components as a recursive closure."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def parts(source: str, url: str, keep: str) -> str:
        rest = f"coalesce(CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) END, '')"
        return f"""SELECT {keep}, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(after, '^[^?#]*') AS path, regexp_extract(after, '^[^#]*') AS tail
FROM (SELECT *, substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS after FROM (SELECT *, {rest} AS rest FROM {source}))"""

    values = ", ".join(f"({quoted(h)}, {quoted(p)}, {quoted(v)})" for h, p, v in rules)
    return f"""
WITH RECURSIVE rules(rule_host, rule_path, rule_verdict) AS (VALUES {values}),
shown AS (SELECT *, CASE WHEN host <> '' THEN host || tail END AS node FROM ({parts("pages", "url", "page_id, url, html")})),
link AS (SELECT node, url, host, path, regexp_extract(url, '^([^:/?#]*):', 1) AS scheme, replace(unnest([
    regexp_extract(regexp_extract(html, {quoted(CANONICAL)}), {quoted(HREF)}, 1),
    regexp_extract(regexp_extract(html, {quoted(REFRESH)}), {quoted(TARGET)}, 1)]), '&amp;', '&') AS link
  FROM shown WHERE html IS NOT NULL AND url IS NOT NULL),
target AS (SELECT node AS a, CASE WHEN instr(link, '://') > 0 THEN link WHEN starts_with(link, '//') THEN scheme || ':' || link
    WHEN starts_with(link, '/') THEN scheme || '://' || host || link WHEN starts_with(link, '?') THEN scheme || '://' || host || path || link
    WHEN starts_with(link, '#') THEN url
    ELSE scheme || '://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '^.*/') END || link END AS target
  FROM link WHERE link <> ''),
edge AS (SELECT a, CASE WHEN host <> '' THEN host || tail END AS b FROM ({parts("target", "target", "a")})),
tie AS (SELECT a, b FROM edge WHERE a <> b UNION SELECT b, a FROM edge WHERE a <> b),
reach AS (SELECT a AS node, a AS other FROM tie UNION SELECT r.node, t.b FROM reach r JOIN tie t ON t.a = r.other),
place AS (SELECT host, path FROM shown UNION SELECT regexp_extract(other, '^[^/?]*'),
    regexp_replace(substr(other, length(regexp_extract(other, '^[^/?]*')) + 1), '[?].*$', '') FROM reach),
fit AS (SELECT host, path, rule_host || rule_path AS rule, rule_verdict AS verdict, row_number() OVER (PARTITION BY host, path
    ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, rule_verdict = 'block' DESC) AS place
  FROM place JOIN rules ON starts_with(path, rule_path) AND (host = rule_host OR suffix(host, '.' || rule_host))),
carried AS (SELECT node, min(verdict) AS carried FROM reach JOIN fit ON fit.place = 1 AND fit.host = regexp_extract(other, '^[^/?]*')
    AND fit.path = regexp_replace(substr(other, length(regexp_extract(other, '^[^/?]*')) + 1), '[?].*$', '') GROUP BY node)
SELECT page_id, s.host, s.path, rule, coalesce(verdict, carried, 'allow') AS verdict
FROM shown s LEFT JOIN fit ON fit.place = 1 AND fit.host = s.host AND fit.path = s.path LEFT JOIN carried c ON c.node = s.node"""

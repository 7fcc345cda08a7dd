"""URL filters whose block decisions reach all aliases of a URL.

A URL is judged by the longest rule that fits its host and path. Redirects and canonical links
make URLs aliases of each other: the connected components of these edges are found by joins and
aggregations. A URL that no rule names is blocked if one of its aliases is blocked by a rule, and
allowed otherwise; an explicit rule of its own, allow above all, always goes first.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.common import passing_tables, slices, written
from tillmart.llm.graph import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
BY_RULE, BY_ALIAS, BY_DEFAULT = "rule", "alias", "default"

# Columns `judge` adds to the pages.
ADDED = ["host", "path", "rule", "verdict", "decided_by"]

# A page without one of these words holds no canonical link and no redirect.
LINK_WORDS = "(?i)canonical|refresh"
_COMMENT = re.compile(r"<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", re.I | re.S)
_TAG = re.compile(r"<(link|meta)\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.I)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_REFRESH = re.compile(r"\s*[\d.]*\s*[;,]\s*url\s*=\s*[\"']?([^\"']*)", re.I | re.S)


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """From the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without it."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def url_key(url: Column) -> Column:
    """A URL as a node: scheme and host in lower case, without its fragment; null without host."""
    scheme = F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)
    after = F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(url_host(url) != "", F.concat(scheme, F.lit("://"), url_host(url), after))


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """verdict, host, path of rules given as (verdict, host, path)."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def checked_rules(rules: DataFrame) -> DataFrame:
    """One verdict for each host and path, hosts in lower case; allow goes before block.

    Rules with a null or with another verdict are left out.
    """
    known = rules.filter(F.col("verdict").isin(ALLOW, BLOCK) & F.col("path").isNotNull())
    host = F.translate("host", UPPER, LOWER)
    return (
        known.filter("host <> ''")
        .groupBy(host.alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.min("verdict").alias("rule_verdict"))
    )


def fitting_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, rule_verdict: the longest fitting rule of each different host and path.

    Hosts are probed by their suffixes and paths by prefixes of just the lengths that rules of
    such a suffix have, so both joins are on equal keys. Of rules of equal length the one of the
    longer host goes first. Places without a fitting rule have no row.
    """
    rules = checked_rules(rules)
    lengths = rules.groupBy("rule_host").agg(
        F.collect_set(F.length("rule_path")).alias("path_lengths")
    )
    labels = F.split("host", r"\.")
    first = F.sequence(F.lit(1), F.size(labels))
    suffixes = F.transform(first, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter("path_lengths", lambda n: n <= F.length("path"))
    probes = (
        places.select("host", "path")
        .filter("host <> ''")
        .distinct()
        .withColumn("rule_host", F.explode(suffixes))
        .join(lengths, "rule_host")
        .withColumn("path_length", F.explode(fits))
        .withColumn("rule_path", F.expr("left(path, path_length)"))
    )
    found = probes.join(rules, ["rule_host", "rule_path"])
    size = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host")
    )
    best = F.max_by(F.struct("rule_host", "rule_path", "rule_verdict"), size).alias("best")
    return found.groupBy("host", "path").agg(best).select(
        "host",
        "path",
        F.concat("best.rule_host", "best.rule_path").alias("rule"),
        F.col("best.rule_verdict").alias("rule_verdict"),
    )


def page_links(url: str, text: str) -> list[str]:
    """Where canonical links and refreshing redirects of a page lead, as absolute URLs."""
    found = []
    for tag, inner in _TAG.findall(_COMMENT.sub(" ", text)):
        named = {}
        for name, *values in _ATTRIBUTE.findall(inner):
            named.setdefault(name.lower(), html.unescape("".join(values)).strip())
        target = None
        if tag.lower() == "link" and "canonical" in named.get("rel", "").lower().split():
            target = named.get("href")
        elif tag.lower() == "meta" and named.get("http-equiv", "").lower() == "refresh":
            told = _REFRESH.match(named.get("content", ""))
            target = told.group(1).strip() if told else None
        if target:
            try:
                found.append(urljoin(url, target))
            except ValueError:  # no URL at all, such as an open bracket of an address
                continue
    return found


def _links_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 100):
        pairs = [
            (url, target)
            for url, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for target in page_links(url, text)
        ]
        if pairs:
            columns = [pa.array(column, pa.string()) for column in zip(*pairs)]
            yield pa.RecordBatch.from_arrays(columns, ["from_url", "to_url"])


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """from_url, to_url of the canonical links and redirects inside pages."""
    given = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return given.filter(F.col("url").isNotNull() & F.col("html").rlike(LINK_WORDS)).mapInArrow(
        _links_task, "from_url string, to_url string"
    )


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """The pages without html, with host, path, rule, verdict and decided_by.

    `pages` has url and html, `rules` verdict, host and path, `redirects` from_url and to_url.
    `decided_by` is `rule` where a rule fits the URL itself, `alias` where a block came from
    another URL of its component, `default` where neither says anything and the URL is allowed.
    Aliases need no page of their own: a link to a blocked URL is enough. A URL that is null or
    has no `://` has an empty host and path, no rule and no alias, and is allowed; null html has
    no links. Repeated rows are all returned; columns of pages named like added ones are
    replaced, others kept. An empty table gives no rows.
    """
    url = F.col("url")
    host, path = url_host(url), url_path(url)
    # Other columns of the pages go by names of their own meanwhile.
    kept = [c for c in pages.columns if c not in ["url", "html", *ADDED]]
    aside = [f"_given_{number}" for number in range(len(kept))]
    with passing_tables(pages.sparkSession):
        placed = pages.select(
            *[F.col(f"`{c}`").alias(name) for c, name in zip(kept, aside)],
            url,
            F.coalesce(host, F.lit("")).alias("host"),
            F.coalesce(path, F.lit("")).alias("path"),
        )
        edges = link_edges(pages)
        if redirects is not None:
            edges = edges.unionByName(redirects.select("from_url", "to_url"))
        blocked = _blocked_nodes(edges, rules)
        ruled = placed.join(fitting_rules(placed, rules), ["host", "path"], "left")
        judged = ruled.join(blocked, url_key(url) == F.col("blocked_node"), "left")
        by_alias = F.col("blocked_node").isNotNull()
        return judged.select(
            *[F.col(name).alias(c) for c, name in zip(kept, aside)],
            "url",
            "host",
            "path",
            "rule",
            F.coalesce(
                "rule_verdict", F.when(by_alias, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
            ).alias("verdict"),
            F.when(F.col("rule").isNotNull(), F.lit(BY_RULE))
            .when(by_alias, F.lit(BY_ALIAS))
            .otherwise(F.lit(BY_DEFAULT))
            .alias("decided_by"),
        )


def _blocked_nodes(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """blocked_node: the nodes of all components of which a rule blocks a node."""
    linked = edges.select(url_key(F.col("from_url")).alias("a"), url_key(F.col("to_url")).alias("b"))
    # Kept: the result that reads this table is not written here.
    members = written(components(linked.filter("a IS NOT NULL AND b IS NOT NULL")), "aliases", keep=True)
    node = F.col("node")
    placed = members.select(
        "component", url_host(node).alias("host"), url_path(node).alias("path")
    )
    ruled = placed.join(fitting_rules(placed, rules), ["host", "path"])
    bad = ruled.filter(F.col("rule_verdict") == BLOCK).select("component").distinct()
    return members.join(bad, "component", "left_semi").select(node.alias("blocked_node"))


# The rules of `op11_url_rules`: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

# The result of `op11_url_rules`; of the links it follows those that are absolute URLs.
SQL_TEXT = r"""
    WITH RECURSIVE given AS (
      SELECT page_id, url, html,
        CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    placed AS (
      SELECT page_id, url, html,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        regexp_replace(url, '#.*$', '') AS node
      FROM given),
    rules(verdict, rule_host, rule_path) AS (VALUES
      ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
      ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    links AS (
      SELECT node AS a, regexp_replace(regexp_extract(html,
        '<link rel="canonical" href="(https?://[^"#]*)', 1), '#.*$', '') AS b
      FROM placed WHERE html LIKE '%<link rel="canonical" href="http%'),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reached(a, b) AS (
      SELECT a, b FROM both_ways
      UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON r.b = e.a),
    alias_places AS (
      SELECT a, regexp_extract(b, '://([^/?]*)', 1) AS host,
        regexp_extract(b, '://[^/?]*([^?]*)', 1) AS path FROM reached),
    alias_rules AS (
      SELECT a, b_host, b_path, arg_max(verdict, length(rule_host) + length(rule_path)) AS verdict
      FROM (SELECT a, p.host AS b_host, p.path AS b_path, r.* FROM alias_places p JOIN rules r
            ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host))
            AND starts_with(p.path, rule_path))
      GROUP BY ALL),
    found AS (
      SELECT p.host, p.path, arg_max(rule_host || rule_path, length(rule_host) + length(rule_path)) AS rule,
        arg_max(verdict, length(rule_host) + length(rule_path)) AS verdict
      FROM (SELECT DISTINCT host, path FROM placed) p JOIN rules
        ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
      GROUP BY p.host, p.path),
    aliased AS (
      SELECT *, coalesce(node IN (SELECT a FROM alias_rules WHERE verdict = 'block'), false) AS hit
      FROM placed)
    SELECT page_id, a.host, a.path, f.rule,
      coalesce(f.verdict, CASE WHEN hit THEN 'block' ELSE 'allow' END) AS verdict,
      CASE WHEN f.rule IS NOT NULL THEN 'rule' WHEN hit THEN 'alias' ELSE 'default' END AS decided_by
    FROM aliased a LEFT JOIN found f ON a.host = f.host AND a.path = f.path"""

"""URL rules that follow redirects and canonical links.

A rule names a host and a path; it fits the host and its subdomains where the path of a
URL starts with the rule's. The longest rule that fits decides, an allowing one before a
blocking one of the same length. URLs without a rule take part in redirect equivalence:
pages and the targets of their canonical links and immediate redirects are nodes, links
are edges, and connected components are found in distributed rounds. If any URL of a
component is blocked by a rule, the URLs of it that no rule decides are blocked too. An
explicit rule, so also an explicit allow, always comes before what is propagated.

Edge cases: a null URL or one without ``://`` has an empty host and path, fits no rule, is
no alias and is allowed; relative links are resolved against their page; pages that share
a URL share its decision; null html has no links; an empty table gives an empty result;
other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.llm.common import ascii_lower, stored
from curate.llm.components import connected_components


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)

_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"""(?is)\brel\s*=\s*["']?canonical\b"""
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b"""
_TARGET = r"""(?is)\bcontent\s*=\s*["']?\s*\d+\s*;\s*url\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def decided(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the rule that decides, null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "allow", r.name))
    name = verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def node_of(url: Column) -> Column:
    """A URL as a node: scheme and host in lower case, without fragment and surrounding
    blanks; null where there is no host."""
    bare = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?]*)", 1)
    rest = F.substr(bare, F.length(head) + 1)
    return F.when(host_of(bare) != "", F.concat(ascii_lower(head), rest))


def resolved(link: Column, base: Column) -> Column:
    """An absolute URL for a link found on the page ``base``."""
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    folder = F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1)
    return (
        F.when(link.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(site, link))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(u, v) from the node of each page to its canonical and redirect targets."""
    tags = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_TAG), F.lit(0))
    tag = F.col("tag")
    link = F.when(tag.rlike(_CANONICAL), F.regexp_extract(tag, _HREF, 1)).when(
        tag.rlike(_REFRESH), F.regexp_extract(tag, _TARGET, 1)
    )
    found = (
        pages.select(F.col(url).alias("url"), F.explode(tags).alias("tag"))
        .select("url", link.alias("link"))
        .filter(F.col("link").isNotNull() & (F.col("link") != ""))
    )
    return (
        found.select(
            node_of(F.col("url")).alias("u"),
            node_of(resolved(F.replace("link", F.lit("&amp;"), F.lit("&")), F.col("url"))).alias("v"),
        )
        .dropna()
        .distinct()
    )


def blocked_nodes(edges: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(node) of every component in which a rule blocks a URL."""
    members = stored(connected_components(edges), "members")
    node = F.col("node")
    verdict = decided(host_of(node), path_of(node), rules)[1]
    bad = members.filter(verdict == "block").select("root").distinct()
    return members.join(bad, "root", "left_semi").select("node")


def judge_pages(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "page_id",
    url: str = "url", html: str = "html",
) -> DataFrame:
    """(key, host, path, rule, verdict), one row per page."""
    blocked = blocked_nodes(link_edges(pages, url, html), rules).withColumn("__hit", F.lit(True))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.select(
        key, host.alias("host"), path.alias("path"), node_of(F.col(url)).alias("__node")
    )
    name, verdict = decided(F.col("host"), F.col("path"), rules)
    rows = rows.select(key, "host", "path", name.alias("rule"), verdict.alias("own"), "__node")
    return rows.join(blocked, rows["__node"] == blocked["node"], "left").select(
        key, "host", "path", "rule",
        F.coalesce("own", F.when(F.col("__hit"), "block").otherwise("allow")).alias("verdict"),
    )


#: The same in SQL for DuckDB, with a recursive walk over the links. It reads absolute
#: canonical links whose rel comes first; redirects and relative links are left to tests.
ORACLE_SQL = r"""
with recursive p as (
  select row_number() over () as r, page_id, url, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), n as (
  select *, case when host <> '' then
      regexp_extract(url, '(?s)^(.*?://)', 1) || host
      || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) end as node,
    case
      when (host = 'example.net' or host like '%.example.net') and path like '/en/%'
        then 'example.net/en/'
      when (host = 'example.com' or host like '%.example.com') and path like '/de/%'
        then 'example.com/de/'
      when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
      when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule
  from p
), t as (
  select node, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*rel\s*=\s*["'']?canonical\b[^>]*>')) as tag
  from n where html is not null
), e as (
  select node as a, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>#]+)', 1) as b from t
), both_ways as (
  select a, b from e union select b, a from e
), bad(node) as (
  select node from n where rule in ('net/', 'example.com/de/')
  union
  select both_ways.b from bad join both_ways on both_ways.a = bad.node
)
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block'
    when rule is not null then 'allow'
    when node in (select node from bad where node is not null) then 'block'
    else 'allow' end as verdict
from n
"""

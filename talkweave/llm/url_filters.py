"""URL filters with redirect equivalence.

Rules of hosts and path prefixes decide the pages that they fit. Pages that redirect to one another or name one
another as canonical are aliases: connected components over these edges, found without collecting them, carry every
block decision to all aliases. An explicit allow rule takes precedence over a block carried from an alias; other
pages without a rule are allowed unless an alias is blocked. A link's target need not be among the pages: a rule that
blocks its address counts as well.

A list of at most ``IN_PLAN`` rules is part of the plan. A longer one, or a table of rules, is joined: by the suffixes of
a host and, for each, the prefixes of the path that have the length of some rule of that host. Both ways give the same rule.

Edges come from the pages' HTML (``link rel=canonical``, ``meta http-equiv=refresh``) and, if given, a table of
redirects. Comments and scripts hold no links; character references in attributes are decoded, ``rel`` may list several
words, and relative targets are resolved against the page's address or its ``base``, as a browser does; a ``>`` inside an
attribute ends the tag. An address is known by host, path (an empty one is ``/``) and query, without scheme and fragment.
Null urls and urls without ``://`` have empty host and path, fit no rule and have no aliases; null HTML has no links.
Repeated rows get equal results; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .common import staged
from .components import connected

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The longest list of rules that becomes part of the plan; others are joined.
IN_PLAN = 100

#: What holds no links: an open comment or script ends with the page.
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"
TAGS = r"(?is)<(?:link|meta|base)\b[^>]*>"
#: The content of a refresh: seconds, then an address, with or without its name.
REFRESH = re.compile(r"""\s*(?:[\d.]+[\s;,]+(?:url\s*=\s*)?|[\s;,]*url\s*=\s*)(?:"([^"]*)|'([^']*)|(.*))""", re.I | re.S)


@dataclass(frozen=True)
class Rule:
    pattern: str  # host, then a path that starts with a slash
    verdict: str  # allow or block

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


RULES = (Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"), Rule("com/fr/", "allow"), Rule("com/de/", "block"))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """Host, path (``/`` for an empty one) and query; null for what is no url."""
    query = F.regexp_extract(_rest(url), "^[^?#]*(\\?[^#]*)", 1)
    return F.when(_rest(url).isNotNull(), F.concat(host_of(url), F.coalesce(F.nullif(path_of(url), F.lit("")), F.lit("/")), query))


def matched(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (of equally long ones an allowing one, then the first by name), as a struct; or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (-len(r.pattern), r.verdict, r.pattern), reverse=True):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.pattern).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _suffixes(host: Column, longest: int) -> Column:
    """A host and what follows each of its dots, as far as it has at most ``longest`` characters."""
    tail = F.when(F.length(host) > longest + 1, F.right(host, F.lit(longest + 1))).otherwise(host)
    labels = F.split(tail, "\\.")
    after = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    whole = F.length(host) <= longest
    return F.when(whole, after).otherwise(F.slice(after, 2, F.size(labels)))


def joined(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` (``host``, ``path``) with ``m``, as ``matched`` gives it, from a table of rules (``pattern``, ``verdict``) of any length."""
    host = F.substring_index("pattern", "/", 1)
    table = rules.filter("pattern is not null").groupBy("pattern").agg(F.min("verdict").alias("verdict")).select(host.alias("at"), F.substring(F.col("pattern"), F.length(host) + 1, F.length("pattern")).alias("prefix"), "pattern", "verdict")
    table = staged(table, "rules", 8)
    longest = table.agg(F.max(F.length("at"))).first()[0] or 0
    lengths = staged(table.groupBy("at").agg(F.collect_set(F.length("prefix")).alias("lengths")), "rule-lengths", 8)
    spots = rows.select("host", "path").distinct().withColumn("at", F.explode(_suffixes(F.col("host"), longest))).join(lengths, "at")
    spots = spots.withColumn("n", F.explode(F.filter("lengths", lambda n: n <= F.length("path")))).withColumn("prefix", F.substring(F.col("path"), F.lit(1), F.col("n")))
    order = F.struct((-F.length("pattern")).alias("size"), "verdict", "pattern")
    best = staged(spots.join(table, ["at", "prefix"]).groupBy("host", "path").agg(F.min(order).alias("b")), "best-rules", 8)
    found = best.select("host", "path", F.struct(F.col("b.pattern").alias("rule"), F.col("b.verdict").alias("verdict")).alias("m"))
    return rows.join(found, ["host", "path"], "left")


def _with_rule(rows: DataFrame, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    if not isinstance(rules, DataFrame) and len(rules) <= IN_PLAN:
        return rows.withColumn("m", matched(F.col("host"), F.col("path"), rules))
    if not isinstance(rules, DataFrame):
        rules = rows.sparkSession.createDataFrame([(r.pattern, r.verdict) for r in rules], "pattern string, verdict string")
    return joined(rows, rules)


class _Tag(HTMLParser):
    """The name and attributes of one tag."""

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.name, self.found = tag, {k: v or "" for k, v in reversed(attrs)}  # of an attribute named twice the first counts


def targets(url: str, tags: list[str]) -> list[str]:
    """The addresses that a page's tags redirect to or name as canonical; ``url`` is what follows the page's ``://``."""
    base, found = "http://" + url, []
    for t in tags:
        one = _Tag()
        one.name, one.found = "", {}
        one.feed(t)
        a = one.found
        if one.name == "base" and "href" in a and base == "http://" + url:
            base = absolute(base, a["href"]) or base
        elif one.name == "link" and "canonical" in a.get("rel", "").lower().split():
            found.append(a.get("href", ""))
        elif one.name == "meta" and a.get("http-equiv", "").strip().lower() == "refresh" and (m := REFRESH.match(a.get("content", ""))):
            found.append(next(g for g in (*m.groups(), "") if g is not None))
    return list(dict.fromkeys(x for t in found if (x := absolute(base, t))))


def absolute(base: str, target: str) -> str | None:
    """A link's address; null for an empty link, for one that is no address, and for what can't be resolved."""
    target = target.strip()
    try:
        out = target if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", target) else urljoin(base, target)
    except ValueError:  # brackets that are no address
        return None
    return out if target and "://" in out else None


@F.arrow_udf(ArrayType(StringType()))
def _targets(urls: pa.Array, tags: pa.Array) -> pa.Array:
    return pa.array([None if u is None or not t else targets(u, t) for u, t in zip(urls.to_pylist(), tags.to_pylist(), strict=True)], pa.list_(pa.string()))


def links(pages: DataFrame) -> DataFrame:
    """Of ``pages`` with a link: ``u``, the page's address, and ``to``, a target. Only tags that may name one leave the JVM."""
    url, html = F.col("url").cast("string"), F.col("html").cast("string")
    named = pages.filter(F.rlike(html, F.lit("(?i)canonical|refresh")))
    tags = F.regexp_extract_all(F.regexp_replace(html, UNSEEN, " "), F.lit(TAGS), F.lit(0))
    cut = named.select(address(url).alias("u"), F.regexp_extract(_rest(url), "^[^#]*", 0).alias("rest"), F.filter(tags, lambda t: F.rlike(t, F.lit("(?i)canonical|refresh|^<base"))).alias("tags"))
    return cut.filter((F.size("tags") > 0) & F.col("u").isNotNull()).select("u", F.explode(_targets("rest", "tags")).alias("to"))


def judged(pages: DataFrame, rules: Sequence[Rule] | DataFrame = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``component`` (null without an alias).

    ``rules`` may be a table with the columns ``pattern`` and ``verdict``; ``redirects`` has the columns ``from_url`` and ``to_url``.
    """
    url = F.col("url")
    own = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), address(url).alias("node"))
    rows = staged(_with_rule(own, rules), "page-rules")
    pairs = links(pages)
    if redirects is not None:
        pairs = pairs.unionByName(redirects.select(address(F.col("from_url")).alias("u"), F.col("to_url").alias("to")))
    to = F.col("to")
    pairs = pairs.select("u", address(to).alias("v"), host_of(to).alias("host"), path_of(to).alias("path")).filter("u is not null and v is not null").distinct()
    pairs = staged(_with_rule(pairs, rules).select("u", "v", F.col("m.verdict").alias("verdict")), "page-links")
    aliases = staged(connected(pairs.select("u", "v")), "aliases", 8)
    blocked = rows.filter("m.verdict = 'block'").select("node").unionByName(pairs.filter("verdict = 'block'").select(F.col("v").alias("node"))).distinct()
    bad = aliases.join(blocked, "node", "left_semi").select("component").distinct().withColumn("bad", F.lit(True))
    carried = aliases.join(bad, "component", "left").select("node", "component", "bad")
    verdict = F.coalesce("m.verdict", F.when(F.col("bad"), F.lit("block")), F.lit("allow"))
    return rows.join(carried, "node", "left").select("page_id", "host", "path", F.col("m.rule").alias("rule"), verdict.alias("verdict"), "component")

"""URL rules whose decisions spread over redirects and canonical links, in column expressions only."""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import stored
from hoarfrost.llm.components import components

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class UrlRule:
    """A decision on a host with all its subdomains, for paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# ---- addresses ----


def host_of(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, with A-Z lower-cased; else empty."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _without_dots(path: Column) -> Column:
    """A path with its `.` and `..` segments carried out."""
    last = F.element_at(F.split(path, "/"), -1)
    kept = F.filter(F.split(path, "/"), lambda s: s != ".")
    walked = F.aggregate(
        kept,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s != "..", F.concat(done, F.array(s)))
        .when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1))
        .otherwise(done),
    )
    clean = F.concat(F.array_join(walked, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))
    return F.when(path.contains("/."), F.when(clean.startswith("/"), clean).otherwise(F.concat(F.lit("/"), clean))).otherwise(path)


def node_of(url: Column) -> Column:
    """The key of the resource that an address names: a digest of host, path and query.

    The scheme and the fragment do not count, an empty path is `/`, and dot segments are carried out.
    Null for null and for addresses without `://`.
    """
    path = _without_dots(F.when(path_of(url) == "", "/").otherwise(path_of(url)))
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.unhex(F.md5(F.concat(host_of(url), path, query).cast("binary"))))


def resolved(base: Column, link: Column) -> Column:
    """A link as an absolute address, seen from the page at `base`; null if it names no other page."""
    link = F.regexp_replace(link, r"^[\s\x00]+|[\s\x00]+$", "")
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(F.concat(path_of(base), F.lit("")), r"(?s)^(.*/)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(~base.contains("://") | (link == "") | link.startswith("#"), F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None).cast("string"))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(origin, path_of(base), link))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), link))
    )


# ---- rules ----


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits, as a struct of its name and verdict; null if none does.

    Of rules that are equally long the one with the longer host counts, then one that allows. Every rule
    becomes a branch of one expression, so this is for lists of up to a few hundred rules.
    """
    order = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != ALLOW))
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in order
    ]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fits, none)


# ---- links ----


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute, its commonest character references decoded."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)))
    for reference, char in (("&quot;|&#34;|&#x22;", '"'), ("&#39;|&#x27;|&apos;", "'"), ("&#47;|&#x2f;", "/"), ("&amp;|&#38;|&#x26;", "&")):
        value = F.regexp_replace(value, f"(?i){reference}", char)
    return value


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Redirect and canonical-link edges that pages declare themselves: source and target addresses.

    Read are `<link rel="canonical" href>` and `<meta http-equiv="refresh" content="0; url=...">` outside
    of comments, scripts and styles. A page with none of these words is only searched for them.
    """
    said = pages.where(F.col(html).rlike("(?i)canonical|refresh")).select(F.col(url).alias("source"), F.col(html).alias("html"))
    bare = F.regexp_replace("html", r"(?is)<!--.*?-->|<(script|style|textarea|title)\b.*?</\1\s*>", " ")
    tags = said.select("source", F.explode(F.regexp_extract_all(bare, F.lit(r"(?i)(<(?:link|meta)[\s/][^>]*>)"), 1)).alias("tag"))
    canonical = F.col("tag").rlike("(?i)^<link") & F.regexp_replace(F.lower(_attribute(F.col("tag"), "rel")), r"\s+", " ").rlike(r"(^| )canonical( |$)")
    refresh = F.col("tag").rlike("(?i)^<meta") & (F.lower(F.trim(_attribute(F.col("tag"), "http-equiv"))) == "refresh")
    goal = r"""(?is)^\s*[\d.]+\s*[;,\s]\s*(?:url\s*=\s*)?["']?([^"']+)"""
    link = F.when(canonical, _attribute(F.col("tag"), "href")).when(refresh, F.regexp_extract(_attribute(F.col("tag"), "content"), goal, 1))
    found = tags.select("source", link.alias("link")).where("link <> ''")
    return found.select("source", resolved(F.col("source"), F.col("link")).alias("target")).where("target IS NOT NULL")


def blocked_nodes(links: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """Resources that a block decision reaches over links (source, target): column node.

    Links hold both ways: all addresses of a connected component name the same content. A component in
    which a rule blocks an address is blocked, unless a rule allows another of its addresses: an
    explicit allow takes precedence. Addresses that no page was fetched from count too.
    """
    ends = []
    for side in ("source", "target"):
        verdict = rule_of(host_of(F.col(side)), path_of(F.col(side)), rules)["verdict"]
        ends.append(F.struct(node_of(F.col(side)).alias("node"), verdict.alias("verdict")))
    edges = stored(links.select(ends[0].alias("a"), ends[1].alias("b")).where("a.node IS NOT NULL AND b.node IS NOT NULL"), "alias-links")
    roots = stored(components(edges.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))), "alias-roots")
    said = edges.select(F.inline(F.array("a", "b"))).where("verdict IS NOT NULL").distinct()
    judged = said.withColumnRenamed("node", "of").join(roots, F.col("of") == F.col("node")).groupBy("root")
    blocked = judged.agg(F.max(F.col("verdict") == ALLOW).alias("allowed"), F.max(F.col("verdict") == BLOCK).alias("blocked"))
    blocked = blocked.where("blocked AND NOT allowed").select(F.col("root").alias("bad"))
    return roots.join(blocked, F.col("root") == F.col("bad"), "left_semi").select("node")


def judge_urls(
    pages: DataFrame, rules: Sequence[UrlRule], key: str = "page_id", url: str = "url", html: str | None = "html", redirects: DataFrame | None = None
) -> DataFrame:
    """Every page with the decision on its address: key, host, path, rule, verdict and how (`rule`,
    `alias` or `default`).

    The longest rule that fits an address decides. An address that no rule fits is blocked if it is
    connected with a blocked one over redirects and canonical links, unless a rule allows an address of
    the same component; all others are allowed. Edges come from the pages themselves (`html`, if named)
    and from `redirects`, a table with the columns source and target.

    A null address, or one without `://`, has empty host and path, fits no rule and has no aliases. Pages
    with one address are judged alike, each in a row of its own; keys may be null or repeat. Empty tables
    give no rows, and other columns are not looked at.
    """
    links = None if html is None else page_links(pages.select(F.col(url).alias("url"), F.col(html).alias("html")))
    if redirects is not None:
        told = redirects.select("source", resolved(F.col("source"), F.col("target")).alias("target")).where("target IS NOT NULL")
        links = told if links is None else links.unionByName(told)
    plain = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"))
    plain = plain.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    plain = plain.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    out = [F.col("_key").alias(key), "host", "path"]
    ruled = plain.where("_rule IS NOT NULL").select(*out, "_rule.rule", "_rule.verdict", F.lit("rule").alias("how"))
    rest = plain.where("_rule IS NULL").withColumn("_node", node_of(F.col("_url")))
    none = F.lit(None).cast("string").alias("rule")
    if links is None:
        return ruled.unionByName(rest.select(*out, none, F.lit(ALLOW).alias("verdict"), F.lit("default").alias("how")))
    # Only the reached resources are joined, so most pages meet a table that is small or empty.
    reached = blocked_nodes(links, rules).select(F.col("node").alias("_bad"))
    rest = rest.join(reached, F.col("_node") == F.col("_bad"), "left")
    bad = F.col("_bad").isNotNull()
    verdict, how = F.when(bad, BLOCK).otherwise(ALLOW), F.when(bad, "alias").otherwise("default")
    return ruled.unionByName(rest.select(*out, none, verdict.alias("verdict"), how.alias("how")))

"""URL filters by host and path rules, with redirect equivalence (native: DataFrame and SQL functions only).

A url is judged by the longest rule that fits it. Urls that no rule fits take the decision of their aliases: redirect
(meta refresh) and canonical-link edges, found in each page's html or handed in, are joined into connected components;
a block decision of any member goes to the members without a rule, unless some member has an explicit allow, which
takes precedence. With no decision in the component the verdict is `allow`. A rule's own verdict is never overturned.

Edge cases: null urls and urls without `://` have empty host and path, no rule, no aliases, verdict `allow`; null html
has no links; repeated pages are judged row by row; an empty table gives no rows; further columns of the input are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import connected_components

#: Fixed rules of the contract: (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null. One CASE, longest rule first: the list is the caller's
    literal, so its size is fixed; a large block list goes to `rule_join`."""
    chain = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0], r[1])):
        on, slash, below = rule.partition("/")
        fits = ((host == on) | F.endswith(host, F.lit("." + on))) & F.startswith(path, F.lit(slash + below))
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return chain if chain is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def rule_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`urls` (key, host, path) with the longest fitting row of `rules` (verdict, rule), for lists too long for a CASE.

    Each host is expanded into its suffixes, which meet the rules' hosts in an equi-join; fitting rules are reduced by
    a partial aggregate, so neither side is collected or crossed. Returns key, rule, verdict; urls without a rule are left out.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    r = rules.select(F.regexp_extract("rule", r"^[^/]*", 0).alias("suffix"), F.regexp_extract("rule", r"^[^/]*(.*)$", 1).alias("below"), "rule", "verdict")
    best = F.max(F.struct(F.length("rule").alias("n"), F.when(F.col("verdict") == "allow", 1).otherwise(0).alias("a"), F.col("rule"), F.col("verdict")))
    return (
        urls.select("key", "path", F.explode(suffixes).alias("suffix"))
        .join(r, "suffix")
        .where(F.startswith("path", F.col("below")))
        .groupBy("key")
        .agg(best.alias("best"))
        .select("key", "best.rule", "best.verdict")
    )


def identity_of(url: Column) -> Column:
    """A url as a node of the alias graph: scheme and host lower-cased, fragment dropped; null without `://`."""
    scheme = F.translate(F.regexp_extract(url, r"^([^:/?#]*)://", 1), UPPER, LOWER)
    after = F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(F.locate("://", url) > 0, F.concat(scheme, F.lit("://"), host_of(url), after))


def resolve(url: Column, href: Column) -> Column:
    """`href` as an absolute url, seen from `url`; dot segments are kept as they are."""
    scheme = F.regexp_extract(url, r"^([^:/?#]*)://", 1)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(_rest(url), r"^[^/?#]*", 0))
    folder = F.regexp_extract(path_of(url), r"^(.*/)?", 0)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), href)
        .when((href == "") | F.startswith(href, F.lit("#")), None)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(site, href))
        .when(F.startswith(href, F.lit("?")), F.concat(site, path_of(url), href))
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), href))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): the identities that canonical links and meta refreshes in `pages` (url, html) tie together."""
    tag = F.col("tag")
    canonical = tag.rlike(r"(?i)^<link\b") & tag.rlike(r"""(?i)\brel\s*=\s*["']?[^"'>]*\bcanonical\b""")
    refresh = tag.rlike(r"(?i)^<meta\b") & tag.rlike(r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b""")
    href = F.when(canonical, F.regexp_extract(tag, r"""(?i)\bhref\s*=\s*["']?([^"'\s>]*)""", 1)).when(
        refresh, F.regexp_extract(tag, r"""(?i)\burl\s*=\s*["']?([^"'\s>]*)""", 1)
    )
    return (
        pages.where("url IS NOT NULL AND html IS NOT NULL")
        .where(F.col("html").rlike(r"(?i)canonical|refresh"))
        .select("url", F.explode(F.regexp_extract_all("html", F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), 0)).alias("tag"))
        .select("url", F.trim(href).alias("href"))
        .where("href IS NOT NULL")
        .select("url", resolve(F.col("url"), F.col("href")).alias("target"))
        .where("target IS NOT NULL")
        .select(identity_of(F.col("url")).alias("a"), identity_of(F.col("target")).alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    )


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, extra_edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of `pages` (page_id, url, html). `extra_edges`: urls (a, b) known to redirect."""
    edges = alias_edges(pages)
    if extra_edges is not None:
        edges = edges.union(extra_edges.select(identity_of(F.col("a")).alias("a"), identity_of(F.col("b")).alias("b")))
    nodes = connected_components(edges)
    own = rule_of(F.col("host"), F.col("path"), rules)["verdict"]
    decided = (
        nodes.select("component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
        .select("component", own.alias("own"))
        .groupBy("component")
        .agg(F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
        .where("blocked AND NOT coalesce(allowed, false)")
    )
    blocked = nodes.join(decided.select("component"), "component", "left_semi").select(F.col("node").alias("alias"))
    judged = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "alias": identity_of(F.col("url"))})
    judged = judged.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    return judged.join(blocked.withColumn("hit", F.lit(True)), "alias", "left").select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), F.when(F.col("hit"), F.lit("block")), F.lit("allow")).alias("verdict"),
    )

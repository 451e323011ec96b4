"""Url rules whose blocks follow redirects.

A rule is a host and a path. It fits urls on its host and all subdomains whose path begins with the rule's; the longest
fitting rule (host and path together) judges the url. Redirects (given links, and refreshes named in a page) and canonical
links join urls into classes, by connected components over the link table. A url without a rule takes the verdict of its
class: an explicit allow of any member comes first, then a block of any member; without either it is allowed. A rule on
the url itself always wins. Members that are only link targets count too. A url's fragment names no other page and is left
out of links.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and no links, so it is allowed;
null pages give no links; repeated rows give repeated results; an empty table gives an empty table. Only the columns
named in the result are returned, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct of the longest fitting rule's name and verdict, or null."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def node_of(url: Column) -> Column:
    """The url without its fragment, or null if it has no ``://``."""
    return F.when(url.contains("://"), F.regexp_extract(url, r"(?s)\A([^#]*)", 1))


def _absolute(link: Column, base: Column) -> Column:
    """``link`` as a browser on the page ``base`` would resolve it, without dot segments."""
    scheme = F.regexp_extract(base, r"(?s)\A(.*?:)//", 1)
    root = F.regexp_extract(base, r"(?s)\A(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(path_of(base), r"(?s)\A(.*/)", 1)
    return (
        F.when(link.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path_of(base), link))
        .when(link != "", F.concat(root, F.when(folder == "", "/").otherwise(folder), link))
    )


#: Tags that name another address of a page, and the address in them.
LINK_TAGS = r"(?is)<link\b[^>]*?\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH_TAGS = r"(?is)<meta\b[^>]*?\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'>\s]+)"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'>\s]+)"


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``a, b``: every page's url with the target of each canonical link and refresh in its markup."""
    marked = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).filter(
        F.col("url").contains("://") & F.col("html").rlike(r"(?i)canonical|http-equiv")
    )
    named = F.concat(
        F.transform(F.regexp_extract_all("html", F.lit(LINK_TAGS), F.lit(0)), lambda t: F.regexp_extract(t, HREF, 1)),
        F.transform(
            F.regexp_extract_all("html", F.lit(REFRESH_TAGS), F.lit(0)), lambda t: F.regexp_extract(t, REFRESH_URL, 1)
        ),
    )
    links = marked.select("url", F.explode(named).alias("link"))
    target = _absolute(F.replace(F.col("link"), F.lit("&amp;"), F.lit("&")), F.col("url"))
    return links.select(node_of(F.col("url")).alias("a"), node_of(target).alias("b")).filter("b IS NOT NULL")


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    redirects: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` of every page. ``redirects`` has urls in its first two columns."""
    links = page_links(pages, url, html)
    if redirects is not None:
        a, b = redirects.columns[:2]
        links = links.union(
            redirects.select(node_of(redirects[a]).alias("a"), node_of(redirects[b]).alias("b")).dropna()
        )
    member = components(links)
    judged = member.withColumn("verdict", _rule(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"])
    classes = judged.groupBy("component").agg(
        F.when(F.max(F.col("verdict") == "allow"), "allow").when(F.max(F.col("verdict") == "block"), "block").alias("taken")
    )
    alias = member.join(classes.filter("taken IS NOT NULL"), "component").select("node", "taken")
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    own = own.select("*", _rule(F.col("host"), F.col("path"), rules).alias("fit"), node_of(F.col("url")).alias("key"))
    return own.join(alias, own["key"] == alias["node"], "left").select(
        "page_id",
        "url",
        "host",
        "path",
        F.col("fit.name").alias("rule"),
        F.coalesce("fit.verdict", "taken", F.lit("allow")).alias("verdict"),
    )

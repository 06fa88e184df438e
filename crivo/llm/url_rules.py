"""URL filter: allow and block rules, and blocks that follow redirects.

A page a rule names gets that rule's verdict. Pages that redirect to each other
or name each other as canonical are aliases: connected components over these
edges. An alias without a rule is blocked when a rule blocks a page of its
component and none allows one; otherwise it is allowed. An explicit rule of the
page itself always stands.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.llm.common import connected_components
from crivo.sources.tables import staged

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """Up to the first of ``/?#``, lower case; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(found, F.lit("")))


def url_path(url: Column) -> Column:
    """From the host's end up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct of rule and verdict; null if none."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [
        (
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in ordered
    ]
    if not fits:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return reduce(lambda case, x: case.when(*x), fits[1:], F.when(*fits[0]))


def page_key(url: Column) -> Column:
    """What names a page: scheme-free, without the fragment, host in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(url_host(url), rest))


# Attributes come in any order, with either quote or none.
_LINK = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = (
    r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)"
    r"[^>]*\bcontent\s*=\s*[\"']?[^\"'>]*?url\s*=\s*[\"']?([^\"'\s>]+)"
)


def without_dots(path: Column) -> Column:
    """An absolute path with its ``.`` and ``..`` segments worked off."""
    segments = F.split(path, "/")

    def add(done: Column, x: Column) -> Column:
        return (
            F.when(x == ".", done)
            .when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.concat(done, F.array(x)))
        )

    inner = F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0)))
    done = F.aggregate(inner, F.array().cast("array<string>"), add)
    # A path that ends with dots names a folder.
    folder = F.element_at(segments, -1).isin(".", "..") & (F.size(done) > 0)
    cleaned = F.concat(F.lit("/"), F.array_join(done, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), cleaned).otherwise(path)


def page_links(url: Column, html: Column) -> Column:
    """Absolute targets of canonical links and refresh redirects of a page.

    ``//host/x`` takes any scheme, ``/x`` the page's host, ``?x`` the page's
    path and ``#x`` the page itself; other relative targets go on from the
    page's folder. Targets of other schemes (``mailto:x``) are left out, as are
    relative ones of a page without ``://``.
    """
    found = F.concat(
        F.regexp_extract_all(html, F.lit(_LINK), 1), F.regexp_extract_all(html, F.lit(_REFRESH), 1)
    )
    site, own = F.concat(F.lit("http://"), url_host(url)), url_path(url)
    in_folder = F.concat(F.lit("/"), F.regexp_extract(own, r"(?s)^/(.*/)", 1))
    based = F.instr(url, "://") > 0

    def absolute(target: Column) -> Column:
        path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
        rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
        return (
            F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(~based, F.lit(None))
            .when(target.startswith("/"), F.concat(site, without_dots(path), rest))
            .when(target.startswith("#"), url)
            .when(target.startswith("?"), F.concat(site, own, target))
            .otherwise(F.concat(site, without_dots(F.concat(in_folder, path)), rest))
        )

    # Most pages hold neither: a plain search is far cheaper than the patterns.
    likely = F.lower(html)
    return F.when(
        likely.contains("canonical") | likely.contains("refresh"),
        F.filter(F.transform(found, absolute), lambda x: x.isNotNull()),
    )


def judged_pages(
    pages: DataFrame,
    rules: Sequence[Rule],
    page_id: str = "page_id",
    url: str = "url",
    html: str | None = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, alias_of) for each row of ``pages``.

    ``redirects`` may add edges (source, target) of URLs, for instance from a
    crawl log. ``alias_of`` is the smallest page key of the component, null for
    a page without edges. A null URL or one without ``://`` has an empty host
    and path, fits no rule, has no aliases and is allowed. Repeated rows are
    judged alike. A target nobody crawled is a member of its component too: if
    a rule fits its URL, the rule counts.
    """
    u = F.col(url)
    judged = pages.select(
        F.col(page_id).alias("page_id"),
        page_key(u).alias("key"),
        url_host(u).alias("host"),
        url_path(u).alias("path"),
    ).withColumn("own", matching_rule(F.col("host"), F.col("path"), rules))

    edges = [] if redirects is None else [redirects.select("source", "target")]
    if html is not None:
        edges.append(
            pages.select(u.alias("source"), F.explode(page_links(u, F.col(html))).alias("target"))
        )
    if not edges:
        aliases = judged.select("key", F.lit(None).cast("string").alias("alias_of")).limit(0)
        spread = aliases.select("alias_of", F.lit(False).alias("blocks")).limit(0)
    else:
        links = reduce(DataFrame.unionByName, edges)
        links = links.select(page_key(F.col("source")).alias("a"), page_key(F.col("target")).alias("b"))
        aliases = staged(
            connected_components(links, "a", "b").withColumnsRenamed(
                {"node": "key", "component": "alias_of"}
            ),
            "aliases",
        )
        # A key starts with its host and has its path up to the query.
        where = F.concat(F.lit("x://"), F.col("key"))
        verdict = matching_rule(url_host(where), url_path(where), rules)["verdict"]
        spread = (
            aliases.select("alias_of", verdict.alias("verdict"))
            .groupBy("alias_of")
            .agg(
                (
                    F.coalesce(F.bool_or(F.col("verdict") == BLOCK), F.lit(False))
                    & ~F.coalesce(F.bool_or(F.col("verdict") == ALLOW), F.lit(False))
                ).alias("blocks")
            )
        )
    # One row for each alias, joined with pages by key: both sides may be split.
    decided = aliases.join(spread, "alias_of")
    return judged.join(staged(decided, "decided"), "key", "left").select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce(
            F.col("own.verdict"),
            F.when(F.coalesce(F.col("blocks"), F.lit(False)), F.lit(BLOCK)).otherwise(F.lit(ALLOW)),
        ).alias("verdict"),
        "alias_of",
    )

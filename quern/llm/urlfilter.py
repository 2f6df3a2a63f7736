"""URL filters that hold for all aliases of a page.

A rule decides for its host and subdomains under a path.  URLs that redirect to each other,
or name each other as canonical, are one page under several names: connected components over
those edges carry a block to the aliases that no rule decides.  An allow rule always
holds for its own URL, and in a component it goes before blocks.

Everything here is DataFrame functions; no Python sees a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: More rules than this are joined instead of compiled into an expression.
COMPILED = 200


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or for null."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    name, slash, rest = rule.partition("/")
    return name, slash + rest


def _compiled(rules: list[tuple[str, str]], h: Column, p: Column) -> Column:
    """The longest fitting rule as struct<rule,verdict>, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # a longer one goes around a shorter one
        name, start = split_rule(rule)
        fits = ((h == name) | h.endswith("." + name)) & p.startswith(start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def with_rules(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """pages (with host and path) and, of each row, rule and rule_verdict of the longest fitting rule, or nulls.

    rules: (allow or block, host and path).  Long lists are joined on the host's suffixes;
    the rows are told apart by a hash of host and path, on which the rule alone depends.
    """
    if len(rules) <= COMPILED:
        return pages.withColumn("_r", _compiled(rules, F.col("host"), F.col("path"))).withColumns({"rule": F.col("_r.rule"), "rule_verdict": F.col("_r.verdict")}).drop("_r")
    spark = pages.sparkSession
    listed = spark.createDataFrame([(*split_rule(r), r, v) for v, r in rules], "name string,start string,rule string,verdict string")
    places = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = places.select("host", "path", F.explode(suffixes).alias("name")).join(listed, "name").where(F.col("path").startswith(F.col("start")))
    best = met.groupBy("host", "path").agg(F.max(F.struct(F.length("rule"), "rule", "verdict")).alias("best"))
    return pages.join(best, ["host", "path"], "left").withColumns({"rule": F.col("best.rule"), "rule_verdict": F.col("best.verdict")}).drop("best")


def canonical_form(url: Column) -> Column:
    """The form to which a site's usual redirects lead, without scheme, ``www.`` or ``m.`` before a name of two labels or more, default port, final slash, ``.html``, tracking parameters and fragment; null without a host."""
    name = F.regexp_replace(F.regexp_replace(host(url), r"^(?:www|m)\.([^.]+\.[^.])", "$1"), r":(?:80|443)$", "")
    place = F.regexp_replace(path(url), r"(?:/index)?(?:\.html?)?/*$", "")
    query = F.regexp_extract(F.regexp_extract(_rest(url), r"^[^#]*", 0), r"\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda q: ~q.rlike(r"^(?:utm_\w+|ref|fbclid|gclid)(?:=|$)") & (q != "")), "&")
    return F.concat(F.nullif(name, F.lit("")), place, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def resolved(url: Column, link: Column) -> Column:
    """The whole URL that link names on the page at url; null for other schemes than those with ``://``, and on a page without a host."""
    scheme = F.regexp_extract(url, r"^(.*?)://", 1)
    site = F.when(host(url) != "", F.concat(scheme, F.lit("://"), host(url)))
    folder = F.regexp_extract(path(url), r"^.*/", 0)
    rooted = F.when(link.startswith("/"), link).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), link))
    place, rest = F.regexp_extract(rooted, r"^[^?#]*", 0), F.regexp_extract(rooted, r"^[^?#]*(.*)$", 1)

    def step(held: Column, part: Column) -> Column:
        return F.when(part == "..", F.slice(held, F.lit(1), F.greatest(F.size(held) - 1, F.lit(0)))).when(part == ".", held).otherwise(F.array_append(held, part))

    parts = F.split(F.regexp_replace(place, "^/", ""), "/")
    walked = F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))
    return (
        F.when(link.contains("://"), link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link)).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("?"), F.concat(site, path(url), link)).when(link.startswith("#"), url).otherwise(F.concat(site, walked, rest))
    )


def _targets(url: Column, html: Column) -> Column:
    """URLs to which the page's canonical link and its refreshing meta tags point."""
    tags = F.concat(
        F.when(html.rlike("(?i)canonical"), F.regexp_extract_all(html, F.lit(r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), F.lit(0))).otherwise(F.array().cast("array<string>")),
        F.when(html.rlike("(?i)http-equiv"), F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0))).otherwise(F.array().cast("array<string>")),
    )
    found = F.transform(tags, lambda t: F.regexp_replace(F.regexp_extract(t, r"(?i)(?:\bhref\s*=\s*[\"']?|;\s*url\s*=\s*[\"']?)([^\"'\s>]+)", 1), "&(?:amp|#38|#x26);", "&"))
    return F.filter(F.transform(F.filter(F.array_distinct(found), lambda t: t != ""), lambda t: resolved(url, t)), lambda t: t.isNotNull())


def _node(kind: str, text: Column) -> Column:
    """Of a URL (kind u) or a canonical form (kind c): 128 bits, which stand for the text in the graph."""
    return F.unhex(F.md5(F.concat(F.lit(kind + " "), text)))


def judge(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None, id_column: str = "page_id", url: str = "url", html: str | None = "html") -> DataFrame:
    """(id, host, path, rule, verdict) of every row.

    Edges run from each URL to its canonical form, from each page to what its canonical link
    and refreshing meta tags name, and along ``redirects`` (source, target), if given.
    Without a rule, a page is blocked if its component has a blocked URL and no allowed one;
    else allowed.  Null URLs have empty host and path and no aliases.  Links of a page are
    resolved against its URL.  Repeated rows stay; other columns are left out; no pages, no rows.
    """
    u = F.col("url")
    rows = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url"), (F.col(html) if html else F.lit(None).cast("string")).alias("html"))
    bare = F.regexp_extract(u, r"^[^#]*", 0)
    placed = with_rules(rows.withColumns({"host": host(u), "path": path(u)}), rules)
    read, _ = materialise(
        placed.select("id", "host", "path", "rule", "rule_verdict", _node("u", bare).alias("node"), _node("c", canonical_form(u)).alias("form"), F.transform(_targets(u, F.col("html")), lambda t: _node("c", canonical_form(t))).alias("targets")),
        "judged",
    )
    edges = read.select(F.col("node").alias("a"), F.explode(F.array_append("targets", F.col("form"))).alias("b"))
    if redirects is not None:
        both = [F.col(c) for c in redirects.columns[:2]]
        edges = edges.unionByName(redirects.select(*(_node("c", canonical_form(c)).alias(n) for c, n in zip(both, "ab", strict=True))))
    labels = connected_components(edges)
    ruled = read.where("rule_verdict is not null").groupBy("node").agg(F.bool_or(F.col("rule_verdict") == "block").alias("block"), F.bool_or(F.col("rule_verdict") == "allow").alias("allow"))
    decided = labels.join(ruled, "node").groupBy("component").agg(F.bool_or("block").alias("block"), F.bool_or("allow").alias("allow"))
    blocked, _ = materialise(labels.join(decided.where("block and not allow").select("component"), "component").select("node", F.lit(True).alias("blocked")), "blocked")
    out = read.select("id", "host", "path", "rule", "rule_verdict", "node").join(blocked, "node", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_column), "host", "path", "rule", verdict.alias("verdict"))

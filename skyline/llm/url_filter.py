"""Block and allow decisions for urls, carried over to their aliases.

Redirects and canonical links say that two urls are one page. Urls that differ in
scheme, ``www.``, fragment, tracking parameters or a last slash only are one page,
too. Connected components over these edges give each url its aliases. A rule
decides for the urls it fits, whether they are pages of the table or only an end of a
link; a url without a rule takes the decision of its aliases: allow if one of them is allowed by a rule, else block if one is blocked,
else allow.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.llm.components import components
from skyline.llm.shared import staged

#: (action, host and path); the longest rule that fits wins, and allow wins between equals.
Rule = tuple[str, str]
#: Rules that become one expression; more of them are joined as a table.
MOST_RULES = 1000

# Query parameters that do not change the page.
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid)"


def _after_scheme(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def node(url: Column) -> Column:
    """What all spellings of one page share; null for a url without ``://``."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, rf"(^|&){TRACKING}=[^&]*", ""), "^&", "")
    page = F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/$", ""))
    return F.when(F.instr(url, "://") > 0, F.concat(page, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def resolve(url: Column, target: Column) -> Column:
    """``target`` as found on the page ``url``, made absolute (RFC 3986); null where that cannot be, as for ``mailto:``."""
    site, page = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*", 0), path(url)
    first, tail = F.regexp_extract(target, r"^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_extract(page, r"(?s)^(.*/)", 1)
    whole = F.when(F.startswith(first, F.lit("/")), first).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), first))
    parts = F.split(F.regexp_replace(whole, r"/(\.\.?)$", "/$1/"), "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
        lambda out, part: F.when(part == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).when(part == ".", out).otherwise(F.concat(out, F.array(part))),
    )
    same = F.concat(site, page, F.when(F.startswith(tail, F.lit("?")), "").otherwise(F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)), tail)
    return (
        F.when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), target)
        .when((site == "") | F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(None).cast("string"))
        .when(F.startswith(target, F.lit("//")), F.concat(F.regexp_extract(url, r"^[^:/?#]+:", 0), target))
        .when(first == "", same)
        .otherwise(F.concat(site, F.lit("/"), F.array_join(kept, "/"), tail))
    )


def _rule(host_: Column, path_: Column, rules: Sequence[Rule]) -> Column:
    """(rule, action) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow")):
        domain, slash, rest = rule.partition("/")
        fits = ((host_ == domain) | F.endswith(host_, F.lit(f".{domain}"))) & F.startswith(path_, F.lit(slash + rest))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def _with_rule(rows: DataFrame, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """``rows`` (host, path, ...) with ``rule`` and ``action`` of the longest rule that fits, null if none does.

    A table of rules (action, rule) is joined on the host and every domain above it. Distinct hosts and
    paths are looked up, so a url that fills the table counts once; a rule on a domain that holds
    most urls makes partitions that adaptive execution splits, against one row of the rule table.
    """
    if not isinstance(rules, DataFrame) and len(rules) > MOST_RULES:
        rules = rows.sparkSession.createDataFrame(list(rules), "action string, rule string")
    if not isinstance(rules, DataFrame):
        found = rows.withColumn("__found", _rule(F.col("host"), F.col("path"), rules))
        return found.select(*rows.columns, F.col("__found.rule").alias("rule"), F.col("__found.action").alias("action"))
    known = rules.filter("rule is not null and action in ('allow', 'block')").select("action", "rule").distinct()
    known = known.withColumns({"domain": F.regexp_extract("rule", "^([^/]*)", 1), "start": F.regexp_extract("rule", "(?s)^[^/]*(.*)$", 1)})
    labels = F.split("host", "[.]")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    places = rows.select("host", "path").filter("host is not null and path is not null").distinct()
    met = places.select("host", "path", F.explode(above).alias("domain")).join(known, "domain").filter(F.startswith("path", F.col("start")))
    longest = F.max(F.struct(F.length("rule").alias("size"), (F.col("action") == "allow").alias("allows"), "rule", "action"))
    best = staged(met.groupBy("host", "path").agg(longest.alias("best")).select("host", "path", "best.rule", "best.action"), "rules")
    return rows.join(best, ["host", "path"], "left").select(*rows.columns, "rule", "action")


# The entities that stand in urls of html.
ENTITIES = (("&(lt|#0*60|#x0*3c);", "<"), ("&(gt|#0*62|#x0*3e);", ">"), ("&(quot|#0*34|#x0*22);", '"'), ("&(apos|#0*39|#x0*27);", "'"), ("&(amp|#0*38|#x0*26);", "&"))


def _decoded(value: Column) -> Column:
    for pattern, character in ENTITIES:
        value = F.regexp_replace(value, f"(?i){pattern}", character)
    return value


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, in quotes or bare; empty if it is not there."""
    found = [F.regexp_extract(tag, rf"(?is)[\s\"']{name}\s*=\s*{value}", 1) for value in (r'"([^"]*)"', r"'([^']*)'", r"([^\s\"'>]+)")]
    return F.trim(_decoded(F.when(found[0] != "", found[0]).when(found[1] != "", found[1]).otherwise(found[2])))


def page_links(pages: DataFrame) -> DataFrame:
    """(url, target) of canonical links and immediate redirects in the pages' html.

    ``canonical`` may be one of several values of ``rel``. Entities are decoded, and a target is resolved
    against the page's ``<base>`` where it has one. Only the first link and the first redirect of a page count.
    """
    rel = r"""\brel\s*=\s*(?:"[^"]*\bcanonical\b[^"]*"|'[^']*\bcanonical\b[^']*'|canonical\b)"""
    link = F.regexp_extract("html", rf"(?i)<link\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?{rel}[^>]*>", 0)
    refresh = F.regexp_extract("html", r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    target = F.regexp_extract(_attribute(refresh, "content"), r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)", 1)
    bare = _decoded(F.regexp_extract(refresh, r"(?i)\burl\s*=\s*([^\"'\s>;]+)", 1))
    found = F.array(_attribute(link, "href"), F.when(target != "", target).otherwise(bare))
    base = _attribute(F.regexp_extract("html", r"(?i)<base\b[^>]*\bhref\b[^>]*>", 0), "href")
    rows = pages.select("url", base.alias("base"), F.explode(found).alias("target")).filter("target <> ''")
    # few pages have a base; only there is the url resolved twice
    plain = rows.filter("base = ''").select("url", "url", "target")
    moved = rows.filter("base <> ''").select("url", resolve(F.col("url"), F.col("base")).alias("place"), "target")
    rows = plain.toDF("url", "place", "target").union(moved.select("url", F.coalesce("place", "url").alias("place"), "target"))
    return rows.select("url", resolve(F.col("place"), F.col("target")).alias("target")).filter("target is not null")


def judge(pages: DataFrame, rules: Sequence[Rule] | DataFrame, links: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, component) of every row of ``pages``.

    ``rules`` are a few, or a table (action, rule) of any size. ``links`` has (url, target) of redirects known from elsewhere. A target is
    resolved against its url; links with a null end or a relative url are left out. Rules are
    held against both ends of every link, too. A null url has an empty host and path, no rule, no alias,
    and is allowed. Repeated rows are judged each. An empty table gives an empty
    result. Html is read for its links if there is such a column; no other column is.
    """
    url = F.col("url").cast("string")
    seen = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), host(url).alias("host"), path(url).alias("path"), node(url).alias("node")
    )
    seen = staged(_with_rule(seen, rules), "pages")
    known = page_links(pages.select(url.alias("url"), F.col("html").cast("string").alias("html"))) if "html" in pages.columns else None
    if links is not None:
        given = links.select(F.col("url").cast("string").alias("url"), F.col("target").cast("string").alias("target"))
        given = given.select("url", resolve(F.col("url"), F.col("target")).alias("target"))
        known = given if known is None else known.union(given)
    if known is None:
        known = pages.select(url.alias("url"), url.alias("target")).filter("false")
    known = staged(known.filter("url is not null and target is not null"), "targets")
    ends = [(host(F.col(c)), path(F.col(c)), node(F.col(c))) for c in ("url", "target")]
    ends = [F.struct(h.alias("host"), p.alias("path"), n.alias("node")) for h, p, n in ends]
    known = staged(known.select(ends[0].alias("a"), ends[1].alias("b")), "links")
    joined = components(known.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")), "a", "b")
    # Urls without a node meet nothing, and do not meet in one task either.
    apart = seen.filter("node is null").withColumn("component", F.lit(None).cast("string"))
    named = seen.filter("node is not null").join(joined.withColumnRenamed("node", "alias"), F.col("node") == F.col("alias"), "left").drop("alias")
    named = named.withColumn("component", F.coalesce("component", "node"))
    # Ends of links count like pages: a page may lead to a url that is no row of the table.
    ruled = known.filter("a.node is not null and b.node is not null").select(F.explode(F.array("a", "b")).alias("end")).select("end.*").distinct()
    ruled = _with_rule(ruled, rules).select("node", "action").filter("action is not null")
    ruled = ruled.join(joined.withColumnRenamed("node", "alias"), F.col("node") == F.col("alias"), "left")
    ruled = named.select("component", "action").union(ruled.select(F.coalesce("component", "node").alias("component"), "action"))
    decided = ruled.filter("action is not null and component is not null").groupBy("component").agg(
        F.min("action").alias("decision")  # allow comes before block
    ).filter("decision = 'block'")
    verdict = F.coalesce("action", "decision", F.lit("allow")).alias("verdict")
    shown = ("page_id", "host", "path", "rule", verdict, "component")
    return named.join(decided, "component", "left").select(*shown).union(apart.withColumn("decision", F.lit(None).cast("string")).select(*shown))

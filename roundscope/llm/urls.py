"""URL filters with redirect equivalence, in DataFrame operations only.

A page's address is its url without scheme, fragment and tracking parameters, so urls that differ only in these are
one node. A page that redirects (meta refresh) or names a canonical link is an alias of that target. Connected
components over these links carry a block from any blocked address, page or mere target, to aliases without a rule
of their own. A url's own rule always decides for it: an explicit allow takes precedence over a block that reaches
it through aliases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundscope.llm.common import checkpointed
from roundscope.llm.components import connected_components
from roundscope.session import broadcast_within

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)\??([^#]*)"
CANONICAL_TAG = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH_TAG = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>;]+)"""
TRACKING = r"(^|&)utm_[^&]*"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def part(url: Column, group: int) -> Column:
    """Host (1), path (2) or query (3) of a url; empty where it is null or has no ``://``."""
    text = F.coalesce(F.regexp_extract(url, URL, group), F.lit(""))
    return F.translate(text, _UPPER, _LOWER) if group == 1 else text


def address(host: Column, path: Column, query: Column) -> Column:
    """Host, path and the query without tracking parameters; null without a host."""
    kept = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&", "")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def absolute(link: Column, host: Column, path: Column) -> Column:
    """A link of a page as a full url; null where it is empty or names another scheme without ``://``."""
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    return (
        F.when(link.isNull() | (link == "") | link.startswith("#"), None)
        .when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(host == "", None)
        .when(link.startswith("/"), F.concat(F.lit("http://"), host, link))
        .otherwise(F.concat(F.lit("http://"), host, folder, link))
    )


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(rule, verdict) rows from pairs like ``("block", "example.org/path/")``."""
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for v, r in rules])
    return spark.range(1).select(F.inline(rows))


def matching_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, rule_verdict) of the distinct places that a rule fits; the longest rule wins.

    A rule's host is what stands before its first slash and fits that host and its subdomains. Among rules of one
    length a block wins, then the least text. The rules are broadcast if their count allows it.
    """
    split = rules.select(
        "rule",
        F.col("verdict").alias("rule_verdict"),
        F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER).alias("suffix"),
        F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("rule_path"),
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    places = places.select("host", "path").distinct().where("host != ''")
    fits = places.withColumn("suffix", F.explode(suffixes)).join(broadcast_within(split, rules.count()), "suffix")
    fits = fits.where(F.col("path").startswith(F.col("rule_path")))
    best = F.max_by(F.struct("rule", "rule_verdict"), F.struct(F.length("rule"), F.col("rule_verdict") == "block", F.reverse("rule")))
    return fits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.rule_verdict")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict): one row per row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed. A null or empty html
    has no links. Rows that repeat an id or url are judged alike and all stay; other columns are not read. Where a
    page both redirects and names a canonical link, both make aliases. An empty table gives no rows.
    """
    spark = pages.sparkSession
    rules = rules if isinstance(rules, DataFrame) else rule_table(spark, rules)
    url, html = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        part(url, 1).alias("host"),
        part(url, 2).alias("path"),
        part(url, 3).alias("query"),
        F.regexp_extract(F.regexp_extract(html, CANONICAL_TAG, 0), HREF, 1).alias("canonical"),
        F.regexp_extract(F.regexp_extract(html, REFRESH_TAG, 0), REFRESH_URL, 1).alias("redirect"),
    )
    host, path = F.col("host"), F.col("path")
    rows = checkpointed(
        rows.select(
            "page_id",
            "host",
            "path",
            address(host, path, F.col("query")).alias("address"),
            absolute(F.col("canonical"), host, path).alias("canonical"),
            absolute(F.col("redirect"), host, path).alias("redirect"),
        )
    )
    linked = rows.select("address", "host", "path", F.explode(F.array("canonical", "redirect")).alias("target")).where("target is not null and address is not null")
    linked = linked.select("address", "host", "path", part(F.col("target"), 1).alias("to_host"), part(F.col("target"), 2).alias("to_path"), part(F.col("target"), 3).alias("to_query"))
    linked = linked.withColumn("to_address", address(F.col("to_host"), F.col("to_path"), F.col("to_query"))).where("to_address is not null")
    linked = checkpointed(linked.distinct())

    ruled = matching_rules(rows.select("host", "path").union(linked.select("to_host", "to_path")), rules)
    ruled = checkpointed(ruled)
    roots = connected_components(linked, "address", "to_address")
    nodes = linked.select("address", "host", "path").union(linked.select("to_address", "to_host", "to_path")).distinct()
    blocked = nodes.join(ruled.where("rule_verdict = 'block'"), ["host", "path"], "leftsemi")
    blocked = blocked.join(roots, F.col("address") == F.col("node")).select("root").distinct()
    aliases = roots.join(blocked, "root", "leftsemi").select(F.col("node").alias("address"), F.lit(True).alias("alias_blocked"))

    judged = rows.select("page_id", "host", "path", "address").join(ruled, ["host", "path"], "left").join(aliases, "address", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("alias_blocked"), F.lit("block")).otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))

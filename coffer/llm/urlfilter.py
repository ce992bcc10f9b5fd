"""URL rules, and block decisions that follow redirects and canonical links to aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm.components import connected_components
from coffer.llm.shared import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK_TAG = r"(?i)<link\b[^>]*>"
META_TAG = r"(?i)<meta\b[^>]*>"
CANONICAL = r"""(?i)\brel\s*=\s*["']?\s*canonical\b"""
HREF = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
REFRESH_URL = r"""(?i)\bcontent\s*=\s*["']?\s*\d+\s*[;,]\s*url\s*=\s*["']?([^"'>\s]+)"""


ADDRESS = r"^([^/?#]*)([^?#]*)(\?[^#]*)?"


def parsed(table: DataFrame, url: str, names: tuple[str, str, str] = ("host", "path", "key")) -> DataFrame:
    """table with host, path and alias key of a url column.

    Host: what follows the first :// up to / ? # or the end, A-Z lower-cased; path: then up to ? # or the end; both are
    empty for NULL and for urls without ://. The key is host, path and query, without scheme and fragment; NULL if
    there is no host.
    """
    host, path, key = names
    at = F.locate("://", F.col(url))
    rest = F.coalesce(F.when(at > 0, F.substring(F.col(url), at + 3, F.char_length(url))), F.lit(""))
    # inline() keeps filters on what is parsed from being pushed below, which would repeat the parsing in each of them.
    parts = F.transform(
        F.array(rest),
        lambda r: F.struct(
            F.translate(F.regexp_extract(r, ADDRESS, 1), UPPER, LOWER).alias(host),
            F.regexp_extract(r, ADDRESS, 2).alias(path),
            F.regexp_extract(r, ADDRESS, 3).alias("_query"),
        ),
    )
    from_root = F.when(F.col(path) == "", F.lit("/")).otherwise(F.col(path))
    whole = F.concat(host, from_root, "_query")
    return table.select("*", F.inline(parts)).withColumn(key, F.when(F.col(host) != "", whole)).drop("_query")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a table. Of contrary rules for one host and path, the one that allows holds."""
    return spark.createDataFrame(rules, "rule_verdict string, rule_host string, rule_path string")


def rule_of(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule and rule_verdict of the sites that some rule fits; the longest rule wins, then one that allows.

    A host meets the rules through its own name and its parent domains, an equality join, however long the list is.
    No rule fits a domain of more labels than its own host has, so a host of very many labels has few parents to meet.
    """
    labels = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 1
    parents = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in range(1, labels + 1)]))
    met = sites.select("host", "path", F.explode(parents).alias("domain")).join(rules, F.col("domain") == F.col("rule_host"))
    rule = F.concat("rule_host", "rule_path")
    return (
        met.where(F.expr("startswith(path, rule_path)"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.char_length(rule), F.col("rule_verdict") == "allow", rule.alias("rule"), "rule_verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.rule_verdict")
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """Links (a, b) between a page's key and the keys of its canonical link and its redirect.

    Targets may be whole urls, //host/..., /path or relative to the page's folder. Pages without a usable url give none.
    """
    html = F.coalesce("html", F.lit(""))
    canonical = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(LINK_TAG), F.lit(0)), lambda t: F.regexp_like(t, F.lit(CANONICAL))),
        lambda t: F.concat(*[F.regexp_extract(t, HREF, k) for k in (1, 2, 3)]),
    )
    redirect = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(META_TAG), F.lit(0)), lambda t: F.regexp_like(t, F.lit(REFRESH))),
        lambda t: F.regexp_extract(t, REFRESH_URL, 1),
    )
    found = pages.select("url", F.explode(F.concat(canonical, redirect)).alias("raw")).select(
        "url", F.trim(F.replace("raw", F.lit("&amp;"), F.lit("&"))).alias("to")
    )
    source = parsed(found, "url").where("key is not null and to <> ''")
    folder = F.when(F.col("path") == "", F.lit("/")).otherwise(F.regexp_replace("path", r"[^/]*$", ""))
    target = (
        F.when(F.col("to").contains("://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to"))
        .when(F.col("to").startswith("/"), F.concat(F.lit("http://"), "host", "to"))
        .otherwise(F.concat(F.lit("http://"), "host", folder, "to"))
    )
    ends = parsed(source.select(F.col("key").alias("a"), target.alias("target")), "target", ("_h", "_p", "b"))
    return ends.where("a <> b").select("a", "b").distinct()


def judged(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule, verdict and how the verdict came: rule, alias or default.

    A page that a rule fits has the rule's verdict. Any other has that of its component over redirect and canonical
    links: allow if some address in it is allowed by a rule, else block if some is blocked. Pages that neither reaches
    are allowed. Every row gives a row, repeated ones too; NULL urls have an empty host and path and no alias. Further
    links (a, b), such as those of a crawl's redirect log, come in edges. Other columns are left out.
    """
    scratch = Scratch(pages.sparkSession, "aliases")
    base = parsed(pages.select("page_id", "url"), "url")
    links = alias_edges(pages)
    if edges is not None:
        ends = parsed(parsed(edges.select("a", "b"), "a", ("_h", "_p", "from")).select("from", "b"), "b", ("_h", "_p", "to"))
        links = links.union(ends.where("from <> to").select("from", "to")).distinct()
    members = connected_components(links, scratch)
    # Decisions of the addresses that have aliases; those of a component add up map-side.
    reached = parsed(members.select("component", F.concat(F.lit("://"), "node").alias("address")), "address")
    ruled = reached.join(rule_of(reached.select("host", "path").distinct(), rules), ["host", "path"])
    decided = ruled.groupBy("component").agg(
        F.when(F.bool_or(F.col("rule_verdict") == "allow"), F.lit("allow")).otherwise("block").alias("alias_verdict")
    )
    aliases = members.join(decided, "component").select(F.col("node").alias("key"), "alias_verdict")
    own = rule_of(base.select("host", "path").distinct(), rules)
    return (
        base.join(own, ["host", "path"], "left")
        .join(aliases, "key", "left")
        .select(
            "page_id",
            "url",
            "host",
            "path",
            "rule",
            F.coalesce("rule_verdict", "alias_verdict", F.lit("allow")).alias("verdict"),
            F.when(F.col("rule").isNotNull(), "rule").when(F.col("alias_verdict").isNotNull(), "alias").otherwise("default").alias("reason"),
        )
    )

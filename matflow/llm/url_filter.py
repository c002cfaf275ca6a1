"""URL rules, and block decisions that follow redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matflow.llm.components import connected_components

ALLOW, BLOCK = "allow", "block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK_TAG, _META_TAG = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
_CANONICAL = r"""(?i)\brel\s*=\s*["']?canonical\b"""
_REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
_TARGET = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """Fits the host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str


def _after_scheme(url: Column) -> Column:
    """What follows the first "://"; empty where there is none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """Up to the first of / ? #, with A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def address_of(url: Column) -> Column:
    """Host, path and query: URLs that differ in scheme or fragment only are one address. Null without a host."""
    rest = F.regexp_extract(_after_scheme(url), "^[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), rest))


def _host_rules(spark: SparkSession, hosts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(host, fitting): the rules of each host and of the domains above it, by a join on the domain."""
    rows = [(r.host, r.path, r.host + r.path, r.verdict) for r in rules]
    table = spark.createDataFrame(rows, "domain string, rule_path string, rule string, rule_verdict string").distinct()
    labels = F.split("host", r"\.")
    domain = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    fit = hosts.select("host", F.explode(domain).alias("domain")).join(table, "domain")
    order = F.struct(
        F.length("rule").alias("size"),
        (F.col("rule_verdict") == ALLOW).alias("allows"),
        F.col("rule"),
        F.col("rule_path").alias("path"),
        F.col("rule_verdict").alias("verdict"),
    )
    return fit.groupBy("host").agg(F.collect_list(order).alias("fitting"))


def apply_rules(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rows`` (with host and path) and the longest fitting ``rule`` with its ``rule_verdict``, or nulls.

    Of two rules of the same length the one that allows wins, then the larger text.
    """
    fitting = _host_rules(rows.sparkSession, rows.select("host").distinct(), rules)
    joined = rows.join(fitting, "host", "left")
    best = F.array_max(F.filter("fitting", lambda rule: F.startswith(F.col("path"), rule["path"])))
    found = joined.withColumn("__best", best)
    return found.select(
        *rows.columns, F.col("__best.rule").alias("rule"), F.col("__best.verdict").alias("rule_verdict")
    )


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): addresses of pages and of where their canonical links and refresh redirects point.

    Targets may be whole URLs, or begin with // or /; others are left out.
    """
    links = F.filter(F.regexp_extract_all(html, F.lit(_LINK_TAG), F.lit(0)), lambda tag: tag.rlike(_CANONICAL))
    metas = F.filter(F.regexp_extract_all(html, F.lit(_META_TAG), F.lit(0)), lambda tag: tag.rlike(_REFRESH))
    targets = F.concat(
        F.transform(links, lambda tag: F.regexp_extract(tag, _HREF, 1)),
        F.transform(metas, lambda tag: F.regexp_extract(tag, _TARGET, 1)),
    )
    source = F.col(url)
    pairs = pages.select(source.alias("source"), F.explode(targets).alias("target"))
    target = F.col("target")
    whole = (
        F.when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(F.lit("http://"), host_of(F.col("source")), target))
        .otherwise(target)
    )
    edges = pairs.select(address_of(F.col("source")).alias("a"), address_of(whole).alias("b"))
    return edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull()).distinct()


def _component_verdicts(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(address, shared_verdict) of all aliases: allow if a rule allows one of them, else block if one is blocked."""
    nodes = connected_components(edges).withColumnRenamed("node", "address")
    parts = nodes.withColumn("__url", F.concat(F.lit("http://"), F.col("address")))
    parts = parts.withColumns({"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))})
    judged = apply_rules(parts, rules)
    has = lambda verdict: F.coalesce(F.bool_or(F.col("rule_verdict") == verdict), F.lit(False))
    shared = judged.groupBy("component").agg(
        F.when(has(ALLOW), ALLOW).when(has(BLOCK), BLOCK).alias("shared_verdict")
    )
    return nodes.join(shared, "component").select("address", "shared_verdict")


def judge_pages(pages: DataFrame, rules: Sequence[Rule], edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, by_alias) of every page.

    The verdict is that of the page's own rule. Without one, aliases decide: pages that redirects and canonical
    links connect share a block, unless one of them is explicitly allowed. All others are allowed. ``edges``
    (a, b: URLs) are known redirects besides those in the pages. A missing URL, or one without "://", has an empty
    host and path and no aliases. Repeated rows give repeated results.
    """
    links = alias_edges(pages)
    if edges is not None:
        known = edges.select(address_of(F.col("a")).alias("a"), address_of(F.col("b")).alias("b"))
        links = reduce(DataFrame.union, [links, known.filter(F.col("a").isNotNull() & F.col("b").isNotNull())])
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("address"))
    judged = apply_rules(rows, rules).join(_component_verdicts(links, rules), "address", "left")
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", "shared_verdict", F.lit(ALLOW)).alias("verdict"),
        (F.col("rule_verdict").isNull() & F.col("shared_verdict").isNotNull()).alias("by_alias"),
    )

"""URL filter with redirect equivalence.

A url is cut into host and path; block and allow rules name a host (with all
its subdomains) and a path prefix, and the longest fitting rule decides. Urls
that redirect to each other, or name each other as canonical, are aliases:
they are joined to equivalence classes by distributed connected components
over those edges, and a block decision holds for all aliases that have no
rule of their own. An explicit allow rule takes precedence: a url that it
fits stays allowed, and it does not hand its allowance on.

Rules are matched by equi-joins: each distinct host is expanded to its
suffixes and joined to the rules' hosts, so no url is compared with every
rule. The hosts with rules are written as a table, and Spark broadcasts it to
the urls if its size allows; otherwise it splits skewed hosts.

Edges come from the html: ``<link rel=canonical href>`` and
``<meta http-equiv=refresh content="0;url=">``. Relative targets are resolved
against the page's host. Node names are host, path and query, so http and
https, fragments and host case make no difference.

Null urls and urls without ``://`` have an empty host and path, fit no rule
that names a host and have no aliases. Null html has no edges. Repeated rows
get the same verdict each. An empty input gives an empty result; without
rules everything is allowed. Of equally long rules (only possible for
repeated ones) block wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.llm.common import ascii_lower, pick, prepare
from quaybook.llm.components import component_labels
from quaybook.plans.stages import write_stage

#: (verdict, host, path prefix)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, host string, path string")


def with_parts(df: DataFrame, url: str, prefix: str = "") -> DataFrame:
    """Adds host (A-Z lower-cased), path and name of a url column. ``name`` is
    host, path and query: the same for aliases that differ only in scheme,
    fragment or host case; null without a host. Each step reads a column of
    the one before, so no expression is written out twice."""
    rest, host, path, query, name = (f"{prefix}{x}" for x in ("rest", "host", "path", "query", "name"))
    at = F.locate("://", F.col(url))
    return (df.withColumn(rest, F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(""))
            .withColumn(host, ascii_lower(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)))
            .withColumn(path, F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1))
            .withColumn(query, F.regexp_extract(rest, r"(?s)\A[^?#]*(\?[^#]*)?", 1))
            .withColumn(name, F.when(F.col(host) != "", F.concat(host, path, query))).drop(rest, query))


def _attribute(tag: str, name: str) -> Column:
    """The value of a tag's attribute, without its quotes; empty if none."""
    return F.regexp_replace(F.regexp_extract(
        tag, rf"(?is)[\s\"']{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1), r"\A[\"']|[\"']\z", "")


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(u, v): names of a page and of what it redirects to or calls canonical.
    Links inside comments and scripts don't count. Targets are resolved
    against the page's scheme, host and folder."""
    rows = pick(pages, url=url_col, html=html_col).where(F.col("html").rlike(r"(?i)canonical|http-equiv"))
    bare = F.regexp_replace("html", r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")
    tags = rows.select("url", F.explode(F.regexp_extract_all(bare, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), 1)).alias("tag"))
    canonical = F.when(ascii_lower(F.col("rel")).rlike(r"(?s)(\A|\s)canonical(\s|\z)"), F.col("href"))
    refresh = F.when(ascii_lower(F.col("equiv")) == "refresh",
                     F.regexp_extract("content", r"(?is)url\s*=\s*['\"]?([^'\"]*)", 1))
    found = (tags.withColumns({"rel": _attribute("tag", "rel"), "href": _attribute("tag", "href"),
                               "equiv": _attribute("tag", "http-equiv"), "content": _attribute("tag", "content")})
             .withColumn("target", F.trim(F.replace(F.coalesce(canonical, refresh), F.lit("&amp;"), F.lit("&"))))
             .where("target IS NOT NULL AND target != ''"))
    # Few rows have a target: written, they are resolved on their own.
    found = with_parts(write_stage(found.select("url", "target").distinct(), "targets"), "url")
    t = F.col("target")
    folder = F.regexp_replace(F.concat(F.col("host"), F.when(F.col("path") == "", "/").otherwise(F.col("path"))), r"[^/]*\z", "")
    whole = (F.when(t.rlike(r"(?s)\A[A-Za-z][A-Za-z0-9+.-]*://"), t)
             .when(t.startswith("//"), F.concat(F.lit("x:"), t))
             .when(t.startswith("/"), F.concat(F.lit("x://"), F.col("host"), t))
             .when(t.rlike(r"(?s)\A[A-Za-z][A-Za-z0-9+.-]*:|\A#"), F.lit(None))
             .otherwise(F.concat(F.lit("x://"), folder, t)))
    ends = with_parts(found.select(F.col("name").alias("u"), whole.alias("to")), "to")
    return ends.select("u", F.col("name").alias("v")).where("u IS NOT NULL AND v IS NOT NULL")


def rule_verdicts(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest rule that fits host
    and path."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    r = rules.select(F.col("verdict").alias("rule_verdict"), F.col("host").alias("rule_host"), F.col("path").alias("rule_path"))
    # Hosts repeat much more than urls: expand and join each host once.
    hosts = rows.select("host").where(F.col("host") != "").distinct()
    fits = (hosts.select("host", F.explode(suffixes).alias("rule_host")).join(r, "rule_host")
            .groupBy("host").agg(F.collect_set(F.struct(
                F.length("rule_host").alias("h"), F.length("rule_path").alias("p"), (F.col("rule_verdict") == "block").alias("b"),
                "rule_host", "rule_path", "rule_verdict")).alias("fits")))
    fits = write_stage(fits, "host-rules")
    best = F.array_max(F.filter("fits", lambda f: F.startswith(F.col("path"), f["rule_path"])))
    return (rows.join(fits, "host", "left").withColumn("best", best)
            .withColumn("rule", F.concat("best.rule_host", "best.rule_path"))
            .withColumn("rule_verdict", F.col("best.rule_verdict")).drop("fits", "best"))


def judge(pages: DataFrame, rules: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", edges: DataFrame | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, component) of every row. ``edges``: more
    (u, v) names of aliases, such as a crawler's redirect log."""
    spark = pages.sparkSession
    prepare(spark)
    rules = rule_table(spark) if rules is None else rules
    rows = with_parts(pick(pages, page_id=id_col, url=url_col), "url").drop("url")
    judged = write_stage(rule_verdicts(rows, rules), "judged")
    links = page_edges(pages, url_col, html_col)
    alias = component_labels(links if edges is None else links.union(edges.select("u", "v")))
    alias = write_stage(alias.select(F.col("node").alias("name"), "component"), "aliases")
    # Aliases that no page has still carry their own rule's block.
    known = with_parts(alias.select("component", F.concat(F.lit("x://"), F.col("name")).alias("url")), "url").drop("url", "name")
    blocked = write_stage(rule_verdicts(known, rules).where("rule_verdict = 'block'")
                          .select("component").distinct().withColumn("alias_blocked", F.lit(True)), "blocked")
    passed_on = write_stage(alias.join(blocked, "component", "left")
                            .select("name", "component", F.coalesce("alias_blocked", F.lit(False)).alias("alias_blocked")), "passed")
    return (judged.join(passed_on, "name", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("rule_verdict", F.when(F.col("alias_blocked"), "block"), F.lit("allow")).alias("verdict"),
                    F.coalesce("component", "name").alias("component")))

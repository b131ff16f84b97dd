"""URL filter: per-host path-template trees judged by smoothed labelled purity.

* Templates. Level by level, a path segment stays literal if it has ``MIN_PAGES``
  pages below its parent, whatever the size of the host; the others become ``*``.
  The levels go on to the end of the longest path; only beyond ``DEPTH`` a node of
  fewer than ``MIN_PAGES`` pages, which nothing below can split, ends in one
  closing ``**``.
* Merging. From the deepest level up, a literal branch merges into ``*`` if its rate
  of bad labels differs from that of its siblings with the same rest by less than
  ``Z`` standard errors.
* Verdict. The purity of a template is its share of good labels, smoothed towards
  that of its host, which is smoothed towards that of all pages. Templates below
  ``MIN_PURITY`` are blocked.
* Rules (host, path) come first: a rule fits its host and all subdomains where the
  url's path starts with the rule's; the longest wins.

All statistics are partial aggregates over (host, template prefix); a host with a
third of all pages sends a few rows per task. Rows meet the tree in joins whose both
sides are shuffled tables, so its hot nodes can be split.

Defined cases: a null url, or one without ``://``, has empty host and path and is
judged as a host of that name; pages without label do not count for purity; repeated
rows are judged one by one; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelake.llm.common import materialize

#: Levels that are taken apart however few pages a node has.
DEPTH = 4
MIN_PAGES = 5
Z = 2.0
#: Weight of the host (and of all pages for the host) in labelled pages.
PRIOR = 10.0
MIN_PURITY = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return (F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def ruled(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Rules: (verdict, host + path)."""
    rule = verdict = F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):  # later ones win
        rule_host, _, tail = r.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + tail)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def templates(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Add ``template`` to pages (page_id, host, path, bad)."""
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    rows = pages.withColumn("_segments", segments).withColumn("template", F.lit(""))
    rows = materialize(spark, rows, "url-rows")
    deepest = rows.agg(F.max(F.size("_segments"))).first()[0] or 0
    settled = []
    for level in range(deepest):
        if level >= DEPTH:
            nodes = rows.where(F.size("_segments") > level).groupBy("host", "template").agg(F.count(F.lit(1)).alias("n"))
            nodes = materialize(spark, nodes.where(F.col("n") >= MIN_PAGES), "url-nodes").select(
                "host", "template", F.lit(True).alias("_splits"))
            splits = F.coalesce("_splits", F.lit(False)) & (F.size("_segments") > level)
            parted = materialize(spark, rows.join(nodes, ["host", "template"], "left").withColumn("_splits", splits), "url-parted")
            tail = F.when(F.size("_segments") > level, F.lit("/**")).otherwise(F.lit(""))
            settled.append(parted.where("NOT _splits").withColumn("template", F.concat("template", tail)).select(rows.columns))
            rows = parted.where("_splits").select(rows.columns)
            if rows.isEmpty():
                break
        segment = F.get("_segments", F.lit(level))
        here = rows.withColumn("_s", segment)
        children = here.where("_s IS NOT NULL").groupBy("host", "template", "_s").agg(F.count(F.lit(1)).alias("n"))
        children = materialize(spark, children, "url-children")
        literal = children.where(F.col("n") >= MIN_PAGES).select("host", "template", "_s", F.lit(True).alias("_literal"))
        named = here.join(materialize(spark, literal, "url-literals"), ["host", "template", "_s"], "left")
        step = F.when(F.col("_s").isNull(), F.lit("")).when(F.col("_literal"), F.concat(F.lit("/"), "_s")).otherwise(F.lit("/*"))
        rows = named.select(*pages.columns, "_segments", F.concat("template", step).alias("template"))
        rows = materialize(spark, rows, "url-rows")
    for part in settled:
        rows = rows.unionByName(part)
    return rows.select(*pages.columns, "template")


def merged(spark: SparkSession, stats: DataFrame) -> DataFrame:
    """Add ``merged`` to (host, template, labelled, bad)."""
    cur = stats.withColumn("merged", F.col("template"))
    deepest = stats.agg(F.max(F.size(F.split("template", "/")) - 1)).first()[0] or 0
    for level in range(deepest, 0, -1):
        # position ``level`` of the split template is the segment of that level
        parts = F.split("merged", "/")
        mine = F.get(parts, F.lit(level))
        general = F.array_join(F.transform(parts, lambda x, i: F.when(i == level, F.lit("*")).otherwise(x)), "/")
        cur = cur.withColumn("_general", F.when(mine.isNotNull() & (mine != "**"), general))
        own = cur.groupBy("host", "merged", "_general").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
        own = materialize(spark, own.where("_general IS NOT NULL"), "url-branches")
        pool = own.groupBy("host", "_general").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
        rate = F.col("all_b") / F.greatest("all_n", F.lit(1))
        off = F.abs(F.col("b") / F.greatest("n", F.lit(1)) - rate)
        error = F.sqrt(rate * (1 - rate) / F.greatest("n", F.lit(1)))
        alike = own.join(pool, ["host", "_general"]).where((F.col("n") == 0) | (off <= Z * error)).select(
            "host", "merged", F.col("_general").alias("_to"))
        cur = cur.join(alike, ["host", "merged"], "left").select(
            "host", "template", "labelled", "bad", F.coalesce("_to", "merged").alias("merged"))
        cur = materialize(spark, cur, "url-merged")
    return cur


def url_filter(spark: SparkSession, pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity per row of ``pages``
    (page_id, url); ``labels`` has (page_id, bad: 0 or 1) for some pages."""
    host, path = host_and_path(F.col("url"))
    known = labels.groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    p = pages.select("page_id", host.alias("host"), path.alias("path")).join(known, "page_id", "left")
    p = materialize(spark, templates(spark, p), "url-templates")
    stats = p.groupBy("host", "template").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tree = merged(spark, materialize(spark, stats, "url-stats"))
    good, n = tree.agg(F.sum(F.col("labelled") - F.col("bad")), F.sum("labelled")).first()
    overall = ((good or 0) + 1.0) / ((n or 0) + 1.0)
    smooth = lambda good, n, prior: (good + PRIOR * prior) / (n + PRIOR)
    by_host = tree.groupBy("host").agg(smooth(F.sum(F.col("labelled") - F.col("bad")), F.sum("labelled"), F.lit(overall)).alias("_prior"))
    by_template = tree.groupBy("host", "merged").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    purity = by_template.join(by_host, "host").select(
        "host", "merged", smooth(F.col("n") - F.col("b"), F.col("n"), F.col("_prior")).alias("purity"))
    judged = tree.select("host", "template", "merged").join(purity, ["host", "merged"])
    out = p.join(materialize(spark, judged, "url-judged"), ["host", "template"])
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("purity") < MIN_PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                      F.col("merged").alias("template"), "purity")

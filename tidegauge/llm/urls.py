"""URL filter by a tree of path templates per host, with DataFrame functions only.

The tree grows from the root, one path segment at a time: of all pages of a host that share a template so far, a segment
value seen at least ``SUPPORT`` times and in at least ``SHARE`` of them stays literal, all others become ``*``. Segments
beyond ``DEPTH`` are one ``**``. Branches of a host with the same shape whose labelled purity falls on the same side
(or on neither) with a confidence of 95% are merged. A template's purity, the share of blocked among its labelled
pages, is smoothed by ``PRIOR`` pages of the rate of the same template on all hosts, that one by the rate of all pages;
from one half on the template is rejected.

Labels come from the caller; in ``filter_urls`` pages that a rule decides are the labelled ones.

URLs: null, or without ``://``, has an empty host and path. Repeated rows are pages of their own. Without any label
nothing is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.native import ascii_lower
from tidegauge.llm.scratch import stored

DEPTH = 4
SUPPORT = 5
SHARE = 0.01
PRIOR = 4.0

Rule = tuple[str, str, str]  # host, start of the path, verdict


def host_and_path(url: Column) -> tuple[Column, Column]:
    known = F.instr(url, "://") > 0
    rest = F.when(known, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest that fits; nulls where none does."""
    ordered = sorted(rules, key=lambda r: len(r[0] + r[1]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own, start, says in ordered:
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(start))
        name = F.when(fits, F.lit(own + start)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def with_templates(pages: DataFrame) -> DataFrame:
    """Adds ``template`` to rows with ``host`` and ``path``."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    grown = pages.withColumn("segments", segments).withColumn("template", F.lit(""))
    for depth in range(DEPTH):
        grown = stored(grown)
        segment = F.get("segments", F.lit(depth))
        counts = grown.filter(segment.isNotNull()).groupBy(
            F.col("host").alias("b_host"), F.col("template").alias("b_template"), segment.alias("b_segment")
        ).count()
        totals = counts.groupBy(F.col("b_host").alias("t_host"), F.col("b_template").alias("t_template")).agg(F.sum("count").alias("total"))
        literal = (
            counts.filter(F.col("count") >= SUPPORT)
            .join(totals, (F.col("b_host") == F.col("t_host")) & (F.col("b_template") == F.col("t_template")))
            .filter(F.col("count") >= SHARE * F.col("total")).select("b_host", "b_template", "b_segment")
        )
        same = (F.col("host") == F.col("b_host")) & (F.col("template") == F.col("b_template")) & (segment == F.col("b_segment"))
        part = F.when(segment.isNull(), "").when(F.col("b_segment").isNull(), "/*").otherwise(F.concat(F.lit("/"), segment))
        grown = grown.join(literal, same, "left").select(*pages.columns, "segments", F.concat("template", part).alias("template"))
    more = F.when(F.size("segments") > DEPTH, "/**").otherwise("")
    return stored(grown.select(*pages.columns, F.concat("template", more).alias("template")))


def rejected_templates(templated: DataFrame) -> DataFrame:
    """(r_host, r_template, purity, rejected) from rows with host, template and blocked (null: not labelled)."""
    nodes = stored(templated.groupBy("host", "template").agg(
        F.count("*").alias("n"), F.count_if("blocked").alias("b"), F.count_if(~F.col("blocked")).alias("a")
    ))
    blocked, allowed = nodes.agg(F.sum("b"), F.sum("a")).first()
    overall = (blocked or 0) / max(1, (blocked or 0) + (allowed or 0))
    everywhere = nodes.groupBy(F.col("template").alias("e_template")).agg(
        ((F.sum("b") + PRIOR * overall) / (F.sum("b") + F.sum("a") + PRIOR)).alias("rate")
    )
    smoothed = (F.col("b") + PRIOR * F.col("rate")) / (F.col("b") + F.col("a") + PRIOR)
    width = 1.96 * F.sqrt(F.col("own") * (1 - F.col("own")) / (F.col("b") + F.col("a") + PRIOR))
    sided = (
        nodes.join(everywhere, F.col("template") == F.col("e_template"))
        .withColumn("own", smoothed)
        .withColumn("side", F.when(F.col("own") - width > 0.5, 1).when(F.col("own") + width < 0.5, -1).otherwise(0))
        .withColumn("shape", F.regexp_replace("template", "/[^/*][^/]*", "/w"))
    )
    merged = sided.groupBy(F.col("host").alias("m_host"), F.col("shape").alias("m_shape"), F.col("side").alias("m_side")).agg(
        ((F.sum("b") + PRIOR * F.sum(F.col("rate") * F.col("n")) / F.sum("n")) / (F.sum("b") + F.sum("a") + PRIOR)).alias("purity")
    )
    same = (F.col("host") == F.col("m_host")) & (F.col("shape") == F.col("m_shape")) & (F.col("side") == F.col("m_side"))
    return sided.join(merged, same).select(
        F.col("host").alias("r_host"), F.col("template").alias("r_template"), "purity", (F.col("purity") >= 0.5).alias("rejected")
    )


def filter_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, template, purity, verdict of every row."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = longest_rule(F.col("host"), F.col("path"), rules)
    labelled = parsed.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"))
    templated = with_templates(labelled.withColumn("blocked", F.col("says") == "block"))
    judged = rejected_templates(templated)
    same = (F.col("host") == F.col("r_host")) & (F.col("template") == F.col("r_template"))
    method = F.when(F.col("rejected"), "block").otherwise("allow")
    return templated.join(judged, same, "left").select(
        "page_id", "host", "path", "rule", "template", "purity", F.coalesce("says", method).alias("verdict")
    )

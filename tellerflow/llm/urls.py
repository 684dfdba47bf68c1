"""URL verdicts by rules and by a path-template tree; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerflow.llm.common import stored

#: (verdict, host/path)
Rule = tuple[str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z folded, and the path; both empty for null and for urls without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return (
        F.coalesce(host, F.lit("")),
        F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")),
    )


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or null. A rule fits its host and subdomains."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, _, tail = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(
            path, F.lit(f"/{tail}")
        )
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def template_verdicts(
    urls: DataFrame,
    labelled: DataFrame,
    support: int = 5,
    similar: float = 1.96,
    smoothing: float = 10.0,
    reject: float = 0.5,
) -> DataFrame:
    """(host, path, template, bad_share, verdict) per distinct host and path of ``urls``.

    ``urls`` has host and path; ``labelled`` has host, path and bad (boolean), a row per label.
    Level by level, a segment of a node stays literal if it has at least ``support`` pages and as
    many labels, however large the node is; all others of the node become one wildcard. Segments
    below the last level at which a host has that many left become the wildcard ``**``. A branch
    whose bad share differs from its parent's by less than
    ``similar`` standard errors, or that has no labels, is merged into the parent; so a page is
    judged by its deepest branch that does differ, or by its host. That branch is blocked if
    (bad + smoothing * overall share) / (labels + smoothing) reaches ``reject``.

    Counts are summed per distinct path before any level, and each level shuffles sums only.
    """
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    labels = labelled.groupBy("host", "path").agg(
        F.count("bad").alias("labels"), F.sum(F.col("bad").cast("long")).alias("bad")
    )
    nodes = stored(
        urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
        .join(labels, ["host", "path"], "left")
        .select("host", "path", "n", F.coalesce("labels", F.lit(0)).alias("labels"),
                F.coalesce("bad", F.lit(0)).alias("bad"), segments.alias("s"),
                F.array(F.lit("")).alias("branches")),
        "nodes",
    )
    deeper = Window.partitionBy("host").orderBy(F.desc("size"))
    left = [F.sum(c).over(deeper) >= support for c in ("n", "labels")]
    depth = (
        nodes.groupBy("host", F.size("s").alias("size"))
        .agg(F.sum("n").alias("n"), F.sum("labels").alias("labels"))
        .select("size", (left[0] & left[1]).alias("enough"))
        .filter("enough").agg(F.max("size")).first()[0]
    ) or 0
    for level in range(depth):
        here = nodes.filter(F.size("s") > level).withColumns(
            {"segment": F.get("s", F.lit(level)), "t": F.element_at("branches", -1)}
        )
        named = (
            here.groupBy("host", "t", "segment")
            .agg(F.sum("n").alias("pages"), F.sum("labels").alias("known"))
            .filter((F.col("pages") >= support) & (F.col("known") >= support))
            .select("host", "t", "segment", F.lit(True).alias("literal"))
        )
        step = F.when(F.col("literal"), F.col("segment")).otherwise("*")
        grown = here.join(named, ["host", "t", "segment"], "left").withColumn(
            "branches", F.concat("branches", F.array(F.concat("t", F.lit("/"), step))))
        grown = grown.select(*nodes.columns)
        nodes = stored(nodes.filter(F.size("s") <= level).unionByName(grown), "nodes")
    nodes = nodes.withColumn(
        "branches",
        F.when(F.size("s") > depth, F.concat(
            "branches", F.array(F.concat(F.element_at("branches", -1), F.lit("/**")))))
        .otherwise(F.col("branches")),
    )
    steps = nodes.select("host", "n", "labels", "bad", F.posexplode("branches").alias("level", "branch"),
                         F.col("branches").alias("b"))
    branches = steps.groupBy("host", "branch", "level").agg(
        F.sum("labels").alias("labels"), F.sum("bad").alias("bad"),
        F.any_value(F.get("b", F.col("level") - 1)).alias("parent"),
    )
    above = branches.select("host", F.col("branch").alias("parent"),
                            (F.col("level") + 1).alias("level"),
                            F.col("labels").alias("parent_labels"), F.col("bad").alias("parent_bad"))
    overall = branches.filter("level = 0").agg(
        F.try_divide(F.sum("bad"), F.sum("labels")).alias("overall"))
    rate = F.try_divide("parent_bad", "parent_labels")
    error = F.sqrt(F.try_divide(rate * (1 - rate), F.col("labels")))
    differs = (F.col("labels") > 0) & (
        F.abs(F.try_divide("bad", "labels") - rate) >= similar * error) & (error > 0)
    prior = F.coalesce(overall.scalar(), F.lit(0.0))
    judged = branches.join(above, ["host", "parent", "level"], "left").select(
        "host", "branch", "level",
        ((F.col("level") == 0) | F.coalesce(differs, F.lit(False))).alias("own"),
        ((F.col("bad") + smoothing * prior) / (F.col("labels") + smoothing)).alias("bad_share"),
    )
    own = stored(judged.filter("own"), "branches")
    flat = nodes.select("host", "path", F.element_at("branches", -1).alias("leaf"),
                        F.posexplode("branches").alias("level", "branch"))
    chosen = (
        flat.join(own, ["host", "branch", "level"])
        .groupBy("host", "path")
        .agg(F.max(F.struct("level", "bad_share")).alias("c"), F.any_value("leaf").alias("template"))
    )
    share_of = F.col("c.bad_share")
    return chosen.select(
        "host", "path", "template", share_of.alias("bad_share"),
        F.when(share_of >= reject, "block").otherwise("allow").alias("verdict"),
    )


def judge(
    pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame,
    id_col: str = "page_id", url_col: str = "url", **settings,
) -> DataFrame:
    """page_id, host, path, rule, verdict, template, bad_share of every row of ``pages``.

    ``labelled`` has url and bad (boolean; null counts as no label). The longest fitting rule
    decides; without one the template does. ``rules`` is a short list and becomes one expression.

    A null url, one without ``://`` and an empty one have empty host and path and share one
    template. Repeated rows and null ids are returned as they are; extra columns are ignored.
    Without any label every template is allowed.
    """
    def parts(df: DataFrame, url: str, *more: Column) -> DataFrame:
        host, path = host_and_path(F.col(url).cast("string"))
        return df.select(*more, host.alias("host"), path.alias("path"))

    urls = parts(pages, url_col, F.col(id_col).alias("page_id"))
    found = template_verdicts(
        urls, parts(labelled, "url", F.col("bad")).filter("bad IS NOT NULL"), **settings
    ).withColumnRenamed("verdict", "by_template")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return urls.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, "by_template").alias("verdict"), "template", "bad_share",
    )

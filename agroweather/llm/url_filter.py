"""URL filter (operator 8).

Method: a path-template tree per host. Variable segments (numbers, hexadecimal
strings, long mixed strings) become wildcards; sibling branches whose rate of
blocked pages does not differ significantly from that of all labelled siblings
are merged into one wildcard branch; a template is rejected if the smoothed
share of blocked pages among its labelled ones, its purity, is high enough.
Labels are the pages a rule decides.

A template without labelled pages takes the purity of the nearest group of
templates that has some: those of its shape (literal segments as wildcards) on
its host, its host, then each parent host down to two labels. A group counts
only if its templates do not differ significantly from each other; the first
one with labelled pages ends the search, and each step towards it moves the
purity closer to the prior, so that far evidence alone rejects nothing.

All of it is grouping and joining of counts per template, which is far smaller
than the pages, in a number of jobs that does not depend on the depth of paths;
the counts are combined before they are shuffled, so a host with a third of all
pages is no single task.

A rule (host, path) fits its host and all subdomains if the page's path starts
with the rule's path; the longest fitting rule decides, else the template does.

Defined results: a NULL url, or one without ``://``, has an empty host and path
and, if no rule fits, is judged like any other host (allowed, as none of its
pages is labelled); repeated rows give repeated rows, each a page of its own in
the counts; a NULL page id stays NULL; an empty table gives an empty table;
further columns are not read. Of equally long fitting rules the later one in
the list decides. Branches of a host are told apart by a 64-bit hash of the
segments before them, templates by two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroweather.llm.common import lower_ascii, stored

# Host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# Prior share of blocked pages and its weight in pages.
PRIOR, PRIOR_WEIGHT = 0.1, 4.0
REJECT_FROM = 0.5
SIMILAR_Z = 1.96
# Share of a purity's distance from the prior that is left after one step to a wider group.
STEP = 0.8
# Parent hosts have at least so many labels.
LEAST_LABELS = 2


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    found = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return F.when(F.instr(url, "://") > 0, found).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    found = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, found).otherwise("")


def rule_columns(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, NULL where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda rule: len(rule[0] + rule[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(
            path, F.lit(rule_path)
        )
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def general_segments(path: Column) -> Column:
    """Non-empty path segments, variable ones as wildcards."""

    def general(segment: Column) -> Column:
        stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
        ending = F.substring(segment, F.length(stem) + 1, F.length(segment))
        return (
            F.when(stem.rlike(r"^[0-9]+$"), F.concat(F.lit("{number}"), ending))
            .when(stem.rlike(r"^[0-9a-fA-F-]{8,}$"), F.concat(F.lit("{hex}"), ending))
            .when(stem.rlike(r"[0-9]") & (F.length(stem) >= 12), F.concat(F.lit("{mixed}"), ending))
            .otherwise(lower_ascii(segment))
        )

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), general)


def merged_branches(leaves: DataFrame) -> DataFrame:
    """``leaves`` (host, template, labelled, blocked) with ``merged``, the template by merged branches.

    A labelled branch becomes ``*`` unless a two-proportion test tells its rate of
    blocked pages from that of its labelled siblings together; a branch without
    labelled pages becomes ``?``.
    """
    # one row per leaf and level: the segments before the level, hashed, and its own
    leaves = leaves.withColumn(
        "leaf", F.struct(F.xxhash64("host", "template").alias("h1"), F.xxhash64(F.lit(1), "host", "template").alias("h2"))
    )
    before = F.transform("template", lambda _, i: F.xxhash64(F.slice("template", 1, i)))
    levels = leaves.select(
        "host", "leaf", "labelled", "blocked", F.posexplode(F.arrays_zip(before.alias("parent"), F.col("template").alias("branch"))).alias("level", "at")
    ).select("host", "leaf", "labelled", "blocked", "level", "at.parent", "at.branch")
    place = ["host", "level", "parent"]
    nodes = levels.groupBy(*place, "branch").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    every = nodes.groupBy(*place).agg(F.sum("n").alias("n_all"), F.sum("b").alias("b_all"))
    pooled = F.col("b_all") / F.col("n_all")
    own = F.col("b") / F.col("n")
    spread = F.sqrt(pooled * (1 - pooled) * F.greatest(1 / F.col("n") - 1 / F.col("n_all"), F.lit(0.0)))
    name = (
        F.when(F.col("n") == 0, "?")
        .when(F.abs(own - pooled) <= SIMILAR_Z * spread + 1e-9, "*")
        .otherwise(F.col("branch"))
    )
    # stored, so that the joins know their sizes and can split a host with many templates
    names = stored(nodes.join(every, place).select(*place, "branch", name.alias("name")), "branches")
    merged = (
        levels.join(names, [*place, "branch"])
        .groupBy("leaf")
        .agg(F.array_sort(F.collect_list(F.struct("level", "name"))).alias("names"))
        .select("leaf", F.col("names.name").alias("merged"))
    )
    merged = leaves.join(merged, "leaf", "left").drop("leaf")
    return merged.withColumn("merged", F.coalesce("merged", F.array().cast("array<string>")))


def _smoothed(n: Column, b: Column) -> Column:
    return (b + PRIOR * PRIOR_WEIGHT) / (n + PRIOR_WEIGHT)


def group_evidence(groups: DataFrame, by: list[str], name: str) -> DataFrame:
    """Per labelled group of templates (rows ``n``, ``b``): its smoothed purity in ``name``.

    -1 stands for templates that differ: a chi-square statistic of their rates
    beyond its mean by more than ``SIMILAR_Z`` deviations.
    """
    found = (
        groups.where("n > 0")
        .groupBy(*by)
        .agg(
            F.sum("n").alias("n"),
            F.sum("b").alias("b"),
            F.sum(F.col("b") * F.col("b") / F.col("n")).alias("squares"),
            (F.count(F.lit(1)) - 1).alias("free"),
        )
    )
    rate = F.col("b") / F.col("n")
    spread = F.col("squares") - F.col("b") * rate
    most = (F.col("free") + SIMILAR_Z * F.sqrt(2.0 * F.col("free"))) * rate * (1 - rate)
    purity = F.when(spread <= most + 1e-9, _smoothed(F.col("n"), F.col("b"))).otherwise(-1.0)
    return found.select(*by, purity.alias(name))


def host_chain(host: Column) -> Column:
    """The host and its parents of ``LEAST_LABELS`` labels or more, nearest first."""
    labels = F.split(host, r"\.")
    parents = F.sequence(F.lit(2), F.greatest(F.size(labels) - LEAST_LABELS + 1, F.lit(2)))
    names = F.transform(parents, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(F.size(labels) > LEAST_LABELS, F.concat(F.array(host), names)).otherwise(F.array(host))


def host_evidence(groups: DataFrame) -> DataFrame:
    """Per host the nearest evidence of it and its parents: ``steps`` up and ``of_host``."""
    hosts = groups.select("host").distinct()
    reached = groups.where("n > 0").select(F.explode(host_chain(F.col("host"))).alias("at"), "n", "b")
    known = stored(group_evidence(reached, ["at"], "found"), "host-evidence")
    return (
        hosts.select("host", F.posexplode(host_chain(F.col("host"))).alias("steps", "at"))
        .join(known, "at")
        .groupBy("host")
        .agg(F.min_by(F.struct("steps", "found"), "steps").alias("nearest"))
        .select("host", F.col("nearest.steps").alias("steps"), F.col("nearest.found").alias("of_host"))
    )


def template_verdicts(pages: DataFrame) -> DataFrame:
    """Per host and template: its merged form, purity, steps to the evidence and verdict.

    ``steps`` is 0 for own labelled pages, 1 for the shape, 2 for the host, one more for
    each parent host, NULL where the prior stands alone.
    """
    blocked = F.sum((F.col("ruled") == "block").cast("long"))
    leaves = pages.groupBy("host", "template").agg(
        F.count("ruled").alias("labelled"), F.coalesce(blocked, F.lit(0)).alias("blocked")
    )
    shape = F.transform("merged", lambda name, i: F.when(F.col("template")[i].startswith("{"), F.col("template")[i]).otherwise("*"))
    leaves = stored(merged_branches(stored(leaves, "templates")).withColumn("shape", shape), "templates")
    own = leaves.groupBy("host", "merged").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    own = stored(own, "merged-templates")
    shapes = leaves.groupBy("host", "shape", "merged").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    judged = (
        leaves.join(own, ["host", "merged"])
        .join(stored(group_evidence(shapes, ["host", "shape"], "of_shape"), "shapes"), ["host", "shape"], "left")
        .join(stored(host_evidence(own), "hosts"), "host", "left")
    )
    steps = (
        F.when(F.col("n") > 0, 0)
        .when(F.col("of_shape") >= 0, 1)
        .when(F.col("of_shape").isNull() & (F.col("of_host") >= 0), F.col("steps") + 2)
    )
    found = (
        F.when(F.col("n") > 0, _smoothed(F.col("n"), F.col("b")))
        .when(F.col("of_shape").isNotNull(), F.col("of_shape"))
        .otherwise(F.col("of_host"))
    )
    near = F.pow(F.lit(STEP), F.col("away"))
    purity = F.when(F.col("away").isNull(), PRIOR).otherwise(PRIOR + near * (F.col("found") - PRIOR))
    return (
        judged.select("host", "template", "merged", steps.alias("away"), found.alias("found"))
        .select("host", "template", "merged", F.col("away").alias("steps"), purity.alias("purity"))
        .withColumn("judged", F.when(F.col("purity") >= REJECT_FROM, "block").otherwise("allow"))
    )


def filter_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``): host, path, rule, verdict, template, purity and steps."""
    parts = pages.select(
        F.col("page_id").cast("long"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    parts = parts.select(
        "page_id", "host", "path", rule.alias("rule"), ruled.alias("ruled"), general_segments(F.col("path")).alias("template")
    )
    judged = template_verdicts(parts)
    return parts.join(judged, ["host", "template"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", "judged").alias("verdict"),
        F.concat(F.lit("/"), F.array_join("merged", "/")).alias("template"),
        "purity",
        "steps",
    )

"""URL filters: host and path rules, and a path-template tree per host judged by smoothed labelled purity.

All steps are DataFrame functions. Pages are aggregated to distinct (host, path shape) first; the tree is built level by
level over these with partial aggregates, and only slim rows meet it again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, stage

#: (verdict, host, path): fits the host and its subdomains if the page's path starts with the rule's.
Rule = tuple[str, str, str]
RULES: list[Rule] = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: Smoothing: pseudo-counts of a template and the share of them that are allowed, and the purity below which it goes.
STRENGTH, PRIOR, LEAST = 4.0, 0.75, 0.5
#: A node with more children than this, each rarer than RARE of its pages, has a variable segment below it.
MANY, RARE = 12, 0.05
#: Critical value of the similarity test between a branch and its pool (chi-squared, two degrees of freedom, 1 %).
CRITICAL = 9.21


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; of equally long ones the first in text order. Null if none does."""
    chain, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        chain = F.when(fits, F.lit(rule_host + rule_path)).otherwise(chain)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return chain, verdict


def shape(segment: Column) -> Column:
    """A segment with its variable parts generalised: numbers, long hex strings, words mixed with digits."""
    number = F.regexp_replace(segment, r"^\d+(?=$|\.)", "<n>")
    code = F.regexp_replace(number, r"^(?=[0-9a-fA-F-]*\d)[0-9a-fA-F-]{8,}(?=$|\.)", "<x>")
    return F.when(code.rlike(r"\d"), F.regexp_replace(code, r"[^.<>]*\d[^.<>]*", "<m>")).otherwise(code)


def _key(*columns: Column) -> Column:
    return F.concat_ws("\u0001", *columns)


def judged_pages(pages: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Judges every url of ``pages`` (page_id, url): page_id, host, path, rule, verdict, template.

    The longest fitting rule decides. Rules are also the labels of the tree: per host, paths become templates whose
    numeric and coded segments are wildcards; nodes with many rare children get a wildcard below them; sibling branches
    whose shares of blocked and allowed pages are alike (by class and by a chi-squared test against the class) are merged.
    A page without a rule is blocked if its template's smoothed share of allowed labels is below LEAST, so a template
    without labels is allowed.

    The tree is as deep as two paths have a template in common: a path alone in its node keeps the rest of its segments.
    Each level takes a few jobs. Null urls and urls without ``://`` have an empty host and path and no template, and are
    allowed. Equal urls get equal answers. An empty table gives no rows.
    """
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumn("rule", rule).withColumn("ruled", verdict)
    parts = F.split(F.col("path"), "/")
    parsed = parsed.withColumn("segments", F.transform(F.slice(parts, F.lit(2), F.size(parts)), shape))
    parsed = stage(parsed.withColumn("leaf", _key(F.col("host"), F.array_join("segments", "/"))))

    ones = [F.count("*").alias("n"), F.count_if(F.col("ruled") == "block").alias("bad"), F.count_if(F.col("ruled") == "allow").alias("good")]
    tree = parsed.groupBy("leaf", "host", "segments").agg(*ones).withColumn("prefix", F.lit(""))
    tree = stage(tree, "merge")
    depth = tree.agg(F.max(F.size("segments"))).first()[0] or 0
    sums = [F.sum(c).alias(c) for c in ("n", "bad", "good")]
    ended = []
    for level in range(depth):
        keyed = tree.withColumn("node", _key(F.col("host"), F.col("prefix")))
        shared = stage(keyed.groupBy("node").agg(F.count("*").alias("leaves")), "merge")
        keyed = stage(lookup(keyed, shared, "node"), "merge")
        more = F.size("segments") > level
        rest = F.concat("prefix", F.lit("/"), F.array_join(F.slice("segments", level + 1, F.greatest(F.size("segments"), F.lit(1))), "/"))
        ended.append(keyed.where(~more | (F.col("leaves") == 1)).select("leaf", "host", "n", "bad", "good", F.when(more, rest).otherwise(F.col("prefix")).alias("prefix")))
        tree = keyed.where(more & (F.col("leaves") > 1)).drop("leaves", "node")
        if not tree.limit(1).count():
            break
        child = F.try_element_at(F.col("segments"), F.lit(level + 1))
        here = tree.withColumn("child", child).withColumn("node", _key(F.col("host"), F.col("prefix")))
        branches = here.groupBy("node", "child").agg(*sums)
        branches = stage(branches.withColumn("kind", _key(*(F.round(4 * F.col(c) / F.col("n")).cast("int").cast("string") for c in ("bad", "good")))), "merge")
        totals = branches.groupBy("node").agg(F.count("*").alias("kids"), F.sum("n").alias("all"))
        pools = branches.groupBy("node", "kind").agg(F.count("*").alias("alike"), *(F.sum(c).alias(f"pool_{c}") for c in ("n", "bad", "good")))
        sized = lookup(branches, stage(totals, "merge"), "node").withColumn("pool", _key(F.col("node"), F.col("kind")))
        sized = lookup(stage(sized, "merge"), stage(pools.select(_key(F.col("node"), F.col("kind")).alias("pool"), "alike", "pool_n", "pool_bad", "pool_good"), "merge"), "pool")

        def gap(value: Column, pool: Column) -> Column:
            expected = F.col("n") * (pool + 1.0) / (F.col("pool_n") + 3.0)
            return (value - expected) * (value - expected) / expected

        cells = [(F.col(c).cast("double"), F.col(f"pool_{c}")) for c in ("bad", "good")]
        cells.append((F.col("n") - F.col("bad") - F.col("good").cast("double"), F.col("pool_n") - F.col("pool_bad") - F.col("pool_good")))
        distance = reduce(lambda a, b: a + b, (gap(*c) for c in cells))
        variable = (F.col("kids") > MANY) & (F.col("n") <= F.greatest(F.lit(2.0), RARE * F.col("all")))
        merged = (F.col("alike") > 1) & (distance <= CRITICAL)
        name = F.when(variable, F.lit("*")).when(merged, F.concat(F.lit("*"), F.translate("kind", "\u0001", ""))).otherwise(F.col("child"))
        names = stage(sized.select(_key(F.col("node"), F.col("child")).alias("edge"), name.alias("name")), "merge")
        here = stage(here.withColumn("edge", _key(F.col("node"), F.col("child"))), "merge")
        found = lookup(here, names, "edge", "left")
        step = F.concat("prefix", F.lit("/"), F.coalesce("name", "child"))
        tree = stage(found.select("leaf", "host", "segments", "n", "bad", "good", step.alias("prefix")), "merge")

    tree = reduce(DataFrame.unionByName, [*ended, tree.select("leaf", "host", "n", "bad", "good", "prefix")])
    tree = tree.withColumn("node", _key(F.col("host"), F.col("prefix")))
    templates = tree.groupBy("node").agg(*sums)
    purity = (F.col("good") + STRENGTH * PRIOR) / (F.col("good") + F.col("bad") + STRENGTH)
    templates = stage(templates.select("node", F.when(purity < LEAST, F.lit("block")).otherwise(F.lit("allow")).alias("judged")), "merge")
    leaves = stage(lookup(tree.select("leaf", "node", "prefix"), templates, "node").select("leaf", F.col("prefix").alias("template"), "judged"), "merge")
    out = lookup(parsed, leaves, "leaf", "left")
    verdict = F.coalesce("ruled", "judged", F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("host") != "", F.col("template")).alias("template"))

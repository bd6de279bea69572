"""URL filters: a tree of path templates per host, judged by smoothed labelled purity.

A url's host is what stands after the first :// up to a slash, question mark, hash or the end, A-Z in lower case; its path
goes on from there to a question mark, a hash or the end. A null url, or one without ://, has an empty host and path.

Listed rules judge first: one fits its host and all subdomains, if the path starts with the rule's; the
longest wins. What they judge labels the tree, which judges the rest:

- A path is cut into segments. Numbers, long hexadecimal strings and the like become wildcards at once.
- From the root on, the children of a node are counted. Where most of many children are seen hardly more than
  once, the segment is variable, and they become one wildcard.
- Children whose share of blocked labels does not differ significantly from that of their siblings are
  merged; both need LEAST labels.
- A template's share of blocked labels is smoothed towards that of its parent branch, this towards its own, up to the
  host, and on over the host's parent domains to the overall share; so a branch without labels has the share of what is
  around it. On the way to a template a label counts once, on the lowest level that holds it. A template is
  blocked if the share reaches PURITY and is above the overall one; otherwise it is allowed.

The tree is built over distinct shapes with counts, so a host with a third of all pages shrinks before any join, and
the nodes of a level are aggregated over all tasks. A template has DEPTH segments; what lies deeper is one
wildcard of its own. Every page gets a verdict; repeated rows get equal ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.llm.shared import LOWER, UPPER, cut
from loadkeeper.operators.joins import spread_join

DEPTH = 6
#: More children than MANY, seen fewer than SELDOM times each on average, are one variable segment.
MANY, SELDOM = 16, 3
LEAST, SIGNIFICANT = 5, 1.96
PURITY, SMOOTHING = 0.8, 5.0
ANY, TAIL, SAME = "{any}", "{tail}", "{same}"


def host_of(url: Column) -> Column:
    """string: the host; empty for a null url or one without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """string: the path; empty for a null url or one without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """string: the longest of some rules (host and path start, verdict) that fits; null if none does."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, start = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def shape(path: Column) -> Column:
    """array<string>: the segments of a path, wildcards for what is plainly variable, at most DEPTH and a tail."""
    segments = F.slice(F.split(path, "/", -1), 2, DEPTH)

    def general(s: Column) -> Column:
        s = F.regexp_replace(s, "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "{uuid}")
        s = F.regexp_replace(s, "^(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{16,}(?![0-9a-zA-Z])", "{hex}")
        return F.regexp_replace(s, "[0-9]+", "{n}")

    return F.concat(F.transform(segments, general), F.when(F.size(F.split(path, "/", -1)) > DEPTH + 1, F.array(F.lit(TAIL))).otherwise(F.array().cast("array<string>")))


def _grown(tree: DataFrame, level: int) -> DataFrame:
    """tree(host, segments, template, n, labels, blocked) with the templates longer by one segment."""
    inner = tree.filter(F.size("segments") > level).withColumn("segment", F.get("segments", F.lit(level)))
    counted = inner.groupBy("host", "template", "segment").agg(*(F.sum(c).alias(c) for c in ("n", "labels", "blocked")))
    counted = cut(counted)
    nodes = counted.groupBy("host", "template").agg(
        F.count("*").alias("children"), *(F.sum(c).alias(f"all_{c}") for c in ("n", "labels", "blocked"))
    )
    rows = counted.join(cut(nodes), ["host", "template"])
    variable = (F.col("children") > MANY) & (F.col("all_n") < SELDOM * F.col("children"))
    others, own = F.col("all_labels") - F.col("labels"), F.col("labels")
    share = F.col("all_blocked") / F.col("all_labels")
    error = F.sqrt(share * (1 - share) * (1 / own + 1 / others))
    apart = F.abs(F.col("blocked") / own - (F.col("all_blocked") - F.col("blocked")) / others)
    alike = (own >= LEAST) & (others >= LEAST) & F.when((own >= LEAST) & (others >= LEAST), apart <= SIGNIFICANT * error).otherwise(False)
    name = F.when(variable, ANY).when(alike & (F.col("segment") != ""), SAME).otherwise(F.col("segment"))
    named = cut(rows.select("host", "template", "segment", F.concat("template", F.lit("/"), name).alias("longer")))
    longer = inner.join(named, ["host", "template", "segment"]).withColumn("template", F.col("longer")).select(*tree.columns)
    return cut(tree.filter(F.size("segments") <= level).unionByName(longer))


def _domains(host: Column) -> Column:
    """array<string>: the domains above a host, the widest first; none for a number address."""
    names = F.split(host, "\\.", -1)
    above = F.transform(F.sequence(F.size(names), F.lit(2), F.lit(-1)), lambda k: F.array_join(F.slice(names, k, F.size(names)), "."))
    return F.when((F.size(names) > 1) & ~host.rlike("^[0-9.]+(:[0-9]+)?$"), above).otherwise(F.array().cast("array<string>"))


def _smoothed(tree: DataFrame, prior: float) -> DataFrame:
    """(host, template, purity) for every template of tree(host, template, labels, blocked)."""
    sums = [F.sum(c).alias(c) for c in ("labels", "blocked")]
    judged = cut(tree.groupBy("host", "template").agg(*sums))
    hosts = judged.groupBy("host").agg(*sums)
    above = hosts.select("host", "labels", "blocked", F.posexplode(_domains(F.col("host"))).alias("level", "domain"))
    # a domain's labels are those of all hosts under it, and of the host of its own name
    own = hosts.select("labels", "blocked", F.explode(F.concat(_domains(F.col("host")), F.array("host"))).alias("domain"))
    domains = above.select("host", "level", "domain").join(cut(own.groupBy("domain").agg(*sums)), "domain")
    step = F.struct("level", "labels", "blocked")
    domains = domains.groupBy("host").agg(F.sort_array(F.collect_list(step)).alias("domains"))
    names = F.split("template", "/", -1)
    starts = F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.array_join(F.slice(names, 1, k), "/"))
    rows = judged.select("host", "template", "labels", "blocked", F.posexplode(starts).alias("level", "branch"))
    branches = rows.groupBy("host", "branch").agg(*sums)
    steps = rows.select("host", "template", "level", "branch").join(cut(branches), ["host", "branch"])
    steps = steps.groupBy("host", "template").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    way = F.concat(F.coalesce("domains", F.array().cast("array<struct<level:int,labels:bigint,blocked:bigint>>")), F.col("steps"))
    less = lambda s, i, c: s[c] - F.coalesce(F.get(way, i + 1)[c], F.lit(0))
    alone = F.transform(way, lambda s, i: F.struct(less(s, i, "labels").alias("labels"), less(s, i, "blocked").alias("blocked")))

    def nearer(share: Column, s: Column) -> Column:
        return F.when(s["labels"] > 0, (s["blocked"] + SMOOTHING * share) / (s["labels"] + SMOOTHING)).otherwise(share)

    rows = steps.join(domains, "host", "left")
    return rows.select("host", "template", F.aggregate(alone, F.lit(float(prior)), nearer).alias("purity"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, segments, template, purity, blocks) for every shape of pages(host, path, verdict); a null verdict is no label."""
    labels, blocked = F.count("verdict"), F.count(F.when(F.col("verdict") == "block", 1))
    shapes = pages.groupBy("host", shape(F.col("path")).alias("segments"))
    tree = cut(shapes.agg(F.lit("").alias("template"), F.count("*").alias("n"), labels.alias("labels"), blocked.alias("blocked")))
    overall = tree.agg(F.max(F.size("segments")).alias("depth"), F.sum("labels").alias("labels"), F.sum("blocked").alias("blocked")).first()
    for level in range(overall["depth"] or 0):
        tree = _grown(tree, level)
    prior = overall["blocked"] / overall["labels"] if overall["labels"] else 0.0
    judged = cut(_smoothed(tree, prior))
    return cut(tree.join(judged, ["host", "template"]).select("host", "segments", "template", "purity", ((F.col("purity") >= PURITY) & (F.col("purity") > prior)).alias("blocks")))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of pages(page_id, url)."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("segments", shape(F.col("path")))
    own = reduce(lambda out, r: F.when(F.col("rule") == r[0], F.lit(r[1])).otherwise(out), rules, F.lit(None).cast("string"))
    found = templates(rows.select("host", "path", own.alias("verdict")))
    # one host and shape may have a large share of all pages
    joined = spread_join(rows, found, ["host", "segments"], salt=F.hash("page_id", "path"), how="inner")
    verdict = F.coalesce(own, F.when(F.col("blocks"), "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")

"""URL filter: a tree of path templates per host, judged by the labelled pages below each."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.session import materialise

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Segments that look like ids: digits, long hexadecimal or uuid-like runs, with or without a file extension.
ID_LIKE = r"^(?:[0-9]+|[0-9A-Fa-f-]{16,})(?:\.[A-Za-z0-9]{1,5})?$"
#: Levels of the tree; deeper segments become one wildcard.
LEVELS = 4
#: A segment stays in a template if it has so many urls at least, and this share of its parent's.
LEAST_URLS, LEAST_SHARE = 2, 0.01
#: Sibling branches merge unless a rate of one differs from that of all by so many standard deviations.
DEVIATIONS = 2.5
#: Pages without a label, and so many more, count as the share of allowed pages over all hosts.
PRIOR_PAGES, REJECT_BELOW = 4.0, 0.3


class Rule(NamedTuple):
    allow: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query: host and path prefix.
RULES = (
    Rule(True, "com", "/"),
    Rule(False, "example.com", "/en/"),
    Rule(True, "www.example.com", "/en/"),
    Rule(False, "net", "/es/"),
    Rule(False, "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, URL, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits a host, or a host above it, and the beginning of the path."""
    name, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, allow = F.when(fits, rule.name).otherwise(name), F.when(fits, F.lit(rule.allow)).otherwise(allow)
    return name, allow


def _apart(part: Column, n: Column, whole: Column, total: Column) -> Column:
    rate = whole / total
    off = F.abs(part / n - rate)
    return (off > 0) & (off > F.sqrt(rate * (1 - rate) / n) * DEVIATIONS)


def templates(paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Give each (host, path, n, allowed, blocked) row the template of its path.

    Level by level, a segment that looks like an id, or is rare under its parent, becomes ``*``. The others stay if
    their branch stands out from all such branches of the parent together, in its share of allowed, of blocked or of
    ending pages; those that do not are merged into one ``*`` branch. Each level counts by (host, template so far,
    segment), so a large host is added up in every task before anything is sent.
    """
    state = paths.withColumn("__segments", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("template", F.lit(""))
    state = materialise(state, "url-paths")
    depth = state.agg(F.max(F.size("__segments")).alias("d")).first().d or 0
    for level in range(min(levels, depth)):
        segment = F.get("__segments", F.lit(level))
        wide = state.withColumn("__segment", F.when(segment.rlike(ID_LIKE), F.lit("*")).otherwise(segment))
        ends = F.when(F.size("__segments") == level + 1, F.col("n")).otherwise(F.lit(0).cast("long"))
        sums = [F.sum("n").alias("n"), F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")]
        branches = wide.where(F.col("__segment").isNotNull()).groupBy("host", "template", "__segment").agg(*sums, F.sum(ends).alias("ends"))
        branches = materialise(branches, "url-branches")
        parents = branches.groupBy("host", "template").agg(F.sum("n").alias("__all"))
        parents = materialise(parents, "url-parents")
        usual = branches.where(F.col("__segment") != "*").join(parents, ["host", "template"])
        usual = usual.where((F.col("n") >= LEAST_URLS) & (F.col("n") >= F.col("__all") * LEAST_SHARE))
        names = ("n", "allowed", "blocked", "ends")
        pooled = usual.groupBy("host", "template").agg(*[F.sum(c).alias(f"__{c}") for c in names])
        stands_out = F.lit(False)
        for c in names[1:]:
            stands_out = stands_out | _apart(F.col(c), F.col("n"), F.col(f"__{c}"), F.col("__n"))
        kept = usual.join(pooled, ["host", "template"]).where(stands_out)
        kept = materialise(kept.select("host", "template", "__segment", F.lit(True).alias("__kept")), "url-kept")
        named = F.when(F.col("__kept"), F.col("__segment")).when(F.col("__segment").isNotNull(), "*")
        state = wide.join(kept, ["host", "template", "__segment"], "left").select(
            *paths.columns, "__segments", F.concat("template", F.coalesce(F.concat(F.lit("/"), named), F.lit(""))).alias("template"))
        state = materialise(state, "url-templates")
    rest = F.when(F.size("__segments") > levels, "/**").otherwise("")
    return state.select(*paths.columns, F.concat("template", rest).alias("template"))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Id, ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict`` of each page.

    Pages that a rule decides are the labels. A template is rejected if its purity, the share of allowed pages
    with unlabelled ones and a few more counted as the share over all hosts, is too low: it takes labelled pages that are mostly
    blocked to reject the unlabelled ones beside them. A url that is null or has no ``://`` has an empty host and path, and is judged
    with all such. Without any label everything is allowed. Repeated rows get the same verdict; further columns
    are ignored; an empty table gives an empty table.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    parsed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, allow = rule_for(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumn("rule", rule).withColumn("__allow", allow)
    count = [F.count(F.lit(1)).alias("n"), F.count_if("__allow").alias("allowed"), F.count_if(~F.col("__allow")).alias("blocked")]
    placed = templates(parsed.groupBy("host", "path").agg(*count))
    sums = placed.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "allowed", "blocked")])
    sums = materialise(sums, "url-sums")
    total = sums.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    allowed, blocked = total.a or 0, total.b or 0
    prior = F.lit(allowed / (allowed + blocked) if allowed + blocked else 1.0)
    unlabelled = F.col("n") - F.col("allowed") - F.col("blocked")
    purity = (F.col("allowed") + (unlabelled + PRIOR_PAGES) * prior) / (F.col("n") + PRIOR_PAGES)
    sums = materialise(sums.select("host", "template", purity.alias("purity")), "url-purity")
    found = materialise(placed.join(sums, ["host", "template"]).select("host", "path", "template", "purity"), "url-verdicts")
    verdict = F.when(F.col("__allow"), "allow").when(~F.col("__allow"), "block").when(F.col("purity") < REJECT_BELOW, "block").otherwise("allow")
    return parsed.join(found, ["host", "path"]).select(id_col, "host", "path", "rule", "template", "purity", verdict.alias("verdict"))

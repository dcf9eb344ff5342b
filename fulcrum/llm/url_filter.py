"""URL filter: rules on host and path, and link-graph propagation for the urls without a rule.

A rule fits its host and all subdomains if the url's path starts with the rule's path; the
longest rule wins and its verdict stands.  Pages under an allowing rule make their host a
trusted seed, pages under a blocking rule a distrusted one (weight: number of such pages).
Trust is a personalised PageRank along the links between hosts, distrust one against their
direction: who links to blocked hosts shares in their distrust.  A host whose distrust is more
than ``BLOCK_SHARE`` of both blocks its remaining pages; a host without either is allowed.

Pages are reduced to one row per pair of linked hosts, map-side first.  Each step is one join
of the ranks with the links and one sum per host; ranks are written after each step, so
lineage stays flat, a lost executor costs one step, and both sides of the next join are
exchanges that AQE can split at a hot host.

Defined results: a null url, or one without ``://``, has an empty host and path, gets no
rule, gives no link and is allowed; a link without a host points to its own host and counts
for nothing; repeated rows count as often as they occur; a null or empty html has no link, and a very long
one is read whole; equally long rules that fit are one rule; an empty table gives an empty result; other
columns are not read.  Mass of hosts without links returns to the seeds.

Ranks are carried as pages, not as shares: a host starts with its seed pages and gets the
damped ranks of those that link to it, so a neighbourhood's ranks don't depend on the size
of the crawl; the shares are taken at the end.  (Mass returned to the seeds only scales all
ranks alike.)  Ranks keep their first 40 bits, whatever their size, so the sums' order
doesn't show.  Steps end when no host's rank grows by more than ``TOLERANCE`` of itself, a
host reached for the first time included, so the links' depth isn't bounded; ``MOST_STEPS``
is only a safety stop, and a warning tells when it is met.  Below 1e-308 pages, some 170
links of 1/50 away from all seeds, a rank is 0.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulcrum.llm.scratch import Scratch

DAMPING = 0.85
#: Growth of a host's rank, as a share of it, below which it is settled; what later steps
#: would add in all is about six times that.
TOLERANCE = 1e-6
MOST_STEPS = 1000
BLOCK_SHARE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    host: str
    path: str


#: The fixed rules of the registered query.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def _lower(host: Column) -> Column:
    return F.translate(host, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, _SPLIT, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts."""
    targets = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1))
    named = F.transform(targets, lambda t: host_of(F.regexp_replace(t, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", "x://")))
    return (
        pages.select(host_of(F.col("url")).alias("src"), named.alias("_to"))
        .where(F.col("src") != "")
        .select("src", F.explode("_to").alias("dst"))
        .where((F.col("dst") != "") & (F.col("dst") != F.col("src")))
        .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    )


def _leading_bits(x: Column) -> Column:
    """``x`` rounded to its first 40 bits (Veltkamp's split)."""
    c = x * F.lit(float(2 ** 13 + 1))
    return c - (c - x)


def host_ranks(links: DataFrame, seeds: DataFrame, scratch: Scratch, damping: float = DAMPING,
               most_steps: int = MOST_STEPS) -> DataFrame:
    """(host, trust, distrust) of every host in ``seeds`` (host, allowed, blocked: page
    counts) or ``links`` (src, dst, n), each column summing to 1 if it has a seed."""
    # both directions in one table: trust runs along the links, distrust against them
    ways = (links.select(F.lit(0).alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n")
            .unionByName(links.select(F.lit(1).alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "n")))
    out = ways.groupBy("kind", "a").agg(F.sum("n").alias("total"))
    edges = scratch.write(
        ways.join(out, ["kind", "a"]).select("kind", "a", "b", (F.col("n") / F.col("total")).alias("part")), "edges")
    start = F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(c).cast("double").alias("seed")) for k, c in enumerate(("allowed", "blocked"))]))
    base = seeds.select("host", start.alias("s")).select("host", "s.kind", "s.seed")
    base = scratch.write(base.where(F.col("seed") > 0), "seeds")
    ranks = base.withColumnRenamed("seed", "rank")
    none = F.lit(0.0)
    for nr in range(most_steps if edges.limit(1).count() else 0):
        moved = (
            ranks.select("kind", F.col("host").alias("a"), "rank").join(edges, ["kind", "a"])
            .groupBy("kind", F.col("b").alias("host")).agg((F.lit(damping) * F.sum(F.col("rank") * F.col("part"))).alias("rank")))
        step = (moved.select("kind", "host", "rank", none.alias("before"))
                .unionByName(base.select("kind", "host", F.col("seed").alias("rank"), none.alias("before")))
                .unionByName(ranks.select("kind", "host", none.alias("rank"), F.col("rank").alias("before")))
                .groupBy("kind", "host").agg(_leading_bits(F.sum("rank")).alias("rank"), F.sum("before").alias("before")))
        old, ranks = ranks, scratch.write(step, "ranks")
        if nr:
            scratch.remove(old)
        growing = F.abs(F.col("rank") - F.col("before")) > F.lit(TOLERANCE) * F.col("rank")
        if not ranks.where(growing).limit(1).count():
            break
        if nr == most_steps - 1:
            warnings.warn(f"host ranks still grow by more than {TOLERANCE} of themselves after {most_steps} steps", stacklevel=2)
    total = {r.kind: r.total for r in ranks.groupBy("kind").agg(F.sum("rank").alias("total")).collect()}
    side = lambda kind: F.sum(
        F.when(F.col("kind") == kind, F.col("rank") / F.lit(total.get(kind, 1.0))).otherwise(none))
    return scratch.write(ranks.groupBy("host").agg(side(0).alias("trust"), side(1).alias("distrust")), "hosts")


def filter_urls(pages: DataFrame, scratch: Scratch, rules: tuple[UrlRule, ...] = RULES,
                block_share: float = BLOCK_SHARE) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust."""
    judged = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    under = lambda verdict: F.count(F.when(F.col("_rule.verdict") == verdict, 1))
    seeds = judged.where("host <> ''").groupBy("host").agg(under("allow").alias("allowed"), under("block").alias("blocked"))
    hosts = host_ranks(host_links(pages), seeds, scratch).withColumnRenamed("host", "_h")
    bad = F.col("distrust") > F.lit(block_share) * (F.col("trust") + F.col("distrust"))
    return judged.join(hosts, F.col("host") == F.col("_h"), "left").select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(bad, F.lit("block")), F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))

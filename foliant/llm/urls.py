"""URL filter: rules, and link-graph propagation for hosts without one (DataFrame functions only).

Hosts are nodes, links between pages of different hosts are edges.  Trust starts at
hosts with pages that a rule allows and follows links forward; distrust starts at hosts
with blocked pages and follows links backward (whoever links to a blocked host).  Both
are personalised PageRank vectors, computed in rounds as one join and one aggregation
over (direction, host) edges until they no longer move.  A host whose share of distrust in the sum of both exceeds
``threshold`` is blocked, every other host is allowed.

Defined results for odd input: a null URL or one without ``://`` has an empty host and
path, fits no rule and is allowed; a null html has no links; repeated rows each get
their row back; a very long URL or page is read as a whole; a host with equal shares is allowed; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read_table


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)
LINK = "(?i)\\bhref\\s*=\\s*[\"']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\\s<>]+)"
DAMPING, THRESHOLD = 0.85, 0.5
#: Rounds end when the scores of a kind move by no more than this in all.
TOLERANCE = 1e-4


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does."""
    out = None
    for r in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        hit = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out


def host_scores(pages: DataFrame, links: DataFrame, *, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``host, trust, distrust`` for each host that either reaches; each sums to one.

    ``pages``: host, verdict (of its rule, may be null); ``links``: src, dst hosts.  What hosts without links
    would pass on returns to the seeds.  A round moves scores by at most ``damping`` times the last, so
    the number of rounds follows from the tolerance.
    """
    seeds = (
        pages.filter(F.col("verdict").isNotNull() & (F.col("host") != ""))
        .groupBy(F.col("host").alias("node"), F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = seeds.groupBy("kind").agg(F.sum("n").alias("all"))
    seeds = cut(seeds.join(F.broadcast(total), "kind").select("kind", "node", (F.col("n") / F.col("all")).alias("mass")), "url-seeds")
    pairs = links.filter((F.col("src") != F.col("dst")) & (F.col("src") != "") & (F.col("dst") != "")).distinct()
    both = pairs.select(F.lit("trust").alias("kind"), F.col("src").alias("node"), F.col("dst").alias("to")).unionByName(
        pairs.select(F.lit("distrust").alias("kind"), F.col("dst").alias("node"), F.col("src").alias("to"))
    )
    edges = cut(both, "url-edges")
    degree = edges.groupBy("kind", "node").agg(F.count(F.lit(1)).alias("degree"))
    rank = seeds
    # Without edges the vectors are the seeds: no rounds are needed.
    rounds = 0 if edges.isEmpty() else math.ceil(math.log(tolerance / 2) / math.log(damping))
    if rounds:
        edges = cut(edges.join(degree, ["kind", "node"]), "url-weighted")
    for k in range(rounds):
        passed = edges.join(rank, ["kind", "node"]).groupBy("kind", F.col("to").alias("node"))
        passed = cut(passed.agg((damping * F.sum(F.col("mass") / F.col("degree"))).alias("mass")), f"url-passed-{k}")
        # Two rows: what is left over of each kind.
        left = seeds.select("kind").distinct().join(passed.groupBy("kind").agg(F.sum("mass").alias("moved")), "kind", "left")
        back = seeds.join(F.broadcast(left), "kind").select("kind", "node", (F.col("mass") * (1 - F.coalesce("moved", F.lit(0.0)))).alias("mass"))
        fresh = cut(back.unionByName(passed).groupBy("kind", "node").agg(F.sum("mass").alias("mass")), f"url-rank-{k}")
        moved = fresh.unionByName(rank.withColumn("mass", -F.col("mass"))).groupBy("kind", "node").agg(F.abs(F.sum("mass")).alias("d"))
        rank = fresh
        if (moved.groupBy("kind").agg(F.sum("d").alias("d")).agg(F.max("d")).first()[0] or 0.0) <= tolerance:
            break
    share = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)).alias(kind)
    return rank.groupBy(F.col("node").alias("host")).agg(share("trust"), share("distrust"))


def judge(pages: DataFrame, *, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the two scores, one row per page."""
    parsed = pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parsed = parsed.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    links = (
        parsed.filter(F.col("html").contains("//"))
        .select(F.col("host").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("to"))
        .select("src", ascii_lower(F.col("to")).alias("dst"))
        .distinct()
    )
    scores = host_scores(parsed.select("host", F.col("r.verdict").alias("verdict")), links)
    bad = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    method = F.when(F.coalesce(bad, F.lit(False)), "block").otherwise("allow")
    return (
        parsed.drop("html")
        .join(scores, "host", "left")
        .select(
            "page_id", "host", "path", F.col("r.rule").alias("rule"),
            F.coalesce(F.col("r.verdict"), method).alias("verdict"), "trust", "distrust",
        )
    )


def op10_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return judge(read_table(spark, sf_dir, "pages"))

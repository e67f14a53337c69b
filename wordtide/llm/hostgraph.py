"""URL filter: longest host/path rule, else link-graph propagation over host edges.

Trust is personalised PageRank from the hosts of pages that rules allow; distrust is the same walk
over reversed edges from the hosts of pages that rules block, because who links to bad hosts is
suspect. Restarts count: a host with seeds of its own is trusted or distrusted without any link. What
reaches hosts without out-links returns to the seeds, so both rankings sum to 1. Rounds end when the
ranks move by less than ``TOLERANCE`` in all. A page without a rule is blocked where its host's
distrust makes more than ``THRESHOLD`` of its distrust and trust together; hosts that no walk reaches
are allowed.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and the
verdict allow; relative links stay on their host and carry no edge; repeated links count once per
page and host pair; a null html has no links; an empty table gives an empty result; other columns
are not read, and own columns live in fresh projections, so equal names do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialise

#: (verdict, host, path) of each rule.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING = 0.85
TOLERANCE = 1e-6
#: More rounds than the tolerance can need: 0.85 ** 120 < 1e-8.
ROUNDS = 120
THRESHOLD = 0.5
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]++)"""


def host_of(url):
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url):
    """What follows the host, up to ``?``, ``#`` or the end."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_hit(host, path, rules=RULES):
    """The longest fitting rule as a struct (name, verdict), null where none fits. A rule fits its
    host and all subdomains of it if the path starts with the rule's path."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("name"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst, n) between different hosts, n the number of pages that link."""
    links = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1), lambda u: host_of(F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u))))
    return (
        pages.select(host_of(F.col("url")).alias("src"), F.explode(links).alias("dst"))
        .where("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("n"))
    )


def seeds(pages: DataFrame, verdict: str, rules=RULES) -> DataFrame:
    """Seed hosts of that verdict: (host, seed), by the number of pages that a rule gives it,
    the seeds summing to 1."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    chosen = (
        pages.select(host.alias("host"), rule_hit(host, path, rules)["verdict"].alias("v"))
        .where(F.col("v") == verdict)
        .groupBy("host")
        .agg(F.count("*").alias("n"))
    )
    total = chosen.agg(F.sum("n").alias("all"))  # one row
    return chosen.crossJoin(F.broadcast(total)).select("host", (F.col("n") / F.col("all")).alias("seed"))


def propagate(edges: DataFrame, start: DataFrame, hosts: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of ``edges(src, dst, n)`` from ``start(host, seed)``: (host, rank), the
    ranks summing to 1 where there are seeds.

    To return the mass of hosts without out-links to the seeds only scales all ranks, so it is done
    once, by their sum, at the end.
    """
    base = materialise(hosts.join(start, "host", "left").select("host", F.coalesce("seed", F.lit(0.0)).alias("seed")), "host-seeds")
    if edges.isEmpty():
        return base.select("host", F.col("seed").alias("rank"))
    out = edges.groupBy("src").agg(F.sum("n").alias("all"))
    shares = materialise(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share")), "host-shares")
    ranks = base.select("host", ((1 - damping) * F.col("seed")).alias("rank"))
    for _ in range(ROUNDS):
        flow = (
            shares.join(ranks.select(F.col("host").alias("src"), "rank"), "src")
            .groupBy(F.col("dst").alias("host"))
            .agg(F.sum(F.col("share") * F.col("rank")).alias("flow"))
        )
        fresh = base.join(flow, "host", "left").select("host", ((1 - damping) * F.col("seed") + damping * F.coalesce("flow", F.lit(0.0))).alias("rank"))
        table = materialise(fresh.join(ranks.select("host", F.col("rank").alias("was")), "host"), "host-ranks")
        moved, mass = table.agg(F.sum(F.abs(F.col("rank") - F.col("was"))), F.sum("rank")).first()
        old, ranks = ranks, table
        forget(old)
        if not mass or moved < tolerance * mass:
            break
    total = ranks.agg(F.sum("rank").alias("all"))  # one row
    return ranks.crossJoin(F.broadcast(total)).select("host", F.coalesce(F.try_divide("rank", "all"), F.lit(0.0)).alias("rank"))


def host_verdicts(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per host of pages or links: host, trust, distrust, verdict."""
    edges = materialise(host_edges(pages), "host-edges")
    hosts = materialise(
        pages.select(host_of(F.col("url")).alias("host"))
        .where("host <> ''")
        .union(edges.select("src"))
        .union(edges.select("dst"))
        .distinct(),
        "hosts",
    )
    trust = propagate(edges, seeds(pages, "allow", rules), hosts)
    reverse = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(reverse, seeds(pages, "block", rules), hosts)
    bad = F.coalesce(F.try_divide(F.col("distrust"), F.col("trust") + F.col("distrust")), F.lit(0.0))
    return (
        trust.withColumnRenamed("rank", "trust")
        .join(distrust.withColumnRenamed("rank", "distrust"), "host")
        .select("host", "trust", "distrust", F.when(bad > threshold, "block").otherwise("allow").alias("host_verdict"))
    )


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages(page_id, url, html)`` -> page_id, host, path, rule, verdict, trust, distrust."""
    hosts = materialise(host_verdicts(pages, rules), "host-verdicts")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hit = rows.withColumn("hit", rule_hit(F.col("host"), F.col("path"), rules))
    return hit.join(hosts, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("hit.name").alias("rule"),
        F.coalesce("hit.verdict", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )

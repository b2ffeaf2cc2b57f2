"""URL filters: fixed rules, and trust and distrust propagated over host links.

A rule names a host and a path prefix; it fits the host and its subdomains, and
the longest fitting rule decides.  Where none fits, the host graph decides.
Pages under an allow rule are trusted seeds, pages under a block rule distrusted
ones.  Personalised PageRank carries trust along links between hosts and
distrust against them (who links to blocked hosts is suspect).  In both
directions a second vector starts from all pages of a host, so the ratio of the
two lies between 0 and 1 and can be compared between hosts of any size.  A host
is blocked if its share of distrust reaches the threshold and exceeds its share
of trust.

A link is an ``href`` with a host; links within a host carry nothing, and a host
without links to others keeps its mass.  Everything is DataFrame functions; each
step of the iteration is a written table of one row per host and direction.

Edge cases: a null url, or one without ``://``, has empty host and path, and the
empty host is a host like any other.  Null html has no links.  Repeated pages
count each.  Links to hosts without pages are followed too.  Extra columns are
dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearlex.session import broadcast_if_small, stage

#: (host, path, verdict)
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
DAMPING = 0.85
STEPS = 30
#: Largest change of a share of all mass at which the iteration ends.
TOLERANCE = 1e-9
#: Share of distrust from which a host is blocked.
THRESHOLD = 0.25
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"(?i)\bhref\s*=\s*[\"']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\"'\s>]+)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A to Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Add host, path, and the rule that decides with its verdict (both null if none fits)."""
    out = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    decided = F.lit(None).cast("struct<rule:string,ruled:string>")
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        decided = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("ruled"))).otherwise(decided)
    return out.withColumn("_rule", decided).select("*", "_rule.rule", "_rule.ruled").drop("_rule")


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, n): links between different hosts, added up."""
    found = F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER))
    return (
        pages.select(F.col("host").alias("source"), F.explode(found).alias("target"))
        .filter("source <> target")
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def propagated(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, steps: int = STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust): shares of each host's mass that come from seeds, 0 to 1.

    ``seeds`` has host, pages, allowed, blocked; ``links`` has source, target, n.
    Rows of the working table are (host, way, seeded, whole): ``way`` 0 follows
    the links with trust, 1 goes against them with distrust.
    """
    both = links.select(F.lit(0).alias("way"), "source", "target", "n").union(
        links.select(F.lit(1).alias("way"), F.col("target").alias("source"), F.col("source").alias("target"), "n")
    )
    out = both.groupBy("way", "source").agg(F.sum("n").alias("all"))
    edges = stage(both.join(out, ["way", "source"]).select("way", "source", "target", (F.col("n") / F.col("all")).alias("share")), "edges")
    total = float(seeds.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0] or 1)
    known = seeds.unionByName(
        links.select(F.explode(F.array("source", "target")).alias("host")).distinct().select(
            "host", *[F.lit(0).cast("long").alias(c) for c in ("pages", "allowed", "blocked")]
        )
    ).groupBy("host").agg(*[F.sum(c).alias(c) for c in ("pages", "allowed", "blocked")])
    base = stage(
        known.select("host", F.explode(F.array(F.lit(0), F.lit(1))).alias("way"), "pages", "allowed", "blocked")
        .join(edges.select("way", F.col("source").alias("host"), F.lit(True).alias("links")).distinct(), ["way", "host"], "left")
        .select(
            "way", "host", (F.when(F.col("way") == 0, F.col("allowed")).otherwise(F.col("blocked")) / F.lit(total)).alias("seed"),
            (F.col("pages") / F.lit(total)).alias("start"), F.coalesce("links", F.lit(False)).alias("links"),
        ),
        "hosts",
    )
    now = base.select("way", "host", F.col("seed").alias("seeded"), F.col("start").alias("whole"))
    for _ in range(steps):
        sent = (
            edges.join(now.withColumnRenamed("host", "source"), ["way", "source"])
            .groupBy("way", F.col("target").alias("host"))
            .agg(F.sum(F.col("seeded") * F.col("share")).alias("in_seeded"), F.sum(F.col("whole") * F.col("share")).alias("in_whole"))
        )
        keep = F.when(F.col("links"), F.lit(0.0)).otherwise(F.lit(1.0))
        received = lambda name: F.coalesce("in_" + name, F.lit(0.0)) + keep * F.col(name)
        after = stage(
            base.join(now, ["way", "host"]).join(sent, ["way", "host"], "left").select(
                "way", "host",
                ((1 - damping) * F.col("seed") + damping * received("seeded")).alias("new_seeded"),
                ((1 - damping) * F.col("start") + damping * received("whole")).alias("new_whole"),
                (F.abs((1 - damping) * F.col("start") + damping * received("whole") - F.col("whole"))
                 + F.abs((1 - damping) * F.col("seed") + damping * received("seeded") - F.col("seeded"))).alias("change"),
            ),
            "rank",
        )
        now = after.select("way", "host", F.col("new_seeded").alias("seeded"), F.col("new_whole").alias("whole"))
        if (after.agg(F.max("change")).first()[0] or 0.0) <= tolerance:
            break
    share = F.when(F.col("whole") > 0, F.col("seeded") / F.col("whole")).otherwise(0.0)
    return now.groupBy("host").agg(
        F.max(F.when(F.col("way") == 0, share).otherwise(0.0)).alias("trust"),
        F.max(F.when(F.col("way") == 1, share).otherwise(0.0)).alias("distrust"),
    )


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row of ``pages``."""
    own = with_rules(pages.select("page_id", "url", "html"), rules)
    links = stage(host_links(own), "links")
    ruled = stage(own.select("page_id", "host", "path", "rule", "ruled"), "ruled")
    seeds = ruled.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("ruled") == "allow").alias("allowed"),
        F.count_if(F.col("ruled") == "block").alias("blocked"),
    )
    hosts = stage(propagated(seeds, links), "trust").withColumnRenamed("host", "_host")
    bad = (F.round("distrust", 6) >= threshold) & (F.round("distrust", 6) > F.round("trust", 6))
    return ruled.join(broadcast_if_small(hosts), F.col("host") == F.col("_host")).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust",
    )


def query(pages: DataFrame) -> DataFrame:
    return judged(pages).select("page_id", "host", "path", "rule", "verdict")

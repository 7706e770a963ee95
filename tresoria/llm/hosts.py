"""URL filter: rules, and trust propagated over the host graph where none fits.

A page whose URL a rule fits takes the longest rule's verdict.  The other pages
take their host's: personalised PageRank flows from trusted hosts (with allowed
pages) along host edges, distrust flows from blocked hosts against them, and the
host is blocked when distrust dominates.  Edges are the absolute links of the
pages, and each host's tie to the domains above it, so that a site's hosts share
their standing.

Rank flows until what is still on its way is too little to matter, however far
that is from the seeds: see ``propagate``.

Scale: pages are reduced to (host, host, count) by partial counts before any
shuffle; ranks and edges meet on host keys; only the final join reads pages
again, without their text, and a hot host there is split by Spark's skew join.
Every few steps the ranks are written to the shared folder, and a few sums a kind
go to the driver.

Defined results: a null URL, or one without ``://``, has an empty host and path,
no rule and the verdict ``allow``; null ids stay; repeated rows are judged each;
null html has no links; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tresoria.session import materialize

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*[a-z][a-z0-9+.-]*://([^/?#"'\s<>]+)"""

DAMPING = 0.85
#: rank of a kind that may be left unsettled: as a part of an even share, and at most
TOLERANCE, SETTLED = 1e-3, 1e-9
#: so many steps settle all but ``SETTLED`` on any graph; the loop goes by what is left
STEPS = math.ceil(math.log(SETTLED) / math.log(DAMPING))
#: steps of a round, after which the ranks are written
ROUND = 8
#: least share of distrust in a host's trust and distrust, and least rank, to block it
BLOCK_SHARE = 0.5


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for a null URL or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return (_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)),
            F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) between different hosts, from ``pages`` (host, html)."""
    out = pages.select("host", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("to"))
    links = out.select(F.col("host").alias("src"), _lower(F.col("to")).alias("dst")).filter("src <> '' and dst <> ''")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n"))
    hosts = links.select(F.explode(F.array("src", "dst")).alias("host")).union(
        pages.filter("host <> ''").select("host")).distinct()
    labels = F.split("host", r"\.")
    # a host and each domain above it, down to two labels, both ways
    above = hosts.select("host", F.explode(F.filter(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")),
        lambda d: (F.size(F.split(d, r"\.")) >= 2) & (d != F.col("host")))).alias("domain"))
    ties = above.select(F.col("host").alias("src"), F.col("domain").alias("dst"), F.lit(1.0).alias("n"))
    back = above.select(F.col("domain").alias("src"), F.col("host").alias("dst"), F.lit(1.0).alias("n"))
    every = links.union(ties).union(back).filter("src <> dst")
    return every.groupBy("src", "dst").agg(F.sum("n").alias("n"))


def _least_left(products: np.ndarray) -> np.ndarray:
    """The weights of k0, k1, ... that leave least, by the products of k0 to the last."""
    n = len(products) - 1
    used = np.eye(n + 1, n) - np.eye(n + 1, n, -1)  # adding a k takes it and leaves the next
    return np.linalg.lstsq(used.T @ products @ used, used.T @ products[:, 0], rcond=1e-13)[0]


def _weighted(ks: list[str], weights: np.ndarray) -> Column:
    return sum((F.col(k) * float(c) for k, c in zip(ks, weights)), F.lit(0.0))


def _left(ks: list[str], weights: np.ndarray) -> Column:
    """What is still to be passed on once the weighted ``ks`` are added."""
    return sum(((F.col(b) - F.col(a)) * float(c) for a, b, c in zip(ks, ks[1:], weights)), F.col(ks[0]))


def propagate(edges: DataFrame, seeds: DataFrame, n_hosts: int, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) from ``seeds`` (host, kind, w): kind 0 is trust and
    goes along the edges, kind 1 is distrust and goes against them.  The weights
    of a kind are scaled to one; a host that nothing reaches is missing.

    A round takes ``ROUND`` steps: ``r`` is the rank so far, ``k0`` what is still to
    be passed on, ``k1`` that after one step, and so on.  Adding k0 to k7 leaves k8;
    other weights may leave less (least squares, from the sums of products), and of
    the two the one with the smaller summed size is taken.  A step passes on
    ``damping`` at most, so a round leaves damping ** ROUND or less, and ranks are off
    by the summed size / (1 - damping) at most: the loop ends when that is small."""
    way = edges.select(F.lit(0).alias("kind"), "src", "dst", "n").union(
        edges.select(F.lit(1).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    out = way.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    way = way.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total") * damping).alias("p"),
                                                F.lit(0.0).alias("stay"))
    total = seeds.groupBy("kind").agg(F.sum("w").alias("total"))
    rank = materialize(seeds.join(F.broadcast(total), "kind").select(  # two rows
        "kind", "host", F.lit(0.0).alias("r"), (F.col("w") / F.col("total") * (1 - damping)).alias("k0")), "host-seeds")
    # a host also keeps what it has: an edge to itself
    nodes = way.select("kind", F.explode(F.array("src", "dst")).alias("src")).union(rank.select("kind", "host")).distinct()
    way = materialize(way.union(nodes.select("kind", "src", F.col("src").alias("dst"), F.lit(0.0).alias("p"),
                                             F.lit(1.0).alias("stay"))), "host-edges")
    least = min(TOLERANCE / max(1, n_hosts), SETTLED)
    ks = [f"k{i}" for i in range(ROUND + 1)]
    power = np.ones(ROUND)
    while True:
        for i in range(ROUND):
            kept, new = ["r", *ks[:i + 1]], F.col(ks[i]) * F.col("p")
            moved = rank.join(way, (rank["kind"] == way["kind"]) & (rank["host"] == way["src"])).select(
                rank["kind"], F.col("dst").alias("host"), *[(F.col(c) * F.col("stay")).alias(c) for c in kept], new.alias(ks[i + 1]))
            rank = moved.groupBy("kind", "host").agg(*[F.sum(c).alias(c) for c in [*kept, ks[i + 1]]])
        rank = materialize(rank, "host-ranks")
        products = rank.groupBy("kind").agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a in ks for b in ks if a <= b]).collect()
        weights = {x["kind"]: _least_left(np.array([[x[f"{min(a, b)}_{max(a, b)}"] for b in ks] for a in ks])) for x in products}
        size = lambda c: F.sum(F.abs(c))
        lefts = rank.groupBy("kind").agg(size(_left(ks, power)).alias("power"), *[
            size(F.when(F.col("kind") == k, _left(ks, c))).alias(f"least{k}") for k, c in weights.items()]).collect()
        left = 0.0
        for x in lefts:
            k = x["kind"]
            if x["power"] <= x[f"least{k}"]:
                weights[k] = power
            left = max(left, min(x["power"], x[f"least{k}"]))
        by_kind = lambda f: F.coalesce(*[F.when(F.col("kind") == k, f(c)) for k, c in weights.items()], F.lit(0.0))
        rank = rank.select("kind", "host", (F.col("r") + by_kind(lambda c: _weighted(ks, c))).alias("r"),
                           by_kind(lambda c: _left(ks, c)).alias("k0"))
        if left / (1 - damping) <= least:
            break
    rank = rank.withColumn("r", F.greatest("r", F.lit(0.0)))
    part = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("r"))), F.lit(0.0))
    return rank.groupBy("host").agg(part(0).alias("trust"), part(1).alias("distrust"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules=RULES, block_share: float = BLOCK_SHARE) -> DataFrame:
    """Id, host, path, rule, verdict, trust and distrust of each page."""
    host, path = url_parts(F.col(url_col))
    one = pages.select(F.col(id_col).alias("__id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    ruled = one.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    per_host = ruled.filter("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("fit.verdict") == "allow", 1)).alias("ok"),
        F.count(F.when(F.col("fit.verdict") == "block", 1)).alias("bad"))
    per_host = materialize(per_host, "hosts")
    # a host is a seed by the share of its pages that rules judge so
    seeds = per_host.filter("ok > 0").select("host", F.lit(0).alias("kind"), (F.col("ok") / F.col("n")).alias("w")).union(
        per_host.filter("bad > 0").select("host", F.lit(1).alias("kind"), (F.col("bad") / F.col("n")).alias("w")))
    n_hosts = per_host.count()
    rank = propagate(host_edges(one.select("host", "html")), seeds, n_hosts)
    # blocked: distrust outweighs trust and is above an even share of all rank
    rank = rank.select(
        "host", "trust", "distrust",
        ((F.col("distrust") > block_share * (F.col("trust") + F.col("distrust")))
         & (F.col("distrust") * n_hosts > 1.0)).alias("blocked"))
    light = ruled.drop("html")
    joined = light.join(rank, "host", "left")
    verdict = F.coalesce("fit.verdict", F.when(F.col("blocked"), "block"), F.lit("allow"))
    return joined.select(F.col("__id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"),
                         verdict.alias("verdict"), F.round(F.coalesce("trust", F.lit(0.0)), 9).alias("trust"),
                         F.round(F.coalesce("distrust", F.lit(0.0)), 9).alias("distrust"))

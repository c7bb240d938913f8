"""URL verdicts by rules, and by trust that links carry.

A rule names a host and the beginning of a path. It fits the host and all its subdomains, on paths that
begin so; the longest fitting rule decides. Hosts form a graph: an edge for each host that a page's
absolute links lead to, weighted by the links, and one from a subdomain to the next wider name that
has pages. Hosts whose pages the rules allow are trusted seeds, those whose pages they block are blocked
seeds, each by the number of such pages. Personalised PageRank from the trusted seeds along the edges
gives trust. From the blocked seeds against the edges it gives distrust: whoever leads to the blocked
is distrusted. Links to hosts without pages take their share of a host's trust with them.
Rounds go on until no host's rank changes by more than ``TOLERANCE`` of itself, or for ``ROUNDS``: what comes over
more hosts than that is nothing. A page that no rule fits is blocked if its host's distrust is above
``THRESHOLD`` of both together, which is decided for each host, and allowed otherwise. Ranks sum up to
one at most over all hosts, so only shares and leading digits count, at any size of the graph.

The graph is of hosts, summed up before anything is shuffled by host; a round is one join and one sum for both ranks.

Defined results: a null url, or one without ``://``, has an empty host and path, which no rule fits; its
verdict is the method's for the host without a name. A host that neither trust nor distrust reaches is
allowed. Repeated rows are returned each and count each. Null html has no links.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.binding import let
from tidemark.llm.common import stored

#: Rules at most: each becomes part of one expression.
MAX_RULES = 1000
#: The share that goes on along the edges, and rounds between two tables.
DAMPING, BLOCK = 0.85, 8
#: The part of a rank that its last change may have, and rounds at most. Less than 1e-18 of all weight is
#: still on its way after so many, which is what a host further from every seed would get.
TOLERANCE, ROUNDS = 1e-9, 256
#: Hosts and edges that one task of a round holds.
ROWS = 200_000
#: Distrust's part of trust and distrust together above which a host is blocked.
THRESHOLD = 0.5
#: Sums of doubles differ in their last places with the order of adding, so results are rounded: to so many
#: places from the first that isn't zero, as ranks may be small.
DIGITS = 9

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\bhref\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""

Rules = Sequence[tuple[str, str]]


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host_: Column, path_: Column, rules: Rules) -> Column:
    """The longest rule that fits, or null. A rule is written as host and path together; its verdict isn't asked here."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tested first
        name, slash, rest = rule.partition("/")
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: Rules) -> Column:
    found = F.lit(None).cast("string")
    for verdict, text in rules:
        found = F.when(rule == text, F.lit(verdict)).otherwise(found)
    return found


def judged(pages: DataFrame, rules: Rules, url: str = "url") -> DataFrame:
    """All columns of ``pages`` and ``judged: struct<host, path, rule, verdict>``, the verdict of rules only."""
    parts = F.struct(host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    return pages.withColumn("judged", let(parts, lambda p: let(
        longest_rule(p["host"], p["path"], rules),
        lambda r: F.struct(p["host"].alias("host"), p["path"].alias("path"), r.alias("rule"), verdict_of(r, rules).alias("verdict")),
    )))


def host_edges(found: DataFrame, hosts: DataFrame, html: str = "html") -> DataFrame:
    """``(src, dst, weight)`` between different hosts, of which the first has pages."""
    links = found.select(
        F.col("judged.host").alias("src"),
        F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("to"),
    ).select("src", F.translate(F.regexp_replace("to", r"^.*@|:\d*$", ""), UPPER, LOWER).alias("dst"))
    counted = links.filter("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    labels = F.split("host", r"\.")
    # A name within a host begins behind one of its first dots.
    wider = hosts.select("host", F.posexplode(F.transform(
        F.sequence(F.lit(2), F.size(labels) + 1),
        lambda k: F.array_join(F.slice(labels, k, F.greatest(F.size(labels) - k + 1, F.lit(0))), "."),
    )).alias("level", "dst")).filter("dst <> ''")
    named = wider.join(hosts.select(F.col("host").alias("dst")), "dst")
    nearest = named.groupBy("host").agg(F.min_by("dst", "level").alias("dst"))
    both = counted.union(nearest.select(F.col("host").alias("src"), "dst", F.lit(1.0)))
    return both.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def shares(edges: DataFrame, hosts: DataFrame) -> DataFrame:
    """``(src, dst, share)``: each edge's part of all weights at its source, of edges to hosts that have pages."""
    out = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    inside = edges.join(hosts.select(F.col("host").alias("dst")), "dst", "left_semi")
    return inside.join(out, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("share"))


def propagate(hosts: DataFrame, ways: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Personalised PageRank ``(host, name…)`` for several ``(seed, name, edges)`` at once.

    Edges are ``(src, dst, share)``; the ranks start from the weights in the column ``seed``. Shares of a host that sum up
    to less than one lose the rest, and what would leave a host without edges is lost. Each round is one join and one
    sum: every host has a step to itself, of no share, that carries its seed and former rank. Rounds are planned
    in blocks, and each block ends in a table, so that a plan, and what it expects of sizes, starts from files again.
    """
    totals = hosts.agg(*[F.sum(seed).alias(name) for seed, name, _ in ways]).first()
    base = reduce(DataFrame.union, [
        hosts.select(F.lit(name).alias("way"), "host", (F.col(seed) / (totals[name] or 1.0)).alias("base")) for seed, name, _ in ways
    ])
    steps = reduce(DataFrame.union, [
        edges.select(F.lit(name).alias("way"), "src", "dst", "share", F.lit(False).alias("own")) for _, name, edges in ways
    ] + [
        hosts.select(F.lit(name).alias("way"), F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(0.0).alias("share"), F.lit(True).alias("own"))
        for _, name, _ in ways
    ])
    steps = stored(steps, "trust-steps")
    tasks = max(1, steps.count() // ROWS)
    steps = steps.coalesce(tasks)
    now = stored(base.withColumn("rank", F.col("base")).coalesce(tasks), "trust-ranks").withColumn("last", F.lit(0.0))
    for _ in range(0, ROUNDS, BLOCK):
        for _ in range(BLOCK):
            ranks = now.select(F.col("way"), F.col("host").alias("src"), "base", "rank")
            moved = ranks.join(steps, ["way", "src"]).groupBy("way", F.col("dst").alias("host")).agg(
                F.sum(F.col("rank") * F.col("share")).alias("moved"), F.max(F.when(F.col("own"), F.col("base"))).alias("base"),
                F.max(F.when(F.col("own"), F.col("rank"))).alias("last"),
            )
            now = moved.select(
                "way", "host", "base", ((1 - DAMPING) * F.col("base") + DAMPING * F.col("moved")).alias("rank"), "last"
            ).coalesce(tasks)
        now = stored(now, "trust-ranks").coalesce(tasks)
        if now.filter(F.abs(F.col("rank") - F.col("last")) > TOLERANCE * F.greatest("rank", "last")).isEmpty():
            break
    return now.groupBy("host").agg(*[F.max(F.when(F.col("way") == name, F.col("rank"))).alias(name) for _, name, _ in ways])


def leading(value: Column) -> Column:
    """Rounded to ``DIGITS`` places from the first that isn't zero."""
    return F.format_string(f"%.{DIGITS - 1}e", value).cast("double")


def host_trust(found: DataFrame, html: str = "html") -> DataFrame:
    """``(host, trust, distrust, verdict)`` of every host of judged pages."""
    hosts = stored(found.groupBy(F.col("judged.host").alias("host")).agg(
        F.count_if(F.col("judged.verdict") == "allow").cast("double").alias("allowed"),
        F.count_if(F.col("judged.verdict") == "block").cast("double").alias("blocked"),
    ), "hosts")
    edges = stored(host_edges(found, hosts, html), "host-edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    ranks = propagate(hosts, [
        ("allowed", "trust", shares(edges, hosts)), ("blocked", "distrust", shares(back, hosts).join(
            hosts.select(F.col("host").alias("src")), "src", "left_semi")),
    ])
    both = ranks.withColumns({"trust": leading(F.col("trust")), "distrust": leading(F.col("distrust"))})
    sum_ = F.col("trust") + F.col("distrust")
    blocked = F.when(sum_ > 0, F.round(F.col("distrust") / sum_, DIGITS) > THRESHOLD).otherwise(False)
    return both.withColumn("verdict", F.when(blocked, "block").otherwise("allow"))


def verdicts(pages: DataFrame, rules: Rules, url: str = "url", html: str = "html") -> DataFrame:
    """All columns of ``pages`` but one of that name, and ``judged: struct<host, path, rule, verdict, trust, distrust>``."""
    pages = pages.drop("judged")
    found = judged(pages, rules, url)
    by_host = stored(host_trust(found, html), "host-trust").select(F.col("host").alias("__host"), F.struct(
        F.col("verdict").alias("verdict"), "trust", "distrust"
    ).alias("__trust"))
    joined = found.join(by_host, found["judged.host"] == F.col("__host"), "left")
    return joined.select(*[found[c] for c in pages.columns], F.struct(
        "judged.host", "judged.path", "judged.rule",
        F.coalesce("judged.verdict", "__trust.verdict").alias("verdict"), "__trust.trust", "__trust.distrust",
    ).alias("judged"))

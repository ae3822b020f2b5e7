"""URL filter: rules first, then trust and distrust over the link graph of hosts.

Hosts link where their pages link. Trust starts at hosts with pages that rules
allow and follows the links (personalised PageRank); distrust starts at hosts
with pages that rules block and goes against them, to the hosts that link
there. A host's seed is the share of its pages with such a rule; a score is the
seed plus ``DAMPING`` times what comes in over edges, each host dividing its
score among its edges by their weight. A host is blocked where distrust less
trust is above ``THRESHOLD``; other hosts are allowed. All is DataFrame
operations.

Defined cases: a null url, or one without ``://``, has empty host and path, no
rule and no links counted; its verdict is allow. Null html has no links. Links
of a host to itself do not count. Among fitting rules the longest wins (host
and path together), a block rule before an allow rule of the same length.
Repeated rows are judged one by one.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.jobs import stage

DAMPING = 0.5
ROUNDS = 8
#: Rounds between written tables, which keep the plan short.
STAGE_EVERY = 4
THRESHOLD = 0.5
_LINK = r"(?i)href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), r"^[^?#]*", 0)
    return _lower(host), path


def host_rules(hosts: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """For each host its fitting rules, best first: ``host``, ``rules``."""
    table = hosts.sparkSession.createDataFrame(
        [(r.split("/", 1)[0], "/" + r.split("/", 1)[1], r, action) for action, r in rules],
        "_suffix string, path string, rule string, action string",
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = hosts.select("host", F.explode(suffixes).alias("_suffix")).join(table, "_suffix")
    best = F.array_sort(F.collect_set(F.struct((-F.length("rule")).alias("size"), (F.col("action") != "block").alias("late"), "rule", "path", "action")))
    return fitting.groupBy("host").agg(best.alias("rules"))


def link_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Weighted edges between hosts: ``src``, ``dst``, ``n``."""
    links = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(_LINK), F.lit(1))
    return (
        pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(links).alias("dst"))
        .select("src", _lower(F.col("dst")).alias("dst")).where("src <> dst")
        .groupBy("src", "dst").agg(F.count("*").alias("n"))
    )


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """Scores after some rounds from ``seeds`` (``kind``, ``host``, ``seed``).

    Kind ``trust`` follows the edges, kind ``distrust`` goes against them.
    """
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n").union(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    flow = stage(
        both.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("total")).alias("part")),
        "host_edges",
    )
    score = seeds.select("kind", "host", F.col("seed").alias("score"))
    for k in range(1, rounds + 1):
        moved = score.join(flow, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (F.lit(damping) * F.col("score") * F.col("part")).alias("score")
        )
        score = seeds.select("kind", "host", F.col("seed").alias("score")).union(moved).groupBy("kind", "host").agg(
            F.sum("score").alias("score")
        )
        if k % STAGE_EVERY == 0 and k < rounds:
            score = stage(score, "host_scores")
    return score


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], threshold: float = THRESHOLD, rounds: int = ROUNDS,
    id_col="page_id", url_col="url", html_col="html",
) -> DataFrame:
    """Host, path, rule and verdict of every page, with the host's scores."""
    host, path = split_url(F.col(url_col))
    named = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    hosts = named.select("host").distinct()
    # Small beside the pages: written first, so that Spark knows its size.
    by_host = stage(host_rules(hosts, rules), "host_rules")
    fits = F.filter(F.col("rules"), lambda r: F.col("path").startswith(r["path"]))
    ruled = stage(
        named.drop("html").join(by_host, "host", "left")
        .select("_id", "host", "path", F.get(fits, F.lit(0)).alias("best"))
        .select("_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("action")),
        "ruled_pages",
    )
    share = ruled.where("host <> ''").groupBy("host").agg(
        F.avg((F.coalesce("action", F.lit("")) == "allow").cast("double")).alias("trust"),
        F.avg((F.coalesce("action", F.lit("")) == "block").cast("double")).alias("distrust"),
    )
    seeds = stage(
        share.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "seed"))
        .where("seed > 0"),
        "host_seeds",
    )
    score = propagate(seeds, link_edges(named), rounds)
    verdicts = stage(
        score.groupBy("host").agg(
            F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
            F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
        ),
        "host_verdicts",
    )
    blocked = F.coalesce(F.col("distrust") - F.col("trust") > threshold, F.lit(False))
    return ruled.join(verdicts, "host", "left").select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.coalesce(F.col("action"), F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )

"""URL verdicts from rules and from the link graph, in built-in functions only.

Rules name a host and the start of a path and hold for the host and its subdomains; the
longest that fits decides. Where none fits, the host's standing in the link graph does:
hosts whose pages the rules mostly allow are trusted seeds, hosts whose pages they mostly
block are blocked seeds. Trust walks along the links between hosts (personalised PageRank
from the trusted seeds), distrust walks against them from the blocked seeds, and a host is
blocked when its distrust outweighs its trust by ``excess`` and is no mere trace. Both walks
go on until they are settled well below that bar, however long the paths are.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and
no links, and is allowed. A null page has no links. Repeated rows are pages of their own,
with equal verdicts. Without links, scores stay with the seeds. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, new_folder

# Verdict, host, start of the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
#: Distrust over trust that blocks, and the least distrust in terms of an even share.
EXCESS, TRACE = 2.0, 0.1
#: Scores are settled to this part of the least distrust that blocks.
SETTLED = 1e-3


def behind_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(behind_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    found = F.regexp_extract(behind_scheme(url), r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def with_rule(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Pages with host, path, rule and rule_verdict; the longest rule that fits, else null."""
    rows = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        inside = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        fits = inside & F.startswith(F.col("path"), F.lit(start))
        rule = F.when(fits, F.lit(host + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rows.withColumns({"rule": rule, "rule_verdict": verdict})


def host_links(rows: DataFrame, html: str = "html") -> DataFrame:
    """Links between different hosts: src, dst, n. Relative links stay on their host."""
    pattern = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""
    targets = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(pattern), 1)
    links = rows.where("host <> ''").select(
        F.col("host").alias("src"), F.explode(F.array_distinct(targets)).alias("target")
    )
    whole = F.when(F.startswith("target", F.lit("//")), F.concat(F.lit("http:"), "target"))
    links = links.select("src", host_of(F.coalesce(whole, F.col("target"))).alias("dst"))
    return links.where("dst <> '' and dst <> src").groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("n")
    )


def seeds(rows: DataFrame) -> DataFrame:
    """Hosts that the rules trust or distrust: 1 where most pages speak for it, else 0.

    Seeds of a kind count alike, however many pages they have: a large host takes no weight
    from the others.
    """
    votes = F.sum(
        F.when(F.col("rule_verdict") == "allow", 1).when(F.col("rule_verdict") == "block", -1)
        .otherwise(0)
    )
    hosts = rows.where("host <> ''").groupBy("host").agg(votes.alias("votes"))
    return hosts.select(
        "host",
        (F.col("votes") > 0).cast("int").alias("trust"),
        (F.col("votes") < 0).cast("int").alias("distrust"),
    )


def propagated(hosts: DataFrame, links: DataFrame, rounds: int | None = None) -> DataFrame:
    """Standing of each host: columns kind (trust or distrust), host, score.

    Both walks run at once, as rows of two kinds. A walk returns to its seeds with the rest
    of the damping and from hosts without a way on. A round shrinks the distance to the settled
    scores by the damping at least, so a last change of c leaves c * DAMPING / (1 - DAMPING) at
    most; rounds go on until that is below ``SETTLED`` of the bar that blocks. A walk's change
    starts at 2 at most, which bounds the rounds; scores still unsettled then are an error.
    """
    ends = links.select(F.col("src").alias("host")).union(links.select("dst")).distinct()
    everyone = cut(hosts.join(ends, "host", "full").na.fill(0, ["trust", "distrust"]))
    total = everyone.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    share = F.when(
        F.col("kind") == "trust", F.col("seed") / F.lit(float(total["t"] or 1))
    ).otherwise(F.col("seed") / F.lit(float(total["d"] or 1)))
    start = everyone.select(
        "host",
        F.explode(
            F.array(
                F.struct(F.lit("trust").alias("kind"), F.col("trust").alias("seed")),
                F.struct(F.lit("distrust").alias("kind"), F.col("distrust").alias("seed")),
            )
        ).alias("_"),
    ).select("_.kind", "host", F.col("_.seed").alias("seed"))
    start = cut(start.withColumn("seed", share).withColumn("score", F.col("seed")))

    forward = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    backward = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    ways = forward.union(backward)
    out = ways.groupBy("kind", "host").agg(F.sum("n").alias("out"))
    ways = cut(ways.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("out")).alias("part")))
    if ways.isEmpty():
        return start.select("kind", "host", "score")

    tolerance = SETTLED * TRACE / everyone.count() * (1 - DAMPING) / DAMPING
    if rounds is None:
        rounds = math.ceil(math.log(tolerance / 4) / math.log(DAMPING)) + 2
    onward = ways.select("kind", "host").distinct().withColumn("onward", F.lit(True))
    scores = start.join(onward, ["kind", "host"], "left").na.fill(False, ["onward"])
    # Two folders in turn: a round reads one and replaces the other.
    folders = [new_folder(start.sparkSession, "url-scores") for _ in range(2)]
    scores = written(scores.withColumn("old", F.col("score")), folders[1])
    sums = [
        F.sum(F.when(F.col("onward"), F.col("score")).otherwise(0.0)).alias("kept"),
        F.sum(F.abs(F.col("score") - F.col("old"))).alias("change"),
    ]
    totals = {row["kind"]: row for row in scores.groupBy("kind").agg(*sums).collect()}
    for place in range(rounds):
        # What leaves a host with a way on stays in the walk; the rest returns to the seeds.
        trust, distrust = (F.lit(1 - DAMPING * totals[kind]["kept"]) for kind in ("trust", "distrust"))
        back = F.when(F.col("kind") == "trust", trust).otherwise(distrust)
        given = (
            ways.join(scores.select("kind", "host", "score"), ["kind", "host"])
            .groupBy("kind", F.col("to").alias("host"))
            .agg(F.sum(F.col("part") * F.col("score")).alias("given"))
        )
        new = scores.drop("old").join(given, ["kind", "host"], "left").select(
            "kind", "host", "seed", "onward", F.col("score").alias("old"),
            (F.coalesce("given", F.lit(0.0)) * DAMPING + F.col("seed") * back).alias("score"),
        )
        scores = written(new, folders[place % 2])
        totals = {row["kind"]: row for row in scores.groupBy("kind").agg(*sums).collect()}
        change = sum(row["change"] for row in totals.values())
        if change < tolerance:
            return scores.select("kind", "host", "score")
    raise RuntimeError(f"host scores still change by {change} after {rounds} rounds; the bar is {tolerance}")


def written(scores: DataFrame, folder: str) -> DataFrame:
    """The same rows from Parquet in the folder, in place of what it held."""
    scores.write.mode("overwrite").parquet(folder)
    return scores.sparkSession.read.schema(scores.schema).parquet(folder)


def blocked_hosts(scores: DataFrame, excess: float = EXCESS, trace: float = TRACE) -> DataFrame:
    """Hosts that the link graph blocks."""
    by_host = scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
    )
    hosts = by_host.count()
    bad = (F.col("distrust") * F.lit(hosts) >= trace) & (F.col("distrust") > F.col("trust") * excess)
    return by_host.where(bad).select("host")


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Columns page_id, host, path, rule, verdict of every page."""
    rows = with_rule(pages.select("page_id", "url", "html"), rules)
    links = cut(host_links(rows))
    scores = propagated(cut(seeds(rows.drop("html"))), links)
    blocked = cut(blocked_hosts(scores)).withColumn("_blocked", F.lit(True))
    found = rows.drop("html").join(blocked, "host", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("_blocked"), "block"), F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))

"""URL filter: host and path rules, and link-graph propagation for the rest.

Every host gets two seeds, the shares of its pages that rules allow and block.
Trust flows along the links between hosts (personalised PageRank), distrust
against them, and a url that no rule fits takes the verdict of its host, which
is blocked where distrust is above trust and its own links lead to blocked hosts.
DataFrame functions only. Links are counted per pair of hosts before they are
shuffled, so a host with a third of all pages is a few rows; the scores are
one small row per host and direction, written at each step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: fixed values: (verdict, rule), a rule being host and path
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: share of a score that flows along links
DAMPING = 0.85
#: steps of propagation at most, and the change at which it ends
STEPS, SETTLED = 20, 1e-4
#: a host is blocked from the reach of one with this share of its pages blocked
BLOCKED_SHARE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\b(?:href|src|action)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def url_parts(url: F.Column) -> tuple[F.Column, F.Column]:
    """(host, path); both empty where the url is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: F.Column, path: F.Column, rules: tuple[tuple[str, str], ...]) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest fitting rule; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        at = r.index("/")
        fits = ((host == r[:at]) | host.endswith("." + r[:at])) & path.startswith(r[at:])
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): pages of ``src`` that link to the other host ``dst``."""
    host, _ = url_parts(F.col("url"))
    hosts = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda h: F.translate(h, _UPPER, _LOWER)))
    return pages.select(host.alias("src"), F.explode(hosts).alias("dst")).filter("src <> dst AND src <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def host_scores(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(host, trust, distrust, reach) from (host, allowed, blocked) shares and
    links.

    A score is (1 - d) * seed + d * the scores that links bring: trust from the
    hosts that link here and distrust from the hosts linked to, each shared out
    among a host's links by their pages. Reach is distrust averaged over a
    host's own links instead, so it does not sink with the number of others
    that link to the same blocked host.
    """
    links = staged(links, "url-pairs")
    by_src = links.groupBy("src").agg(F.sum("n").alias("src_n"))
    by_dst = links.groupBy("dst").agg(F.sum("n").alias("dst_n"))
    weighed = links.join(by_src, "src").join(by_dst, "dst")
    flow = lambda kind, host, to, every: F.struct(F.lit(kind).alias("kind"), F.col(host).alias("host"), F.col(to).alias("to"), (F.col("n") / F.col(every)).alias("weight"))
    flows = staged(weighed.select(F.explode(F.array(
        flow("trust", "src", "dst", "src_n"), flow("distrust", "dst", "src", "dst_n"), flow("reach", "dst", "src", "src_n"))).alias("f")).select("f.*"), "url-links")
    start = seeds.select("host", F.explode(F.map_from_arrays(F.array(F.lit("trust"), F.lit("distrust"), F.lit("reach")), F.array("allowed", "blocked", "blocked"))).alias("kind", "seed"))
    # hosts that are only linked to have no seed
    every = start.unionByName(flows.select("kind", "host", F.lit(0.0).alias("seed")).unionByName(
        flows.select("kind", F.col("to").alias("host"), F.lit(0.0).alias("seed"))))
    state = staged(every.groupBy("kind", "host").agg(F.sum("seed").alias("seed"))
                   .withColumn("score", F.col("seed") * (1 - DAMPING)), "url-scores")
    for _ in range(STEPS):
        brought = state.filter("score > 0").join(flows, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(
            F.sum(F.col("score") * F.col("weight")).alias("brought"))
        after = F.col("seed") * (1 - DAMPING) + DAMPING * F.coalesce("brought", F.lit(0.0))
        step = staged(state.join(brought, ["kind", "host"], "left").select("kind", "host", "seed", after.alias("score"), F.abs(after - F.col("score")).alias("change")), "url-scores")
        state = step.drop("change")
        if (step.agg(F.max("change")).first()[0] or 0.0) < SETTLED:
            break
    return state.groupBy("host").agg(*[F.max(F.when(F.col("kind") == k, F.col("score"))).alias(k) for k in ("trust", "distrust", "reach")])


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path,
    rule, verdict.

    A null url, or one without ``://``, has an empty host and path, fits no
    rule and is allowed; a null html has no links; repeated rows count and are
    kept each; other columns are ignored; an empty table gives an empty table.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    judged = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    share = lambda v: F.avg(F.when(F.col("by_rule") == v, 1.0).otherwise(0.0))
    seeds = judged.filter("host <> ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    scores = host_scores(seeds, host_links(pages.select("url", F.col("html").cast("string").alias("html"))))
    bad = (F.col("distrust") > F.col("trust")) & (F.col("reach") >= (1 - DAMPING) * BLOCKED_SHARE)
    hosts = staged(scores.select("host", F.when(bad, "block").otherwise("allow").alias("by_host")), "url-hosts")
    return judged.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict"))

"""URL rules, and trust spread over the graph of hosts, in DataFrame functions only.

A rule names a host (with its subdomains) and a path prefix; the longest that fits decides a url. Hosts with urls that rules
allow are trusted seeds, hosts with urls that rules block are distrusted ones, by their share of such urls. Personalised PageRank
carries trust along links and distrust against them; a host with more distrust than trust is blocked, every other one allowed, which decides the urls
that no rule fits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.llm.common import written

ALLOW, BLOCK = "allow", "block"
#: Distrust counts as more than trust if it is so by more than this share, as sums end and add up differently.
TIE = 1e-6


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The contract's rules.
RULES = (
    UrlRule(ALLOW, "com", "/"),
    UrlRule(BLOCK, "example.com", "/en/"),
    UrlRule(ALLOW, "www.example.com", "/en/"),
    UrlRule(BLOCK, "net", "/es/"),
    UrlRule(BLOCK, "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one or for null."""
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """The name of the longest rule that fits, or null; of two equally long ones the first by name."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last test made is the outermost
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.lit(r.name)).otherwise(out)
    return out


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, n: links between different hosts. Links without a host stay on theirs and carry nothing."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)href\s*=\s*["']\s*(?:https?:)?//([^/?#"'\s]+)"""), F.lit(1))
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(found).alias("dst"))
    links = links.select("src", F.translate("dst", _UPPER, _LOWER).alias("dst")).filter("src <> '' AND src <> dst")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def _shares(edges: DataFrame, kind: str, src: str, dst: str) -> DataFrame:
    total = edges.groupBy(src).agg(F.sum("n").alias("_all"))
    return edges.join(total, src).select(F.lit(kind).alias("kind"), F.col(src).alias("from"), F.col(dst).alias("to"), (F.col("n") / F.col("_all")).alias("share"))


def spread(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 1000, enough: float = 1e-9) -> DataFrame:
    """kind, host, score: personalised PageRank of ``trust`` along the edges and of ``distrust`` against them.

    ``seeds``: kind, host, seed, the seeds of a kind summing to 1. What a host without links would pass on is dropped.
    Every round is a written table, which adds to each score what reaches the host over one link more. Rounds end when that is at most
    ``enough`` of the score of every host, so a host just reached goes on; more than ``rounds`` are an error.
    """
    edges = written(edges, "host-edges")
    seeds = written(seeds, "host-seeds")
    at = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("score"))
    if edges.isEmpty():
        return at
    flow = written(_shares(edges, "trust", "src", "dst").union(_shares(edges, "distrust", "dst", "src")), "host-shares")
    at = written(at.withColumn("got", F.col("score")), "host-scores")
    for _ in range(rounds):
        moved = at.join(flow, (at["kind"] == flow["kind"]) & (at["host"] == flow["from"])).select(flow["kind"], F.col("to").alias("host"), (F.col("got") * F.col("share") * damping).alias("got"))
        moved = moved.groupBy("kind", "host").agg(F.sum("got").alias("got"))
        both = at.select("kind", "host", "score").join(moved, ["kind", "host"], "full")
        both = both.select("kind", "host", (F.coalesce("score", F.lit(0.0)) + F.coalesce("got", F.lit(0.0))).alias("score"), F.coalesce("got", F.lit(0.0)).alias("got"))
        at = written(both, "host-scores")
        gap = at.filter("score > 0").agg(F.max(F.col("got") / F.col("score"))).first()[0]
        if gap is None or gap <= enough:
            return at.select("kind", "host", "score")
    raise RuntimeError(f"no end after {rounds} rounds")


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, ratio: float = 1.0, url: str = "url", html: str = "html") -> DataFrame:
    """Add host, path, rule, trust, distrust and verdict to each row of ``pages``; columns of these names are replaced.

    A host is blocked if its distrust is above ``ratio`` times its trust by more than the share ``TIE``; scores are given to 12 digits, however small. Urls without ``://`` and null ones have
    an empty host, which is no node of the graph: without a fitting rule they are allowed. Repeated rows count as pages of their own; without seeds nothing
    is blocked but by rules.
    """
    pages = pages.drop("host", "path", "rule", "trust", "distrust", "verdict")
    parsed = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    parsed = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for r in rules:
        by_rule = F.when(F.col("rule") == r.name, F.lit(r.verdict)).otherwise(by_rule)
    parsed = parsed.withColumn("_ruled", by_rule)
    kind = F.when(F.col("_ruled") == ALLOW, F.lit("trust")).when(F.col("_ruled") == BLOCK, F.lit("distrust"))
    seeds = parsed.filter("host <> '' AND _ruled IS NOT NULL").groupBy(kind.alias("kind"), "host").agg(F.count(F.lit(1)).alias("n"))
    total = seeds.groupBy("kind").agg(F.sum("n").alias("all"))
    seeds = seeds.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("seed"))  # two rows
    scores = spread(seeds, host_links(pages, url, html))
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k)
    hosts = scores.groupBy("host").agg(of("trust"), of("distrust"))
    judged = parsed.join(hosts, "host", "left").withColumns({k: F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust")})
    verdict = F.coalesce("_ruled", F.when(F.col("distrust") > ratio * F.col("trust") * (1 + TIE), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    short = {k: F.format_string("%.11e", F.col(k)).cast("double") for k in ("trust", "distrust")}
    return judged.withColumn("verdict", verdict).withColumns(short).select(*pages.columns, "host", "path", "rule", "trust", "distrust", "verdict")


def op2_trust_spread(pages: DataFrame) -> DataFrame:
    """The contract's query."""
    return judge_urls(pages.select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")

"""URL verdicts by rules and by trust propagated over the host link graph.

A rule such as ``example.org/es/`` fits its host and all subdomains if the url's
path starts with the rule's path; the longest fitting rule decides.  Hosts with
pages that a rule allows are trust seeds, hosts with blocked pages distrust
seeds (weight: their number of such pages).  Personalised PageRank carries trust
along host links and distrust against them; urls that no rule fits get the
verdict of their host: blocked when distrust is more than ``threshold`` of what
reached the host, else allowed (also when nothing reached it).

Both walks are one DataFrame iteration: edges (from, to) with a forward and a
backward weight, joined on the current scores and summed per host.  Links are
summed per host pair before the first step.  The walk gives no mass back from
hosts without links.  It goes on until, between two lineage cuts (``CUT_EVERY``
steps), no host is newly reached and no host's trust or distrust changes by more
than ``TOLERANCE`` of itself, so also hosts far from every seed get their scores;
the changes summed over all hosts are then below ``TOLERANCE`` of the mass.

Defined cases: a url that is null or has no ``://`` has empty host and path, no
rule, and is allowed; relative links and links within a host are no edges; null
html has no links; repeated rows weigh again; an empty table gives an empty one.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

# The rules of the contract, in its order.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, THRESHOLD, CUT_EVERY, TOLERANCE = 0.85, 0.5, 5, 1e-6
#: steps of the SQL form only, which cannot test for convergence
STEPS = 10


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _fits(rule: str, host: Column, path: Column) -> Column:
    domain, _, rest = rule.partition("/")
    return ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)


def rule_column(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest fitting rule (of equal ones the first), or null."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    return F.coalesce(*[F.when(_fits(rule, host, path), F.lit(rule)) for _, rule in ordered],
                      F.lit(None).cast("string"))


def verdict_column(rules: list[tuple[str, str]], rule: Column) -> Column:
    return reduce(lambda acc, r: F.when(rule == r[1], r[0]).otherwise(acc), rules, F.lit(None).cast("string"))


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts."""
    found = F.regexp_extract_all(html_col, F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"), 1)
    links = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(found).alias("__u"))
    target = F.when(F.col("__u").startswith("//"), F.concat(F.lit("any:"), F.col("__u"))).otherwise(F.col("__u"))
    links = links.select("src", host_of(target).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def _edges(links: DataFrame) -> DataFrame:
    """(from, to, w_trust, w_distrust): links for trust, reversed links for distrust."""
    out = links.groupBy("src").agg(F.sum("n").alias("total"))
    into = links.groupBy("dst").agg(F.sum("n").alias("total"))
    forward = links.join(out, "src").select(F.col("src").alias("from"), F.col("dst").alias("to"),
                                            (F.col("n") / F.col("total")).alias("w_trust"),
                                            F.lit(0.0).alias("w_distrust"))
    backward = links.join(into, "dst").select(F.col("dst").alias("from"), F.col("src").alias("to"),
                                              F.lit(0.0).alias("w_trust"),
                                              (F.col("n") / F.col("total")).alias("w_distrust"))
    return forward.unionByName(backward)


def _settled(old: DataFrame, new: DataFrame, tolerance: float) -> bool:
    """Whether every host of the new state was there with the same scores up to the relative tolerance."""
    was = old.select(F.col("host").alias("__host"), F.col("trust").alias("__trust"), F.col("distrust").alias("__distrust"))
    moved = reduce(lambda a, b: a | b, [F.abs(F.col(c) - F.coalesce(f"__{c}", F.lit(0.0))) > tolerance * F.col(c)
                                        for c in ("trust", "distrust")])
    return new.join(was, F.col("host") == F.col("__host"), "left").where(moved).isEmpty()


def propagate(links: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """Scores (host, trust, distrust) from seeds (host, allowed, blocked) over links (src, dst, n)."""
    sums = seeds.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    a, b = max(sums["a"] or 0, 1), max(sums["b"] or 0, 1)
    start = materialize(seeds.select("host", (F.col("allowed") / a).alias("trust"),
                                     (F.col("blocked") / b).alias("distrust")))
    edges = materialize(_edges(links))
    back = start.select("host", (F.col("trust") * (1 - damping)).alias("trust"),
                        (F.col("distrust") * (1 - damping)).alias("distrust"))
    state = start
    while True:
        before = state
        for _ in range(CUT_EVERY):
            moved = edges.join(state, edges["from"] == state["host"]).select(
                F.col("to").alias("host"), (F.col("trust") * F.col("w_trust") * damping).alias("trust"),
                (F.col("distrust") * F.col("w_distrust") * damping).alias("distrust"))
            state = moved.unionByName(back).groupBy("host").agg(F.sum("trust").alias("trust"),
                                                                F.sum("distrust").alias("distrust"))
        state = materialize(state)
        if _settled(before, state, tolerance):
            return state


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, threshold: float = THRESHOLD,
          tolerance: float = TOLERANCE, damping: float = DAMPING, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """id, host, path, rule, verdict, and the host's trust and distrust."""
    urls = pages.select(pages[id_col].alias(id_col), pages[url_col].cast("string").alias("__u"))
    urls = urls.select(id_col, host_of(F.col("__u")).alias("host"), path_of(F.col("__u")).alias("path"))
    urls = urls.withColumn("rule", rule_column(rules, F.col("host"), F.col("path")))
    urls = urls.withColumn("ruled", verdict_column(rules, F.col("rule")))
    seeds = urls.where("host <> ''").groupBy("host").agg(
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"))
    scores = propagate(host_links(pages, url_col, html_col), seeds, tolerance, damping)
    bad = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    return urls.join(scores, "host", "left").select(
        id_col, "host", "path", "rule",
        F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))

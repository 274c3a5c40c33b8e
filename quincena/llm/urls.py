"""URL verdicts from rules and from the link graph.

Rules (host, path) speak for their host, its subdomains and all paths that
begin with theirs; the longest wins. Hosts without a rule are judged by trust
that flows along links from hosts that rules allow (personalised PageRank)
and distrust that flows against links from hosts that rules block (who links
to the blocked is suspect). Edges are between hosts, weighted by links, so the
graph has a row for each pair of linked hosts, whatever the number of pages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quincena.session import materialize

DAMPING, THRESHOLD = 0.85, 0.0
LEFT_OVER = 1e-6  # of the seeds' mass, that propagation may leave unspread


def host_of(url: Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://`` and for null."""
    rest = _rest(url)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; ``rules``: pairs of
    verdict and ``host/path`` text."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def parsed(pages: DataFrame, rules: list[tuple[str, str]], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, ruled`` of every page."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url"))
    rows = rows.select("page_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumn("rule", rule).withColumn("ruled", verdict)


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst, links`` between different hosts, from the pages' ``href``s:
    absolute ones and those that begin with ``//``; relative links stay on
    their host and carry nothing."""
    rows = pages.select(F.col(url).alias("_url"), F.coalesce(F.col(html), F.lit("")).alias("_html"))
    links = rows.select(host_of(F.col("_url")).alias("src"), F.explode(F.regexp_extract_all(
        F.col("_html"), F.lit(r"(?i)href\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'>]*)"), F.lit(1))).alias("_link"))
    links = links.select("src", F.concat(F.lit("x:"), F.regexp_replace("_link", "^[^/]*", "")).alias("_url"))
    return links.select("src", host_of(F.col("_url")).alias("dst")).filter("src <> '' AND dst <> '' AND src <> dst") \
        .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, left_over: float = LEFT_OVER) -> DataFrame:
    """Personalised PageRank: ``host, score``. ``edges``: ``src, dst, links``;
    ``seeds``: ``host, mass``. Rank that a host without links holds goes back
    to the seeds by not being passed on (scores are relative).

    The seeds' mass walks on in waves, each a join and an aggregate over host
    edges written to the shared folder, until less than ``left_over`` of it is
    still under way: a wave is at most ``damping`` of the one before, so this
    ends, and no host is too far away for it. Scores are the sum of all waves
    and lie within that share of the limit."""
    out = edges.groupBy("src").agg(F.sum("links").alias("all"))
    weighted = materialize(edges.join(out, "src").select("src", "dst", (F.col("links") / F.col("all")).alias("share")), "edges")
    total = seeds.agg(F.sum("mass")).first()[0]
    wave = seeds.select("host", (F.col("mass") / F.lit(float(total or 1)) * (1 - damping)).alias("score"))
    waves = [wave]
    if not weighted.limit(1).count():
        return wave
    while True:
        wave = materialize(weighted.join(wave, weighted["src"] == wave["host"]).groupBy(F.col("dst").alias("host")).agg(
            (F.sum(F.col("share") * F.col("score")) * damping).alias("score")), "wave")
        under_way = wave.agg(F.sum("score")).first()[0]
        if under_way is None:
            break
        waves.append(wave)
        if under_way < left_over * (1 - damping):
            break
    return reduce(DataFrame.unionAll, waves).groupBy("host").agg(F.sum("score").alias("score"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], threshold: float = THRESHOLD, page_id: str = "page_id",
          url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page.

    A page's verdict is its rule's; else its host's: ``allow`` where trust
    less distrust is at least ``threshold``. Hosts whose pages rules allow
    (block) are the seeds, by their number of such pages; a host can be both.
    Hosts that nothing is known of have 0 and 0. Null urls, and urls without
    ``://``, have an empty host and path and are judged like an unknown host.
    Repeated pages are judged alike, row by row; other columns are left out."""
    rows = parsed(pages, rules, page_id, url)
    seeds = materialize(rows.filter("ruled IS NOT NULL").groupBy("host", "ruled").agg(
        F.count(F.lit(1)).cast("double").alias("mass")), "seeds")
    edges = materialize(host_edges(pages, url, html), "host_edges")
    trust = propagate(edges, seeds.filter("ruled = 'allow'").select("host", "mass"))
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    distrust = propagate(against, seeds.filter("ruled = 'block'").select("host", "mass"))
    scores = trust.withColumnRenamed("score", "trust").join(
        distrust.withColumnRenamed("score", "distrust"), "host", "full").fillna(0.0)
    judged = rows.join(scores, "host", "left").fillna(0.0, ["trust", "distrust"])
    known = F.when(F.col("trust") - F.col("distrust") >= threshold, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", known).alias("verdict"), "trust", "distrust")

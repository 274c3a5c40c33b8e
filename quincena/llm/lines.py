"""Boilerplate lines by the number of different sites that carry them.

Every line hash has a HyperLogLog sketch of its sites; sketches merge by
aggregation, so a line on every page is one small sketch a task, however many
rows carry it. Where the estimate lies too near the threshold to decide, the
sites are counted exactly, for those lines alone. A line seen under one site
name only (its least and greatest name agree) needs neither."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.llm.common import row_key

MIN_SITES, LEAST_CHARS = 5, 1  # every line that is not blank is judged
LG_K = 10  # 1024 registers: a standard error of 3.3 %
DOUBT = 0.15


def _lines(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(site).cast("string").alias("site"),
                       F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("line")).select(
        "doc_id", "site", F.trim("line").alias("line"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, least_chars: int = LEAST_CHARS, doc_id: str = "doc_id",
                text: str = "text", site: str = "source") -> DataFrame:
    """``line_hash`` of every line (blanks around it aside, at least
    ``least_chars`` characters) on ``min_sites`` different sites or more. A
    null site is no site."""
    hashed = _lines(docs, doc_id, text, site).filter(F.length("line") >= least_chars).filter("site IS NOT NULL").select(
        _hash("line").alias("line_hash"), "site")
    several = hashed.groupBy("line_hash").agg(F.min("site").alias("low"), F.max("site").alias("high")) \
        .filter("low <> high").select("line_hash")
    spread = hashed.join(several, "line_hash", "left_semi")
    estimated = spread.groupBy("line_hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"))
    margin = max(1.0, DOUBT * min_sites)
    near = estimated.filter(F.abs(F.col("sites") - min_sites) <= margin).select("line_hash")
    exact = spread.join(near, "line_hash", "left_semi").distinct().groupBy("line_hash").agg(
        F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= min_sites)
    clear = estimated.filter(F.col("sites") > min_sites + margin)
    return clear.select("line_hash").union(exact.select("line_hash"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, least_chars: int = LEAST_CHARS,
                       doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_text`` for every document: its lines
    without the cross-site ones, in order. A null text is one empty line.
    Other columns are left out, repeated rows and null or repeated ids are rows
    of their own and judged by their text, an empty table gives an empty one. Only hashes of lines meet the boilerplate; a text moves
    once, to the places of the lines that go."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"),
                        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1).alias("parts"))
    lines = keyed.select("key", F.posexplode("parts").alias("place", "line")).filter(
        F.length(F.trim("line")) >= least_chars).select("key", "place", _hash("line").alias("line_hash"))
    found = boilerplate(docs, min_sites, least_chars, doc_id, text, site)
    gone = lines.join(found, "line_hash", "left_semi").groupBy("key").agg(F.collect_set("place").alias("gone"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone")  # hashed, so linear in the lines
    left = F.transform(stay, lambda place: F.get("parts", place))
    texts = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"),
                        F.coalesce(F.col(text), F.lit("")).alias("text")).join(gone, "key", "left")
    return texts.select("doc_id", "gone", F.split("text", "\n", -1).alias("parts")).select(
        "doc_id", F.size("parts").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.array_join(F.when(F.col("gone").isNull(), F.col("parts")).otherwise(left), "\n").alias("kept_text"))


def _hash(line: str):
    """128 bits of a line's hash, blanks around it aside."""
    return F.unhex(F.sha2(F.trim(line), 256).substr(1, 32))

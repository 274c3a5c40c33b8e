"""Exact duplicates by progressive refinement: length, then a hash of the
text's beginning, then the hash of the whole text.

Each step counts its groups and hands on only rows of groups with two or more;
so whole texts are hashed only where length and beginning agree. Groups are
counted by partial aggregates, and rows meet their group's answer in joins
whose large partitions Spark splits, so one text copied to a third of all
rows costs no task more than its share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quincena.session import materialize

PREFIX = 256


def unchanged(text: Column) -> Column:
    return text


def _hashed(docs, normalise, doc_id, text, prefix) -> DataFrame:
    """Id, length, hash of the beginning and of the whole; columns that a step
    does not ask for are not computed in it."""
    value = normalise(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(value).alias("size"),
                       F.xxhash64(F.substring(value, 1, prefix)).alias("start"),
                       F.sha2(value.cast("binary"), 256).alias("text_sha256"))


def _shared(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys)


def resolve(docs: DataFrame, normalise=unchanged, doc_id: str = "doc_id", text: str = "text",
            prefix: int = PREFIX) -> DataFrame:
    """For every row ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are equal when their normalised texts are (null counts as empty);
    the largest ``doc_id`` of a group stays. With repeated ids all rows that
    carry the largest one stay; a null id stays only where no row of its
    group has an id. Other columns are left out; an empty table gives an
    empty one. Texts never move: shuffles carry ids, lengths and hashes."""
    hashed = _hashed(docs, normalise, doc_id, text, prefix)
    sizes = _shared(hashed.select("size"), "size")
    starts = _shared(hashed.select("size", "start").join(sizes, "size", "left_semi"), "size", "start")
    groups = hashed.join(starts, ["size", "start"], "left_semi").groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return hashed.join(groups, "text_sha256", "left").select(
        "doc_id", F.coalesce("keep", "doc_id").alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | F.col("doc_id").eqNullSafe(F.col("keep"))).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, normalise=unchanged, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (all columns) with exactly one row of each group of equal texts:
    one that ``resolve`` keeps. Where several rows of a group carry the kept
    id, or none of it has an id, any one of them stays."""
    id_, its_hash, hash_ = free_names(docs.columns, "_id", "_id_sha256", "_sha256")
    judged = materialize(resolve(docs, normalise, doc_id, text).filter("group_size > 1").groupBy(
        F.col("doc_id").alias(id_), F.col("text_sha256").alias(its_hash)).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "copies")
    ids = _ids_that_go(docs, judged, doc_id, id_)
    if ids is not None:
        return docs.join(ids, F.col(doc_id) == F.col(id_), "left_anti")
    whole = F.sha2(normalise(F.coalesce(F.col(text), F.lit(""))).cast("binary"), 256)
    rows = docs.withColumn(hash_, whole)
    same = (F.col(hash_) == F.col(its_hash)) & F.col(doc_id).eqNullSafe(F.col(id_))
    return without_repeats(rows, judged.filter("NOT kept OR n > 1").select(id_, its_hash),
                           judged.filter("kept AND n > 1").select(id_, its_hash), same, [hash_, doc_id]).drop(hash_)


def _ids_that_go(docs: DataFrame, judged: DataFrame, doc_id: str, id_: str) -> DataFrame | None:
    """Ids that tell which rows go, all of them and no other; None where ids
    do not tell that: one is null, stands on a row that stays as well, or on
    several rows of which one stays.

    A table of its own: of a few bytes a row, it is broadcast up to a much
    larger input than ids with hashes are, and until then no text moves."""
    gone = judged.filter("NOT kept")
    odd, n = judged.agg(F.max((F.col("kept") & (F.col("n") > 1)) | (~F.col("kept") & F.col(id_).isNull())),
                        F.sum(F.when(~F.col("kept"), F.col("n")))).first()
    if odd:
        return None
    ids = materialize(gone.select(id_).distinct(), "copies-ids")
    return ids if docs.select(doc_id).join(ids, F.col(doc_id) == F.col(id_), "left_semi").count() == (n or 0) else None


def free_names(taken: list[str], *names: str) -> list[str]:
    """``names``, made longer where a column has the name already (names
    match whatever their case)."""
    taken = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def without_repeats(rows: DataFrame, left_out: DataFrame, repeated: DataFrame, same: Column, keys: list[str]) -> DataFrame:
    """``rows`` that match (``same``) no row of ``left_out``, and one row for
    each ``keys`` of those that match ``repeated``, a part of ``left_out``.

    Repeated rows are dealt anew before they are reduced, first where they
    are, so that one row that stands very often is no task's alone."""
    out = rows.join(left_out, same, "left_anti")
    if not repeated.limit(1).count():
        return out
    return out.union(rows.join(repeated, same, "left_semi").hint("rebalance").dropDuplicates(keys))

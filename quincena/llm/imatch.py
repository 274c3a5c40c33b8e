"""I-Match fingerprints over several random lexicons.

Terms that are neither too common nor too rare (their inverse document
frequency lies in a band) are the lexicon. A document's terms of the lexicon,
distinct and sorted, are hashed; and likewise its terms of each of several
random subsets of the lexicon, so that a change which touches the terms of
some subsets leaves the hashes of the others. Subsets come in several sizes:
long documents keep a hash through an edit in the sparse ones, short ones
have terms in the full ones.

Document frequencies are counted over all documents in two exact passes. In
the first, tasks report the terms in at least half the band's least share f of
their documents. A term that a task is silent on is in less than f/2 of that
task's documents, which bounds its frequency from above; terms whose bound
misses f are out, and any other has a reported frequency of f/2 or more. The
second pass counts just those. Their number is bounded by (distinct terms of a
mean document) / (f/2), however many documents there are, so they fit into
every worker.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quincena.llm.common import U64, arrow_slices, bounded, hash_words, mix64, utf8, words_of
from quincena.session import materialize

# The band: a term is in at least this share of documents, and at most in that.
RARE, COMMON = 0.002, 0.2
# Random subsets: each size (one in so many terms) so many times.
SIZES, EACH = (1, 4, 16, 64, 256, 1024), 8
DIGITS = 4


def terms(text: bytes) -> np.ndarray:
    """Sorted hashes of a text's distinct words, A-Z lower-cased."""
    return np.unique(hash_words(words_of(text.lower())))


def _sum_by(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, at = np.unique(values, return_inverse=True)
    return unique, np.bincount(at, counts, len(unique)).astype(np.int64)


def _document_frequency(least_share: float | None, among: bytes | None, flush: int = 2_000_000):
    """Per task: (term, documents with it), summed before anything leaves it.
    ``least_share``: only terms that reach this share of the task's
    documents; ``among``: only these terms."""
    def run(batches):
        import pyarrow as pa

        wanted = np.frombuffer(among, U64) if among is not None else None
        held, counted = np.empty(0, U64), np.empty(0, np.int64)
        docs, waiting, size = 0, [], 0

        def fold():
            nonlocal held, counted, waiting, size
            if waiting:
                new = np.concatenate(waiting)
                held, counted = _sum_by(np.concatenate([held, new]), np.concatenate([counted, np.ones(len(new), np.int64)]))
            waiting, size = [], 0

        def out():
            use = counted >= least_share * docs if least_share is not None else slice(None)
            return pa.RecordBatch.from_arrays(
                [pa.array(held[use].view(np.int64)), pa.array(counted[use]),
                 pa.array(np.full(len(held[use]), docs, np.int64))], names=["term", "df", "docs"])

        for part in arrow_slices(batches, "text"):
            for t in part.column("text").to_pylist():
                found = terms(t)
                if wanted is not None and len(wanted):
                    at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
                    found = found[wanted[at] == found]
                waiting.append(found)
                size += len(found)
            docs += part.num_rows
            if size > flush // 2:
                fold()
            if len(held) > flush:  # a group of documents of its own
                yield out()
                held, counted, docs = np.empty(0, U64), np.empty(0, np.int64), 0
        fold()
        if docs:
            yield out()

    return run


def lexicon(docs: DataFrame, rare: float = RARE, common: float = COMMON, text: str = "text") -> np.ndarray:
    """Sorted hashes of the terms in the band, of all documents' counts."""
    texts = docs.select(utf8(text).alias("text"))
    total = texts.count()
    kind = "term long, df long, docs long"
    silent = (total - F.sum("docs")) * (rare / 2)
    likely = bounded(texts).mapInArrow(_document_frequency(rare / 2, None), kind).groupBy("term").agg(
        F.sum("df").alias("df"), silent.alias("silent")).filter(F.col("df") + F.col("silent") >= rare * total)
    likely = np.sort(likely.select("term").toArrow().column("term").to_numpy().view(U64))
    counts = bounded(texts).mapInArrow(_document_frequency(None, likely.tobytes()), kind).groupBy("term").agg(
        F.sum("df").alias("df")).filter(F.col("df").between(rare * total, common * total)).select("term")
    return np.sort(counts.toArrow().column("term").to_numpy().view(U64))


N_SUBSETS = 1 + EACH * (len(SIZES) - 1)


@lru_cache(1)
def _subsets(words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lexicon; for each subset the hash of each term (0: not in it), and
    whether it is in it."""
    lex = np.frombuffer(words, U64)
    salted = [mix64(lex ^ U64(0xA0761D6478BD642F * (i + 1) & (1 << 64) - 1)) for i in range(N_SUBSETS)]
    inside = np.array([h % U64(size) == 0 for h, size in
                       zip(salted, [s for s in SIZES for _ in range(EACH if s > 1 else 1)], strict=True)])
    return lex, np.where(inside, mix64(np.array(salted)), U64(0)), inside


def codes(texts: list[bytes], words: bytes) -> np.ndarray:
    """For each text and subset the hash of its distinct terms there (16 bits
    of the sum of the terms' hashes, which no order changes); -1: none.

    A text without any term of the band has nothing that subsets could say;
    its codes are hashes of all its distinct words, another for each subset,
    so that two such texts are alike if their words are the same and not else."""
    lex, hashes, inside = _subsets(words)
    out = np.full((len(texts), N_SUBSETS), -1, np.int32)
    spelled = [words_of(t.lower()) for t in texts]
    if not texts:
        return out
    found = hash_words([w for s in spelled for w in s])
    doc = np.repeat(np.arange(len(texts)), [len(s) for s in spelled])
    at = np.minimum(np.searchsorted(lex, found), max(0, len(lex) - 1))
    hit = lex[at] == found if len(lex) else np.zeros(len(found), bool)
    begin = np.cumsum([0, *(len(s) for s in spelled)])
    for i in np.flatnonzero(np.bincount(doc[hit], minlength=len(texts)) == 0):
        whole = U64(mix64(np.unique(found[begin[i]:begin[i + 1]])).sum())
        out[i] = mix64(whole + np.arange(1, N_SUBSETS + 1, dtype=U64)) % U64(0xFFFF)
    if not hit.any():
        return out
    pair = np.unique(doc[hit] * len(lex) + at[hit])  # by document, sorted terms
    term = pair % len(lex)
    ends = np.searchsorted(pair, np.arange(len(texts) + 1) * len(lex))
    for i in range(N_SUBSETS):
        total = np.r_[U64(0), np.cumsum(hashes[i][term])]
        count = np.r_[0, np.cumsum(inside[i][term])]
        some = count[ends[1:]] > count[ends[:-1]]
        out[some, i] = (mix64(total[ends[1:]] - total[ends[:-1]]) % U64(0xFFFF))[some]
    return out


_HEX = {i: f"{i:0{DIGITS}x}" for i in range(16 ** DIGITS)} | {-1: "."}


def written(rows: np.ndarray) -> list[str]:
    """Codes as text: hex hashes joined by ``-``, ``.`` for a subset of which the text has no term."""
    return ["-".join(map(_HEX.__getitem__, row)) for row in rows.tolist()]


def fingerprint(text: bytes, words: bytes) -> str:
    return written(codes([text], words))[0]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How alike fingerprints are, 0 to 1, row by row: the share of subsets
    with equal hashes among those that either text has terms of; 1 where
    neither has any."""
    some = (a >= 0) | (b >= 0)
    n = some.sum(axis=1)
    return np.where(n > 0, ((a == b) & some).sum(axis=1) / np.maximum(n, 1), 1.0)


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, next_id, gift_to, gift, repeats``: the next document in
    descending order of ids (after the last the first), the document that this
    one is next to, how many characters that one takes (the most that any of
    its rows takes), and whether any id of the table stands on several rows.
    One row for each id; null ids have no place in the order.

    Ids are dealt to ranges; within a range the order comes from a window
    over that range, between ranges from one row for each of them."""
    ids = docs.select(F.col(doc_id).alias("doc_id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("n")) \
        .filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("times"))
    dealt = materialize(ids.repartitionByRange(F.desc("doc_id")).withColumn("range", F.spark_partition_id()), "ids")
    edge = dealt.groupBy("range").agg(F.max(F.struct("doc_id", "n")).alias("top"), F.min(F.struct("doc_id", "n")).alias("end"),
                                     F.max("times").alias("times"))
    # One row for each range: as few as there are partitions.
    edges = sorted(edge.collect(), key=lambda r: -r["top"]["doc_id"])
    spark, repeats = docs.sparkSession, any(r["times"] > 1 for r in edges)
    around = [(r["range"], edges[(i + 1) % len(edges)]["top"]["doc_id"], edges[i - 1]["end"]["doc_id"],
               edges[i - 1]["end"]["n"]) for i, r in enumerate(edges)]
    border = spark.createDataFrame(around, "range int, after long, before long, before_n int")
    down = Window.partitionBy("range").orderBy(F.desc("doc_id"))
    return dealt.select("doc_id", "range", F.lead("doc_id").over(down).alias("next_id"),
                        F.lag("doc_id").over(down).alias("gift_to"), F.lag("n").over(down).alias("to_n")) \
        .join(F.broadcast(border), "range").select(
            "doc_id", F.coalesce("next_id", "after").alias("next_id"), F.coalesce("gift_to", "before").alias("gift_to"),
            F.floor(F.coalesce("to_n", "before_n") / 3).cast("int").alias("gift"), F.lit(repeats).alias("repeats"))


def fingerprints(docs: DataFrame, words: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row (null text: as an empty one)."""
    data = words.tobytes()
    rows = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for part in arrow_slices(batches, "text"):
            prints = written(codes(part.column("text").to_pylist(), data))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints, pa.string())],
                                             names=["doc_id", "fingerprint"])

    return bounded(rows).mapInArrow(run, f"doc_id {kind}, fingerprint string")


def edited(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """Fingerprints of all documents and of their edited texts (the last third
    replaced by the beginning of the next document), and how alike they are:
    one row for each row of ``docs``. A row without an id stands in no order
    and is its own next document, as the only document of a table is. Rows
    that repeat an id have one next document, that of the id; where the next
    id stands on several rows, the one whose text begins least (in bytes, by
    then its fingerprint) is the next document of all.

    Texts move once: an edited text is made where its document is, from the
    characters that its neighbour sends together with its own fingerprint."""
    data = words.tobytes()
    near = materialize(neighbours(docs), "neighbours")

    def sign(batches):
        import pyarrow as pa

        for part in arrow_slices(batches, "text"):
            prints = _packed(codes(part.column("text").to_pylist(), data))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), prints],
                                             names=["doc_id", "text", "print"])

    def signed(which: str) -> DataFrame:
        return bounded(docs.filter(which).select("doc_id", utf8("text").alias("text"))).mapInArrow(
            sign, "doc_id long, text binary, print binary").withColumn("text", F.col("text").cast("string"))

    base = signed("doc_id IS NOT NULL")
    gifts = base.join(near, "doc_id").select(F.col("gift_to").alias("doc_id"),
                                             F.expr("substring(text, 1, gift)").alias("gift"),
                                             F.col("print").alias("next_print"))
    if near.filter("repeats").limit(1).count():  # one gift for each id
        gifts = gifts.groupBy("doc_id").agg(F.min(F.struct("gift", "next_print")).alias("least")).select("doc_id", "least.*")
    alone = signed("doc_id IS NULL").select("doc_id", "text", "print", F.expr("substring(text, 1, length(text) div 3)").alias("gift"),
                                            F.col("print").alias("next_print"))
    own = base.join(gifts, "doc_id").union(alone)

    def run(batches):
        import pyarrow as pa

        for part in arrow_slices(batches, "text"):
            texts = part.column("text").to_pylist()
            changed = [(t[:len(t) - len(t) // 3] + gift[:len(t) // 3]).encode()
                       for t, gift in zip(texts, part.column("gift").to_pylist(), strict=True)]
            before, after, ahead = _codes_of(part.column("print")), codes(changed, data), _codes_of(part.column("next_print"))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "n_chars": pa.array(map(len, texts), pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
                "fingerprint": pa.array(written(before), pa.string()),
                "edited_fingerprint": pa.array(written(after), pa.string()),
                "near_edited": likeness(before, after), "near_next": likeness(before, ahead)})

    return bounded(own).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")


def _packed(rows: np.ndarray):
    """Codes as two bytes each (ffff: none), the form in which they travel."""
    import pyarrow as pa

    return pa.array([r.tobytes() for r in np.where(rows < 0, 0xFFFF, rows).astype(">u2")], pa.binary())


def _codes_of(column) -> np.ndarray:
    """The codes of packed ones."""
    rows = np.frombuffer(b"".join(column.to_pylist()), ">u2").reshape(-1, N_SUBSETS).astype(np.int32)
    return np.where(rows == 0xFFFF, -1, rows)

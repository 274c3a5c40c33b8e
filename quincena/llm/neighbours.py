"""Nearest vectors by cosine: collision-counting hashing with query-centred windows.

Vectors of length one are projected onto random directions, and every
projection of a block of vectors is one sorted array. A query looks at the
window around its own projection in each array; a vector within the windows of
at least ``LEAST`` of the ``PROJECTIONS`` arrays collides often enough to be
verified with its exact cosine. Windows start narrow and are widened (virtual
rehashing: only what a wider window adds is counted anew) until they are as
wide as the k-th best distance found asks for: a projection of two vectors at
distance d differs by a normal deviate of scale d, so with half-width
``REACH * d`` a vector at distance d reaches the threshold with probability
0.98, and a nearer one with a higher one. Nothing is capped: windows widen
until the bound holds or they hold the whole block.

Blocks of vectors are independent. A task reads a block's vectors, builds its
arrays, and then lets the queries stream past, so its memory is that of one
block. Every query meets every block; the best of all blocks are ranked by a
window whose partial top-k runs before the shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quincena.llm.common import bounded
from quincena.session import materialize

PROJECTIONS, LEAST = 96, 58
REACH = 1.04          # half-width for distance 1 at which 98 % of vectors reach LEAST collisions
START, WIDEN = 0.25, 2.0
BLOCK = 16_384        # vectors
QUERIES = 256         # that advance together


def fit_for_search(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, vector, dim`` of the rows that take part: those with an id and
    a vector that is neither null, empty nor zero and whose components are all
    finite numbers."""
    kind = vectors.schema[embedding].dataType
    vector = F.col(embedding)
    if not (isinstance(kind, T.ArrayType) and kind.elementType in (T.FloatType(), T.DoubleType())):
        vector = vector.cast("array<double>")
    ok = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    return vectors.filter(F.col(vec_id).isNotNull() & F.coalesce(ok, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), vector.alias("vector"), F.size(vector).alias("dim"))


def directions(dim: int, count: int = PROJECTIONS) -> np.ndarray:
    """``count`` normal directions (columns): the same for every block and query."""
    return np.random.default_rng(dim).standard_normal((dim, count))


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in double precision, each times a power of two (which changes no
    cosine and no digit) that keeps sums of squares in range; their norms."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x, np.sqrt((x * x).sum(axis=1))


class Block:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray):
        self.ids, self.raw = ids, raw
        self.x, self.norm = scaled(raw)
        projected = ((self.x / self.norm[:, None]) @ directions(raw.shape[1])).T
        self.order = np.argsort(projected, axis=1)
        self.values = np.take_along_axis(projected, self.order, axis=1)

    def windows(self, centres: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end (projections x queries) of the windows."""
        sides = [np.empty(centres.shape, np.int64) for _ in range(2)]
        for i, row in enumerate(self.values):
            sides[0][i] = np.searchsorted(row, centres[i] - half, "left")
            sides[1][i] = np.searchsorted(row, centres[i] + half, "right")
        return sides[0], sides[1]

    def search(self, ids: np.ndarray, raw: np.ndarray, k: int) -> list[list[tuple]]:
        """For each query the ``k`` nearest found: (score, vec_id, is it the query's own row)."""
        x, norm = scaled(raw)
        centres = ((x / norm[:, None]) @ directions(raw.shape[1])).T
        n, m = len(self.ids), len(self.values)
        counts = np.zeros((len(x), n), np.uint16)
        begin, end = self.windows(centres, np.zeros(len(x)))
        end = begin.copy()
        half = np.full(len(x), START)
        best: list[list[tuple]] = [[] for _ in x]
        active = np.arange(len(x))
        while len(active):
            lo, hi = self.windows(centres[:, active], half[active])
            still = []
            for at, q in enumerate(active):
                parts = [row[a:b] for row, a, b in zip(self.order, lo[:, at], begin[:, q], strict=True) if a < b]
                parts += [row[a:b] for row, a, b in zip(self.order, end[:, q], hi[:, at], strict=True) if a < b]
                before = counts[q] >= LEAST
                if parts:
                    counts[q] += np.bincount(np.concatenate(parts), minlength=n).astype(np.uint16)
                begin[:, q], end[:, q] = lo[:, at], hi[:, at]
                found = np.flatnonzero((counts[q] >= LEAST) & ~before)
                if len(found):
                    score = (self.x[found] * x[q]).sum(axis=1) / (self.norm[found] * norm[q])
                    if len(found) > k:
                        floor = np.partition(score, len(found) - k)[len(found) - k]
                        found, score = found[score >= floor], score[score >= floor]
                    own = (self.ids[found] == ids[q]) & (self.raw[found] == raw[q]).all(axis=1)
                    best[q] = sorted([*best[q], *zip(score.tolist(), self.ids[found].tolist(), own.tolist(), strict=True)],
                                     key=lambda b: (-b[0], b[1], not b[2]))[:k]
                needed = np.inf
                if len(best[q]) >= k:
                    needed = REACH * np.sqrt(max(0.0, 2 - 2 * best[q][-1][0]))
                whole = (lo[:, at] == 0).all() and (hi[:, at] == n).all()
                if half[q] < needed and not whole:
                    half[q] = min(WIDEN * half[q], needed)
                    still.append(q)
            active = np.array(still, np.int64)
        return best


def _arrays(batch):
    """Ids and vectors (all of one length) of a batch."""
    vectors = batch.column("vector")
    return batch.column("vec_id").to_numpy(zero_copy_only=False), \
        vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _found(k: int):
    def run(batches):
        import pyarrow as pa

        place, held, block = None, [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "block", "is_query")), strict=True))
            lo = 0
            while lo < len(keys):
                hi = lo + 1
                while hi < len(keys) and keys[hi] == keys[lo]:
                    hi += 1
                part = batch.slice(lo, hi - lo)
                if keys[lo][:2] != place:
                    place, held, block = keys[lo][:2], [], None
                if not keys[lo][2]:
                    held.append(_arrays(part))
                elif held or block:
                    if block is None:
                        block = Block(*(np.concatenate(a) for a in zip(*held, strict=True)))
                        held = []
                    ids, raw = _arrays(part)
                    q = part.column("q").to_pylist()
                    for at in range(0, len(ids), QUERIES):
                        best = block.search(ids[at:at + QUERIES], raw[at:at + QUERIES], k)
                        rows = [(i, key, *b) for i, key, bs in zip(ids[at:].tolist(), q[at:], best) for b in bs]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.int64(),
                                                                        pa.bool_()), strict=True)],
                            names=["query_id", "q", "score", "vec_id", "own"])
                lo = hi

    return run


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, block: int = BLOCK, vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by
    ``every`` the ``k`` nearest of all other rows, best first, ties by the smaller id.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part, nor do rows without an id. A vector meets those of its own
    length only. Rows that share an id with a query but are not its own row
    are candidates like others; queries that repeat both id and vector are
    answered once, queries that share an id only are each answered. An empty
    table gives an empty result; other columns are left out. Every row is
    indexed: vectors are dealt to blocks by their place in the table, so one
    vector that repeats very often spreads over all blocks."""
    rows = materialize(fit_for_search(vectors, vec_id, embedding).withColumn("place", F.monotonically_increasing_id()),
                       "vectors")
    blocks = F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")
    sizes = materialize(rows.groupBy("dim").agg(blocks), "vector-blocks")
    total = sizes.agg(F.sum("blocks")).first()[0] or 1
    queries = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "vector", "dim").distinct()
    columns = ["dim", "block", "is_query", "vec_id", "q", "vector"]
    index = rows.join(sizes, "dim").withColumns({
        "block": F.pmod("place", "blocks").cast("int"), "is_query": F.lit(False), "q": F.lit(0).cast("long")})
    asked = queries.join(sizes, "dim").withColumns({
        "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "is_query": F.lit(True),
        "q": F.xxhash64("vec_id", "vector")})
    dealt = index.select(*columns).union(asked.select(*columns)).repartition(2 * total, "dim", "block") \
        .sortWithinPartitions("dim", "block", "is_query")
    found = bounded(dealt).mapInArrow(_found(k + 1), "query_id long, q long, score double, vec_id long, own boolean")
    query = Window.partitionBy("query_id", "q")
    best = found.withColumn("n", F.row_number().over(query.orderBy(F.desc("score"), "vec_id", F.desc("own")))) \
        .filter(F.col("n") <= k + 1)
    best = best.withColumn("self", F.coalesce(F.min(F.when(F.col("own"), F.col("n"))).over(query), F.lit(k + 1)))
    return best.filter("n <> self").select(
        "query_id", (F.col("n") - F.when(F.col("n") > F.col("self"), 1).otherwise(0)).cast("int").alias("rank"),
        "vec_id", "score")

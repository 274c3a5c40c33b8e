"""Product codes of vectors, with a GNAT over each codebook's entries.

Vectors become integers and are cut into parts; every part position has a
codebook that starts from the first vectors and is moved by rounds of
assignment and integer means. The nearest entry of a part is found in a
geometric near-neighbour access tree over the entries: a node's split points
store, for every child, the range of distances from each split point to the
entries below that child, and a query's distance to a split point eliminates a
child whose range lies strictly beyond what could still be as near as the best
entry so far. Distances are compared as exact integers; square roots, needed
for the triangle inequality, are rounded away from elimination, so that an
entry at equal distance with a lower index is never lost.

A round reads the table once: every task adds up its own parts (as many rows
as there are entries, whatever the table's size), partial sums meet in one
aggregate, and the driver holds the codebooks only.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.llm.common import bounded
from quincena.session import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
LIMIT = 65_536.0     # components from here on are taken as not finite: squares of their integers leave 64 bits
DEGREE = 16          # split points of a node
SLACK = 1e-12        # far above the rounding of a square root and a sum


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, as 64-bit integers."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    if 4 * top * top * x.shape[1] < 1 << 53:  # every sum below is an integer that a double holds
        a, b = x.astype(np.float64), y.astype(np.float64)
        d = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
        return d.astype(np.int64)
    out = np.zeros((len(x), len(y)), np.int64)
    for i in range(x.shape[1]):
        step = x[:, i, None] - y[None, :, i]
        out += step * step
    return out


class Gnat:
    """Tree over the rows of ``entries`` (integers)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._node(np.arange(len(entries)))

    def _node(self, members: np.ndarray):
        """(split indexes, children, low, high): ``low[j, i]`` and ``high[j, i]``
        bound the distances from split j to the entries of child i."""
        if len(members) <= DEGREE:
            return members, [], None, None
        chosen = [0]  # each split point is the member farthest from those before it
        nearest = squares(self.entries[members], self.entries[members[:1]])[:, 0]
        while len(chosen) < DEGREE:
            at = int(np.argmax(nearest))
            if at in chosen:  # only copies are left: any others will do
                at = next(i for i in range(len(members)) if i not in chosen)
            chosen.append(at)
            nearest = np.minimum(nearest, squares(self.entries[members], self.entries[members[at:at + 1]])[:, 0])
        splits = members[chosen]
        rest = np.delete(members, chosen)
        apart = squares(self.entries[rest], self.entries[splits])
        home = np.argmin(apart, axis=1)
        root = np.sqrt(apart.astype(np.float64))
        children, low, high = [], [], []
        for i in np.unique(home):
            below = home == i
            children.append(self._node(rest[below]))
            low.append(root[below].min(axis=0) * (1 - SLACK))
            high.append(root[below].max(axis=0) * (1 + SLACK))
        return splits, children, np.array(low).T, np.array(high).T

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of every row; ties
        go to the lower index."""
        best = np.full(len(x), np.iinfo(np.int64).max)
        index = np.full(len(x), len(self.entries))
        waiting = [(self.root, np.arange(len(x)), None)]
        while waiting:
            (splits, children, low, high), rows, bounds = waiting.pop()
            if bounds is not None:  # again, with what has been found since
                rows = rows[self._open(best[rows], *(b[rows] for b in bounds))]
                if not len(rows):
                    continue
            order = np.argsort(splits)  # of equal distances the first is the lowest index
            d = squares(x[rows], self.entries[splits[order]])
            at = d.argmin(axis=1)
            near, which = d[np.arange(len(rows)), at], splits[order][at]
            better = (near < best[rows]) | ((near == best[rows]) & (which < index[rows]))
            best[rows[better]], index[rows[better]] = near[better], which[better]
            if not children:
                continue
            away = np.empty((len(rows), len(splits)))
            away[:, order] = np.sqrt(d.astype(np.float64))
            for i, child in enumerate(children):
                # The least that the best distance may be for the child to be open, over all split points.
                least = np.maximum(away * (1 - SLACK) - high[:, i], low[:, i] - away * (1 + SLACK)).max(axis=1)
                open_ = self._open(best[rows], least)
                if open_.any():
                    spread = np.empty(len(x))
                    spread[rows] = least
                    waiting.append((child, rows[open_], (spread,)))
        return index, best

    @staticmethod
    def _open(best: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Not eliminated: only what is strictly farther than the best is."""
        return least <= np.sqrt(best.astype(np.float64)) * (1 + SLACK)


def integer_vectors(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, vec_id: str = "vec_id",
                    embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, cells`` of the rows that are kept, written once."""
    x = F.col(embedding)
    ok = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < LIMIT)) & (F.size(x) > 0) & (F.size(x) % parts == 0)
    cells = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("int"))
    rows = materialize(vectors.filter(F.coalesce(ok, F.lit(False))).select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), cells.alias("cells")), "integer-vectors")
    first = F.struct(F.col("vec_id").isNull(), "vec_id", F.size("cells"))
    dim = rows.agg(F.min_by(F.size("cells"), first)).first()[0]
    return rows if dim is None else rows.filter(F.size("cells") == dim)


def _cells(batch, parts: int) -> np.ndarray:
    """Rows x parts x width."""
    cells = batch.column("cells")
    return cells.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(cells), parts, -1)


def _sums(books: np.ndarray):
    parts, entries, width = books.shape

    def run(batches):
        import pyarrow as pa

        trees = [Gnat(b) for b in books]
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            x = _cells(batch, parts)
            for p, tree in enumerate(trees):
                index, _ = tree.nearest(x[:, p])
                np.add.at(total[p, :, 1:], index, x[:, p])
                total[p, :, 0] += np.bincount(index, minlength=entries)
        part, entry = np.nonzero(total[:, :, 0])
        used = total[part, entry]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), *(pa.array(c) for c in used.T)],
            names=["part", "entry", "n", *(f"s{i}" for i in range(width))])

    return run


def trained(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x width) after ``rounds`` rounds."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "cells").limit(entries).select("cells").collect()
    if not first:
        return np.empty((parts, 0, 0), np.int64)
    books = np.array([r.cells for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    width = books.shape[2]
    names = ["n", *(f"s{i}" for i in range(width))]
    schema = "part long, entry long, " + ", ".join(f"{c} long" for c in names)
    for _ in range(rounds):
        sums = bounded(rows.select("cells")).mapInArrow(_sums(books), schema).groupBy("part", "entry").agg(
            *(F.sum(c).alias(c) for c in names))
        moved = books.copy()
        for part, entry, n, *s in sums.collect():  # one row an entry at most
            moved[part, entry] = [x // n for x in s]
        books = moved
    return books


def _codes(books: np.ndarray):
    def run(batches):
        import pyarrow as pa

        trees = [Gnat(b) for b in books]
        for batch in batches:
            x = _cells(batch, len(trees))
            index, error = zip(*(t.nearest(x[:, p]) for p, t in enumerate(trees)), strict=True)
            codes = ["".join(f"{e:02x}" for e in row) for row in np.stack(index, axis=1).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                 pa.array(np.sum(error, axis=0))], names=["vec_id", "label", "code", "error"])

    return run


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all entries' components, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every row kept.

    Dropped are vectors that are null, empty or hold null or non-finite
    components (or such of 65,536 and more, whose squares leave 64 bits), and
    those whose length is no multiple of ``parts`` or differs from that of the
    row with the smallest id: one codebook has one width. Repeated rows are
    rows of their own, an id that repeats starts the codebook in the order of
    its vectors, null ids come last. With fewer rows than ``entries`` the
    codebooks are smaller; an empty table gives an empty one. Other columns
    are left out. ``label_error`` sums over equal labels, nulls together."""
    rows = integer_vectors(vectors, scale, parts, vec_id, embedding, label)
    books = trained(rows, parts, entries, rounds)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    coded = materialize(bounded(rows).mapInArrow(_codes(books), f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long"),
                        "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["of"])).select(
        "vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))

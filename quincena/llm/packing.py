"""Packing documents into training sequences: first-fit decreasing.

A document (its token ids and a closing id) is cut into pieces of at most the
sequence length. Pieces go, by a hash of the document, to random groups of
bounded size, and every group is packed on its own: pieces from long to
short, each into the first sequence with room. A tournament tree over the
sequences' free room finds that sequence in logarithmic time. Groups are
independent, so there is no global sort, and with thousands of pieces in each
the loss against packing all at once is a fraction of one sequence a group."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.llm.common import arrow_slices, bounded
from quincena.llm.ids import id_encoder, merge_ranks

LENGTH = 1024
GROUP_DOCUMENTS = 4096


class FirstFit:
    """Bins of ``capacity``, opened as needed; a tournament tree keeps the
    most free room below each node."""

    def __init__(self, capacity: int, items: int):
        self.capacity = capacity
        self.leaves = 1 << max(0, items - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """(bin, room used in it before) for an item: the first bin it fits."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        used = self.capacity - room[node]
        room[node] -= size
        at = node
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return at - self.leaves, used


def first_fit_decreasing(sizes: list[int], capacity: int = LENGTH) -> list[tuple[int, int]]:
    """(sequence, offset) of every item; ties keep the items' order."""
    tree, out = FirstFit(capacity, len(sizes)), [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        out[i] = tree.put(sizes[i])
    return out


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = 0, with_ids: bool = False,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document as pieces of at most ``length`` ids:
    ``doc_id, row, start, length, ids_crc32, doc_tokens`` and with
    ``with_ids`` the ``ids`` themselves (binary). ``row`` is the number by
    which documents are dealt to groups; repeated rows have different ones."""
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       F.xxhash64(F.monotonically_increasing_id()).alias("row"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    by_ranks = merge_ranks(path) is not None

    def run(batches):
        import numpy as np
        import pyarrow as pa

        encode, end = id_encoder(path, by_ranks), np.array([end_id], np.uint32)
        for part in arrow_slices(batches, "text"):
            whole = encode(part.column("text").to_pylist())
            size = np.array([len(ids) + 1 for ids in whole], np.int64)
            ids = np.concatenate([x for one in whole for x in (one, end)]).astype("<u4")
            count = -(-size // length)
            doc = np.repeat(np.arange(len(whole)), count)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * length
            held = np.minimum(length, size[doc] - start)
            at = np.concatenate([[0], np.cumsum(held)])  # pieces follow one another as the ids do
            raw, cut = memoryview(ids).cast("B"), (4 * at).tolist()
            crc = [zlib.crc32(raw[lo:hi]) for lo, hi in zip(cut, cut[1:], strict=False)]
            columns = [part.column("doc_id").take(pa.array(doc)), part.column("row").take(pa.array(doc)), pa.array(start),
                       pa.array(held), pa.array(crc, pa.int64()), pa.array(size[doc])]
            if with_ids:
                columns.append(pa.array([raw[lo:hi].tobytes() for lo, hi in zip(cut, cut[1:], strict=False)], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)

    return bounded(rows).mapInArrow(run, f"doc_id {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long"
                           + ", ids binary" * with_ids)


def pack(cut: DataFrame, n_documents: int, capacity: int = LENGTH,
         group_documents: int = GROUP_DOCUMENTS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (``row``, ``start`` and
    ``length`` columns; ``row`` is dropped).

    Groups hold ``group_documents`` documents on average however many there
    are: their number follows from ``n_documents``. Pieces that fill a
    sequence go through the same tree and get one of their own. The order
    of ties is (row, start). An empty table gives an empty one."""
    groups = max(1, -(-n_documents // group_documents))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("row", F.lit(17), F.col("start")), F.lit(groups)))
    names = [c for c in cut.columns if c != "row"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema if f.name != "row")

    def run(table):
        import pyarrow as pa

        table = table.sort_by([("length", "descending"), ("row", "ascending"), ("start", "ascending")])
        placed = first_fit_decreasing(table.column("length").to_pylist(), capacity)
        group = table.column("group")[0].as_py()
        out = table.select(names)
        out = out.append_column("sequence_id", pa.array([(group << 32) + s for s, _ in placed], pa.int64()))
        return out.append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    return dealt.groupBy("group").applyInArrow(run, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = 0, with_ids: bool = False,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence and place in it:
    ``doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset``.

    A null text is an empty one: a piece with the closing id alone. Very long
    texts are cut into many pieces, which go to many groups. Repeated rows and
    null ids are documents like others; other columns are left out."""
    return pack(pieces(docs, path, length, end_id, with_ids, doc_id, text), docs.count(), length)

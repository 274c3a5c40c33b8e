"""Repeated passages, found through difference-cover anchors.

D is a difference cover modulo v: for any residues a and b some shift d < v
has both a + d and b + d in D (mod v). So when a passage of ``window`` words
stands at two places, one of its first v shifts is a cover position of both,
and the run of ``window - v + 1`` words that starts there (the anchor) lies
within both. Only runs at cover positions, a quarter of all, are hashed and
compared over the corpus; a repeated anchor then extends to the windows around
it, and only those are compared as whole windows.

Both comparisons go the same way. A worker hashes a slice of texts, keeps one
entry for each different hash of the slice (a passage in a third of all
documents is one entry a slice), and deals entries by hash to buckets. A
bucket answers which entries have a like elsewhere. Answers go back to the
buckets of documents, and documents meet them there. Bucket counts grow with
the bytes of the input; the documents' buckets ("homes") are smaller and more,
so that those which fall to one task by chance are a small part of it.

Rows that repeat another one (id and text) need no comparison: every window of
theirs stands elsewhere. One of each takes part for the sake of the others.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.llm.common import (U64, arrow_slices, bounded, give_back, hash_words, row_key, run_hashes, slices, text_bytes,
                                 utf8, words_of)
from quincena.session import materialize

WINDOW = 35
# A difference cover modulo 21 with as few members as can be.
PERIOD, COVER = 21, (3, 6, 7, 12, 14)
BUCKET_BYTES = 16 << 20
HOMES_PER_BUCKET = 4

ENTRIES = "bucket int, h binary, h2 binary, key binary, n binary, at binary, many binary"
MARKS = "home int, key binary, n binary, at binary"


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket from the high bits (the low ones tell entries of a bucket apart)."""
    return ((hashes >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int32)


def _spans(values: np.ndarray):
    """(from, to) of each run of equal neighbours."""
    if len(values):
        first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        yield from zip(first.tolist(), [*first[1:].tolist(), len(values)], strict=True)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run-length form."""
    if not len(values):
        return values, np.empty(0, np.uint32)
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return values[first], np.diff(np.r_[first, len(values)]).astype(np.uint32)


def _planes(at: np.ndarray) -> bytes:
    """32-bit places with their low bytes first, then the next ones: the high
    planes are all but empty and take no room in a compressed shuffle."""
    return np.ascontiguousarray(at.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _places_of(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _entries(h: np.ndarray, h2: np.ndarray | None, key: np.ndarray, at: np.ndarray, buckets: int, homes: int):
    """Rows of ENTRIES for the occurrences of a slice: one entry for each
    hash. A hash with several occurrences in the slice needs no answer for
    them: they go out as marks (rows of negative bucket, by home) at once, and
    its entry says ``many``."""
    import pyarrow as pa

    order = np.argsort(h, kind="stable") if h2 is None else np.lexsort((h2, h))
    same = h[order][1:] == h[order][:-1]
    if h2 is not None:
        same &= h2[order][1:] == h2[order][:-1]
    first = np.r_[True, ~same] if len(h) else np.empty(0, bool)
    inner = np.zeros(len(h), bool)  # occurrences with a like in this slice
    inner[1:] |= same
    inner[:-1] |= same
    one = order[first]
    many = np.zeros(len(h), bool)
    many[order] = inner
    entry = np.sort(one)  # by document and place: keys come in runs
    bucket = _bucket(h[entry], buckets)
    by = np.argsort(bucket, kind="stable")
    entry, bucket = entry[by], bucket[by]
    out = {c: [] for c in ("bucket", "h", "h2", "key", "n", "at", "many")}
    for lo, hi in _spans(bucket):
        e = entry[lo:hi]
        keys, n = _runs(key[e])
        out["bucket"].append(int(bucket[lo]))
        out["h"].append((h[e] if h2 is not None else h[e].astype(np.uint32)).tobytes())
        out["h2"].append(h2[e].astype(np.uint32).tobytes() if h2 is not None else None)
        out["key"].append(keys.tobytes())
        out["n"].append(n.tobytes())
        out["at"].append(_planes(at[e]))
        out["many"].append(np.packbits(many[e]).tobytes())
    inside = np.flatnonzero(many)
    for home, keys, n, places in _by_home(key[inside], at[inside], homes):
        out["bucket"].append(-1 - home)
        out["key"].append(keys)
        out["n"].append(n)
        out["at"].append(places)
        for c in ("h", "h2", "many"):
            out[c].append(None)
    kinds = [pa.int32()] + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)],
                                      names=list(out))


def _by_home(key: np.ndarray, at: np.ndarray, homes: int):
    """(home, keys, run lengths, places) of each bucket of documents."""
    home = _bucket(key.view(U64), homes)
    order = np.lexsort((at, key, home))
    key, at, home = key[order], at[order], home[order]
    for lo, hi in _spans(home):
        keys, n = _runs(key[lo:hi])
        yield int(home[lo]), keys.tobytes(), n.tobytes(), _planes(at[lo:hi])


def _unpack(table) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) of rows with run-length keys."""
    keys = np.concatenate([np.frombuffer(b, np.int64) for b in table.column("key").to_pylist()] or [np.empty(0, np.int64)])
    n = np.concatenate([np.frombuffer(b, np.uint32) for b in table.column("n").to_pylist()] or [np.empty(0, np.uint32)])
    at = np.concatenate([_places_of(b) for b in table.column("at").to_pylist()] or [np.empty(0, np.uint32)])
    return np.repeat(keys, n), at


def _answer(homes: int):
    """For one bucket: the places whose hash stands elsewhere too."""
    def run(table):
        import pyarrow as pa

        key, at = _unpack(table)
        if table.column("bucket")[0].as_py() >= 0:
            wide = table.column("h2")[0].as_py() is not None
            h = np.concatenate([np.frombuffer(b, U64 if wide else np.uint32) for b in table.column("h").to_pylist()])
            many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=len(a) // 4).astype(bool) for m, a in
                                   zip(table.column("many").to_pylist(), table.column("at").to_pylist(), strict=True)])
            if wide:
                h2 = np.concatenate([np.frombuffer(b, np.uint32) for b in table.column("h2").to_pylist()])
                order = np.lexsort((h2, h))
                same = (h[order][1:] == h[order][:-1]) & (h2[order][1:] == h2[order][:-1])
            else:
                order = np.argsort(h, kind="stable")
                same = h[order][1:] == h[order][:-1]
            repeated = np.zeros(len(h), bool)
            repeated[1:] |= same
            repeated[:-1] |= same
            hit = np.zeros(len(h), bool)
            hit[order] = repeated
            hit &= ~many  # those marked their places before
            key, at = key[hit], at[hit]
        rows = list(_by_home(key, at, homes))
        return pa.table({"home": pa.array([r[0] for r in rows], pa.int32()),
                         **{c: pa.array([r[i] for r in rows], pa.binary()) for i, c in ((1, "key"), (2, "n"), (3, "at"))}})

    return run


def _concatenated(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes of all texts, words of each, start of each)."""
    words, counts = [], []
    for t in texts:
        w = words_of(t)
        words += w
        counts.append(len(w))
    n = np.array(counts, np.int64)
    return hash_words(words), n, np.cumsum(n) - n


def _anchors(window: int, buckets: int, homes: int):
    length = window - PERIOD + 1
    covered = np.zeros(PERIOD, bool)
    covered[list(COVER)] = True

    def run(batches):
        for part in arrow_slices(batches, "text"):
            h, n, start = _concatenated(part.column("text").to_pylist())
            long = np.flatnonzero(n >= window)  # others hold no window
            if not len(long):
                continue
            runs = run_hashes(h, length)
            # Places of the cover in each document, with room for the run.
            doc = np.repeat(long, n[long] - length + 1)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(n[long] - length + 1) - (n[long] - length + 1),
                                                 n[long] - length + 1)
            use = covered[at % PERIOD]
            doc, at = doc[use], at[use]
            key = part.column("key").to_numpy()[doc]
            yield _entries(runs[start[doc] + at], None, key, at, buckets, homes)

    return run


def _near(anchors: np.ndarray, n: int, window: int) -> np.ndarray:
    """Starts of the windows that hold a repeated anchor within their first shifts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.maximum(anchors - (PERIOD - 1), 0), 1)
    np.add.at(edge, np.minimum(anchors + 1, n), -1)
    return np.flatnonzero(np.cumsum(edge)[:max(0, n - window + 1)] > 0)


def _places(marks) -> dict[int, np.ndarray]:
    """Key -> places, of one home's marks."""
    key, at = _unpack(marks)
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order].astype(np.int64)
    return {int(key[lo]): at[lo:hi] for lo, hi in _spans(key)}


def _windows(window: int, buckets: int, homes: int):
    """Cogrouped documents and repeated anchors of one home: entries for whole windows."""
    def run(docs, marks):
        import pyarrow as pa

        give_back()  # what the group before this one held
        places = _places(marks)
        keys = docs.column("_key").to_pylist()
        rows = [i for i, k in enumerate(keys) if k in places]
        texts = docs.column("_text").take(pa.array(rows, pa.int64()))
        out = []
        sizes = [len(x.as_buffer()) for x in texts]
        for lo, hi in slices(sizes):
            h, n, start = _concatenated(texts.slice(lo, hi - lo).to_pylist())
            found = [_near(places[keys[rows[lo + i]]], int(n[i]), window) for i in range(hi - lo)]
            each = np.array([len(f) for f in found])
            if not each.sum():
                continue
            at = np.concatenate(found)
            spot = at + np.repeat(start, each)
            key = np.repeat(np.array([keys[rows[lo + i]] for i in range(hi - lo)], np.int64), each)
            first, second = run_hashes(h, window), run_hashes(h, window, 0x5BD1E995) >> U64(32)
            out.append(_entries(first[spot], second[spot], key, at, buckets, homes))
        names = [x.split()[0] for x in ENTRIES.split(", ")]
        kinds = [pa.int32()] + [pa.binary()] * 6
        return pa.Table.from_batches(out, pa.schema(list(zip(names, kinds, strict=True))))

    return run


def _rewrite(window: int, columns: list[str]):
    """Cogrouped documents and repeated windows of one home: what is left of each text."""
    def run(docs, marks):
        import pyarrow.compute as pc

        give_back()  # what the group before this one held
        places = _places(marks)
        docs = docs.filter(pc.invert(docs.column("_stand_in")))
        texts, sizes, removed, digests = [], [], [], []
        for key, text in zip(docs.column("_key").to_pylist(), docs.column("_text").to_pylist(), strict=True):
            words = words_of(text)
            starts = places.get(key)
            gone = 0
            kept = words
            if starts is not None:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + window, -1)
                out = np.cumsum(edge)[:-1] > 0
                gone = int(out.sum())
                kept = [w for w, drop in zip(words, out.tolist(), strict=True) if not drop]
            joined = b" ".join(kept)
            texts.append(joined if gone else text)
            sizes.append(len(words))
            removed.append(gone)
            digests.append(hashlib.sha256(joined).hexdigest())
        return _with_results(docs.select(columns), texts, sizes, removed, digests)

    return run


def _with_results(table, texts: list, sizes: list, removed: list, digests: list):
    """An Arrow table of rows with the results beside their columns."""
    import pyarrow as pa

    for name, values, kind in (("kept_text", texts, pa.binary()), ("n_words", sizes, pa.int64()),
                               ("n_removed", removed, pa.int64()), ("kept_sha256", digests, pa.string())):
        table = table.append_column(name, pa.array(values, kind))
    return table


def _repeated(window: int, columns: list[str]):
    """Rows that stand more than once: all words go where a window fits, else none."""
    def run(batches):
        import pyarrow as pa

        for part in arrow_slices(batches, "_text"):
            texts = part.column("_text").to_pylist()
            words = [words_of(t) for t in texts]
            gone = [len(w) if len(w) >= window else 0 for w in words]
            left = [b"" if g else b" ".join(w) for w, g in zip(words, gone, strict=True)]
            kept = [b"" if g else t for t, g in zip(texts, gone, strict=True)]
            yield from _with_results(pa.Table.from_batches([part]).select(columns), kept, [len(w) for w in words], gone,
                                     [hashlib.sha256(x).hexdigest() for x in left]).to_batches()

    return run


RESULTS = ("kept_text", "n_words", "n_removed", "kept_sha256")


def remove_repeats(docs: DataFrame, window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """``docs`` with ``kept_text, n_words, n_removed, kept_sha256`` added.

    Words are runs of characters other than ASCII blanks. Every word is
    removed that some window of ``window`` words covers whose word sequence
    also starts anywhere else (in the same document too); all windows are
    judged on the input. ``kept_text`` is the text itself where nothing went,
    else the kept words joined by one space; ``kept_sha256`` is always of the
    kept words so joined. A null text has no words. Documents shorter than
    the window lose nothing. Repeated rows count as repeats of each other.
    Columns of ``docs`` with the names of the results are replaced by them;
    columns of any other name pass through. An empty table gives an empty one.

    Rows are told apart by a 64-bit hash of id and text, windows by 96 bits."""
    if window < PERIOD + 4:
        raise ValueError(f"windows of at least {PERIOD + 4} words")
    columns = [c for c in docs.columns if c not in RESULTS]
    carried = [f"c{i}" for i in range(len(columns))]
    buckets = max(16, -(-text_bytes(docs, text) // bucket_bytes))
    homes = buckets * HOMES_PER_BUCKET
    rows = bounded(docs).select(*[docs[f"`{c}`"].alias(n) for c, n in zip(columns, carried, strict=True)],
                                row_key(doc_id, text).alias("_key"), utf8(text).alias("_text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*carried).schema)
    kinds += ", kept_text binary, n_words long, n_removed long, kept_sha256 string"

    repeated = materialize(rows.groupBy("_key").count().filter("count > 1").select("_key"), "repeated-rows")
    some = bool(repeated.limit(1).count())
    placed = rows.withColumn("_stand_in", F.lit(False))
    if some:
        copies = rows.join(repeated, "_key", "left_semi")
        # Dealt anew before they are reduced, so that one row that stands very often is no task's alone.
        one = materialize(copies.select("_key", "_text").hint("rebalance").dropDuplicates(["_key"]), "stand-ins")
        placed = rows.join(repeated, "_key", "left_anti").withColumn("_stand_in", F.lit(False)).unionByName(
            one.withColumn("_stand_in", F.lit(True)), allowMissingColumns=True)
    home = F.shiftrightunsigned(F.shiftrightunsigned("_key", 32) * F.lit(homes), 32).cast("int")
    at_home = placed.withColumn("home", home).groupBy("home")

    anchors = placed.select(F.col("_key").alias("key"), F.col("_text").alias("text")) \
        .mapInArrow(_anchors(window, buckets, homes), ENTRIES).groupBy("bucket").applyInArrow(_answer(homes), MARKS)
    windows = at_home.cogroup(anchors.groupBy("home")).applyInArrow(_windows(window, buckets, homes), ENTRIES)
    repeats = windows.groupBy("bucket").applyInArrow(_answer(homes), MARKS)
    out = at_home.cogroup(repeats.groupBy("home")).applyInArrow(_rewrite(window, carried), kinds)
    if some:
        out = out.unionByName(copies.select(*carried, "_text").mapInArrow(_repeated(window, carried), kinds))
    return out.select(*[F.col(n).alias(c) for c, n in zip(columns, carried, strict=True)],
                      F.col("kept_text").cast("string").alias("kept_text"), "n_words", "n_removed", "kept_sha256")

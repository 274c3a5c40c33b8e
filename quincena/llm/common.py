"""Helpers shared by the operators: byte-sized slices of Arrow batches, word
hashes, hashes of runs of words, and the columns an operator works on."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
WORD_MEMO = 200_000
U64 = np.uint64


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(text: str = "text") -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit key of a row made from its id and text. Rows that repeat both
    share it, and every operator treats such rows alike."""
    return F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit("")))


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts: the size from which bucket counts follow."""
    return df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def slices(sizes: Iterable[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about ``limit`` bytes each; an item
    larger than that is a range of its own."""
    lo = total = n = 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > limit:
            yield lo, i
            lo, total = i, 0
        total += size
        n = i + 1
    if n > lo:
        yield lo, n


def arrow_slices(batches, column: str | int, limit: int = SLICE_BYTES):
    """Slices of Arrow batches holding about ``limit`` bytes of ``column`` each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        for lo, hi in slices(_lengths(batch.column(column)), limit):
            yield batch.slice(lo, hi - lo)
    give_back()


def give_back() -> None:
    """Hand memory that is free but held (Arrow's pool, the C library's) back
    to the system at a task's end: workers outlive tasks and stages."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no such call outside glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _lengths(array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(array), 0).to_pylist()


class WordHash(dict):
    """Word -> stable 64-bit hash, remembered for up to ``WORD_MEMO`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_kept: dict = {}


def kept(key, make):
    """What a worker process keeps from task to task (a tokenizer, a memo).
    Only that of the operator at work stays: a job of many stages then needs
    the memory of its largest stage, not of all of them."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def byte_string(text: str) -> int:
    """Bytes of a Spark size (``64m``, ``1gb``, ``1048576``)."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)i?b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose rows will go to Python in batches of about ``BATCH_BYTES``
    at most: the session's bound on bytes is lowered to that, since its bound
    on rows says little of texts. The session keeps the lower bound, since the
    plan runs later; a lower one that it has already stays."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < byte_string(conf.get(name)) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def words_of(text: bytes) -> list[bytes]:
    """Runs of bytes other than ASCII blanks (space, tab to carriage return)."""
    return text.split()


def hash_words(words: list[bytes]) -> np.ndarray:
    memo = kept("words", WordHash)
    return np.fromiter(map(memo.__getitem__, words), U64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finish)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _combine(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return mix64((a * U64(0x9E3779B97F4A7C15)) ^ (b + U64(salt)))


def run_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``length`` consecutive words (one for each start
    at which a whole run fits): runs of 1, 2, 4, ... words are joined pairwise."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, U64)
    power = mix64(words + U64(seed))
    out, at, size = None, 0, 1
    while True:
        if length & size:
            part = power[at:at + n]
            out = part if out is None else _combine(out, part, length)
            at += size
        if size * 2 > length:
            return out
        power = _combine(power[:-size], power[size:], size)
        size *= 2


def starts_within(counts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which starts of concatenated documents (of ``counts`` words) leave room
    for ``length`` words in their own document; an array over all starts at
    which a run fits into the concatenation."""
    n = max(0, total - length + 1)
    ok = np.ones(n, bool)
    for end in np.cumsum(counts)[:-1]:
        ok[max(0, end - length + 1):min(n, end)] = False
    return ok

"""Token counts: lengths of encodings, without the ids leaving the worker.

Arrow batches are cut into slices of equal bytes; long texts are cut at
boundaries that no token crosses (see ``chunks``), and the counts of the
chunks that a worker has met before are remembered. What is new in a slice
goes to the tokenizer library in one batch call."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.llm.chunks import Remembered
from quincena.llm.common import arrow_slices, bounded, kept


def library_tokenizer(path: str):
    """A ``tokenizers`` file, single-threaded: Spark runs one task a core."""
    return kept(("tokenizer", path), lambda: _tokenizer(path))


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def cuts_at_blanks(path: str) -> bool:
    """Whether texts may be cut before a space behind a non-blank: true of
    byte-level files with the standard split, no normaliser, and added tokens
    that neither hold blanks nor take them from their neighbours."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and not spec.get("post_processor")
            and all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() for c in t["content"])
                    for t in spec.get("added_tokens", [])))


def counter(path: str):
    """texts -> counts."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    tokenizer = library_tokenizer(path)

    def lengths(texts):
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    if not cuts_at_blanks(path):
        return lengths
    memory = Remembered(lengths)
    return lambda texts: list(map(sum, memory.look_up(texts)))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row.

    ``path``: a ``.json`` file of tokenizers or a ``.model`` file of
    sentencepiece. No begin, end or added special tokens; special strings
    inside texts as the library takes them by default. A null text counts as
    empty (0 bytes, 0 tokens); repeated and null ids keep their rows; an empty
    table gives an empty one. No shuffle; memory is bounded by a slice of
    texts and the remembered chunks."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        count = kept(("counts", path), lambda: counter(path))
        for part in arrow_slices(batches, "text"):
            texts = part.column("text")
            n = count(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return bounded(rows).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")

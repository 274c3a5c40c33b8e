"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the document is labelled. A
sentence's probability is a logistic function of its words; the document's is
their noisy-or, 1 - prod(1 - p). The gradient of the document's log-likelihood
flows to the sentences that explain it, so the fitted model also says which
sentences offend. Sentences meet as sums of log(1 - p).

Each clean sentence adds a little to that sum, so that clean text would be
rejected for its length alone. The bias therefore falls with the number of
sentences: labelled clean documents that a model of the other half of the
sample has not seen say how much a clean sentence adds, and a document's bias
is lowered until as many clean sentences as it has add up to a small share of
what rejects a document.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.llm.common import WORD_MEMO, arrow_slices, bounded, kept, utf8

FEATURES = 1 << 18
RIDGE = 2e-4
# The training sample: this many documents of each class at most, of at most this many bytes.
PER_CLASS, TRAIN_BYTES = 2000, 1 << 16
# Lengths (bytes) of the beginnings of words that are features.
STEMS = (4, 5, 6, 7, 8, 9)
HELD_OUT = 5
# What the clean sentences of a document may add up to, on average, as a share of what rejects it (ln 2). By Markov's
# inequality at most this share of clean documents is rejected, whatever their length.
CLEAN_SHARE = 0.1
# Lengths, as powers of two of sentences, for which the lowering of the bias is known; between them it is interpolated.
LENGTHS = 41

# Sentence ends become line feeds, other ASCII punctuation blanks, A-Z lower case; lengths stay.
_FOLD = bytes(10 if chr(b) in ".!?\n\r" else b + 32 if 65 <= b <= 90 else 32 if b < 128 and not chr(b).isalnum() else b
              for b in range(256))


def sentences(text: bytes) -> list[list[bytes]]:
    """Words of each sentence (some may have none)."""
    return [s.split() for s in text.translate(_FOLD).split(b"\n")]


def features(word: bytes) -> list[int]:
    """A word speaks by itself and by its beginnings, which stand for its
    stem: hashed to FEATURES places."""
    parts = [b"=" + word] + [word[:n] for n in STEMS if len(word) >= n]
    return [xxhash.xxh64_intdigest(p) & (FEATURES - 1) for p in parts]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, one for each feature
    bias: float
    lowered: np.ndarray = field(default_factory=lambda: np.zeros(LENGTHS))  # of the bias, for 1, 2, 4, ... sentences


class _Weights(dict):
    """Word -> weight, for up to WORD_MEMO words."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= WORD_MEMO:
            self.clear()
        w = self[word] = float(self.weights[features(word)].sum())
        return w


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit(vocabulary: list[bytes], words: np.ndarray, sentence_sizes: np.ndarray, bag_sizes: np.ndarray,
        labels: np.ndarray, importance: np.ndarray, rounds: int = 200, rate: float = 0.05, ridge: float = RIDGE,
        least_documents: int = 3) -> Model:
    """Noisy-or model by full gradient steps (Adam).

    ``words`` are places in ``vocabulary``, the sentences of all bags one
    after another; no sentence and no bag is empty. Features in fewer than
    ``least_documents`` bags keep weight 0. With labels of one kind the model
    finds nothing."""
    w, bias = np.zeros(FEATURES), -4.0
    y, weight = labels.astype(float), importance
    if not len(y) or y.min() == y.max():
        return Model(w.astype(np.float32), bias)
    n_features = np.array([1 + sum(len(v) >= n for n in STEMS) for v in vocabulary])
    flat = np.fromiter((f for v in vocabulary for f in features(v)), np.int32, n_features.sum())
    word_at = np.cumsum(n_features) - n_features
    sentence_at = np.cumsum(sentence_sizes) - sentence_sizes
    bag_at = np.cumsum(bag_sizes) - bag_sizes
    seen = np.zeros(FEATURES, np.int32)
    ends = np.cumsum(np.add.reduceat(sentence_sizes, bag_at))
    for lo, hi in zip([0, *ends[:-1]], ends, strict=True):  # a bag at a time, to stay small
        seen[np.unique(np.concatenate([flat[word_at[w]:word_at[w] + n_features[w]] for w in np.unique(words[lo:hi])]))] += 1
    frozen = seen < least_documents
    weight = weight / weight.sum()
    m, v = np.zeros(FEATURES), np.zeros(FEATURES)
    mb = vb = 0.0
    for step in range(1, rounds + 1):
        z = np.add.reduceat(np.add.reduceat(w[flat], word_at)[words], sentence_at) + bias
        total = np.maximum(np.add.reduceat(_softplus(z), bag_at), 1e-12)  # -log of the chance that no sentence offends
        d_total = weight * (1 - y - y / np.expm1(np.minimum(total, 50)))
        d_z = np.repeat(d_total, bag_sizes) * np.exp(-_softplus(-z))
        by_word = np.bincount(words, np.repeat(d_z, sentence_sizes), len(vocabulary))
        g = np.bincount(flat, np.repeat(by_word, n_features), FEATURES) + ridge * w
        g[frozen] = 0
        gb = d_z.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9 ** step, 1 - 0.99 ** step
        w -= rate * (m / a) / (np.sqrt(v / b) + 1e-9)
        bias -= rate * (mb / a) / (np.sqrt(vb / b) + 1e-9)
    return Model(w.astype(np.float32), float(bias))


def lowering(z: np.ndarray) -> np.ndarray:
    """How far the bias falls for 1, 2, 4, ... sentences, where ``z`` are the
    logits of clean sentences: the least fall (by bisection) at which that many
    add ``CLEAN_SHARE`` of ln 2 on average."""
    low, high = np.zeros(LENGTHS), np.full(LENGTHS, max(0.0, float(z.max())) + 50)
    most = CLEAN_SHARE * np.log(2) / 2.0 ** np.arange(LENGTHS)
    value, times = np.unique(np.round(z, 2), return_counts=True)  # a few thousand values, however many sentences
    share = times / times.sum()

    def too_much(fall):
        return np.array([share @ _softplus(value - f) for f in fall]) > most

    at_once = ~too_much(low)
    for _ in range(30):
        middle = (low + high) / 2
        over = too_much(middle)
        low, high = np.where(over, middle, low), np.where(over, high, middle)
    return np.where(at_once, 0.0, high)


def calibrated(vocabulary: list[bytes], words: np.ndarray, sentence_sizes: np.ndarray, bag_sizes: np.ndarray,
               labels: np.ndarray, importance: np.ndarray) -> Model:
    """``fit`` on all bags, its bias lowered by what a model of every other
    bag of each class says of the clean bags it has not seen. With fewer than
    two bags of a class the whole model's own bags are asked."""
    model = fit(vocabulary, words, sentence_sizes, bag_sizes, labels, importance)
    if not len(labels) or labels.min() == labels.max():
        return model
    half = np.zeros(len(labels), bool)
    for c in (0, 1):
        half[np.flatnonzero(labels == c)[::2]] = True
    judge, unseen = model, labels == 0
    if min((labels == c).sum() for c in (0, 1)) > 1:
        sentence = np.repeat(half, bag_sizes)
        some, again = np.unique(words[np.repeat(sentence, sentence_sizes)], return_inverse=True)
        judge = fit([vocabulary[w] for w in some], again, sentence_sizes[sentence], bag_sizes[half], labels[half],
                    importance[half])
        unseen &= ~half
    sentence = np.repeat(unseen, bag_sizes)
    used, again = np.unique(words[np.repeat(sentence, sentence_sizes)], return_inverse=True)
    weight = np.array([judge.weights[features(vocabulary[w])].sum() for w in used], float)
    sizes = sentence_sizes[sentence]
    z = np.add.reduceat(weight[again], np.cumsum(sizes) - sizes) + judge.bias
    return replace(model, lowered=lowering(z))


def held_out(doc_id: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text, modulo 5, is 0. A row
    without an id has no label and is none of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, train_bytes: int = TRAIN_BYTES,
          label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on labelled rows that are not held out.

    The sample is bounded: of each class the ``per_class`` ids of least hash,
    texts of at most ``train_bytes`` bytes. Of a longer clean text every k-th
    sentence is taken, about ``train_bytes`` in all: a part of a clean text is
    clean. A part of a longer toxic text need not be toxic, so that is left
    out. An id that stands on several rows gives one of them (the least text),
    so the sample is bounded in rows. Rows are weighted so that classes count as they stand in all labels. With one class only, or no
    labels, every document is judged clean."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_toxic")).filter(~held_out("_id"))
    known = known.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    totals = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [known.filter(F.col("_toxic") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for c in (0, 1)]
    picked = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * per_class rows
    sample = docs.select(F.col(doc_id).alias("_id"), utf8(text).alias("_text")).join(picked, "_id").filter(
        (F.octet_length("_text") <= train_bytes) | (F.col("_toxic") == 0)).groupBy("_id").agg(
        F.min("_toxic").alias("_toxic"), F.min("_text").alias("_text"))

    def bag(batches):
        import pyarrow as pa

        for part in arrow_slices(batches, "_text"):
            bags = [[sorted(set(s)) for s in sentences(t)[::max(1, -(-len(t) // train_bytes))] if s]
                    for t in part.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_toxic"),
                                              pa.array(bags, pa.list_(pa.list_(pa.binary())))], names=["_id", "_toxic", "bag"])

    kind = sample.schema["_id"].dataType.simpleString()
    rows = bounded(sample).mapInArrow(bag, f"_id {kind}, _toxic int, bag array<array<binary>>").filter("size(bag) > 0").toArrow()
    rows = rows.sort_by("_id").combine_chunks()  # the same sums whatever order rows arrive in
    bags = rows.column("bag").combine_chunks()
    inner = bags.flatten()
    spelled = inner.flatten().dictionary_encode()
    toxic = rows.column("_toxic").to_numpy()
    drawn = {c: max(1, int((toxic == c).sum())) for c in (0, 1)}
    return calibrated(spelled.dictionary.to_pylist(), spelled.indices.to_numpy().astype(np.int64),
                      inner.value_lengths().to_numpy(), bags.value_lengths().to_numpy(), toxic,
                      np.array([totals.get(int(c), 0) / drawn[int(c)] for c in toxic]))


def _lookup(data: bytes) -> _Weights:
    return kept(("toxicity", data), lambda: _Weights(np.frombuffer(data, np.float32)))


def score(docs: DataFrame, model: Model, threshold: float = 0.5, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``doc_id, score, predicted, offending`` for every row: the noisy-or of
    its sentences (the bias lowered for their number) and, where a sentence
    alone reaches ``threshold``, its place (characters from, to) and
    probability. A null text is an empty one and
    scores 0. Rows keep their number; other columns are left out. Nothing is
    shuffled."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    data, bias, lowered = model.weights.tobytes(), model.bias, model.lowered

    def run(batches):
        import pyarrow as pa

        weight = _lookup(data)
        found = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for part in arrow_slices(batches, "text"):
            texts = part.column("text").to_pylist()
            scores, doc, which, p = _judge(texts, weight, bias, lowered)
            offending = [[] for _ in texts]
            for k in np.flatnonzero(p >= threshold):
                offending[doc[k]].append((which[k], float(p[k])))
            places = [_places(t, o) if o else [] for t, o in zip(texts, offending, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)),
                 pa.array(places, found)], names=["doc_id", "score", "predicted", "offending"])

    return bounded(rows).mapInArrow(run, f"doc_id {kind}, score double, predicted int, "
                           "offending array<struct<start: int, end: int, score: double>>")


def _judge(texts: list[bytes], weight: _Weights, bias: float, lowered: np.ndarray):
    """Scores of texts; document, place and probability of each sentence."""
    words, length, doc, which = [], [], [], []
    for i, t in enumerate(texts):
        for j, s in enumerate(sentences(t)):
            if s:
                own = dict.fromkeys(s)  # each word once, as in train
                words += own
                length.append(len(own))
                doc.append(i)
                which.append(j)
    if not words:
        return np.zeros(len(texts)), doc, which, np.empty(0)
    at = np.cumsum(length) - length
    z = np.add.reduceat(np.fromiter(map(weight.__getitem__, words), np.float64, len(words)), at) + bias
    n = np.bincount(doc, minlength=len(texts))
    z -= np.interp(np.log2(np.maximum(n, 1)), np.arange(LENGTHS), lowered)[doc]
    return -np.expm1(-np.bincount(doc, _softplus(z), len(texts))), doc, which, np.exp(-_softplus(-z))


def _places(text: bytes, offending: list[tuple[int, float]]) -> list[dict]:
    ends = np.cumsum([len(s) + 1 for s in text.translate(_FOLD).split(b"\n")])
    out = []
    for j, p in offending:
        start, end = int(ends[j - 1]) if j else 0, int(ends[j]) - 1
        before = len(text[:start].decode("utf-8", "replace"))
        out.append({"start": before, "end": before + len(text[start:end].decode("utf-8", "replace")), "score": p})
    return out


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``docs`` (all columns) without the documents that the model rejects."""
    data, bias, lowered = model.weights.tobytes(), model.bias, model.lowered
    place = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        weight = _lookup(data)
        for part in arrow_slices(batches, place):
            texts = [(t or "").encode() for t in part.column(place).to_pylist()]
            yield part.filter(pa.array(_judge(texts, weight, bias, lowered)[0] < threshold))

    return bounded(docs).mapInArrow(run, docs.schema)

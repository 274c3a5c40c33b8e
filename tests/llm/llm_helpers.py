"""Shared by the tests of the training-data operators."""

import random

import pytest
from pyspark.sql import types as T

from quincena.session import ship_package

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use for results or inside.
    T.StructField("key", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("home", T.StringType()),
    T.StructField("group", T.StringType()), T.StructField("row", T.StringType()), T.StructField("score", T.StringType()),
])


@pytest.fixture(scope="session")
def workers(spark):
    ship_package(spark)
    return spark


def frame(spark, rows, parts=3):
    """Documents from (doc_id, text) or (doc_id, text, source), with clashing extra columns."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None, "k", "w", "h", "g", "r", "s") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=7):
    """Small documents with every awkward kind of text."""
    rng = random.Random(seed)
    base = words(rng, 120)
    passage = words(rng, 60)
    rows = [(0, None), (1, ""), (2, "   \n\t "), (3, "one"), (4, "one"), (5, "ONE"), (6, "a b c d"), (7, "A b C d")]
    rows += [(10 + i, " ".join(base)) for i in range(4)]
    for i in range(6):  # near copies
        near = list(base)
        for k in rng.sample(range(120), i):
            near[k] = f"edit{i}_{k}"
        rows.append((20 + i, "\n".join(" ".join(near[j:j + 10]) for j in range(0, 120, 10))))
    for i in range(6):  # a shared passage at different places
        own = words(rng, 80 + 7 * i, 5000)
        at = rng.randrange(len(own))
        rows.append((30 + i, " ".join(own[:at] + passage + own[at:])))
    rows.append((40, " ".join(passage + passage)))  # a repeat inside one document
    rows.append((41, " ".join(words(rng, 30_000, 20_000))))  # very long
    rows.append((42, "x" * 300_000))  # one very long word
    rows.append((43, "tab\tvtab\x0bff\x0cnbsp next em \x1c unit 中文 éß 😀"))
    rows.append((-5, "negative id"))
    return rows

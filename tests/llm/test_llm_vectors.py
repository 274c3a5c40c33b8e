"""op11, op12: nearest vectors and product codes against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from llm_helpers import workers  # noqa: F401
from pyspark.sql import types as T

from conftest import SF001
from quincena.llm import codes, neighbours

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("block", T.StringType()),
                       T.StructField("vector", T.StringType()), T.StructField("q", T.StringType()),
                       T.StructField("code", T.StringType()), T.StructField("cells", T.StringType())])


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "b", "v", "q", "c", "s")
                                  for i, v, y in rows], SCHEMA).repartition(3)


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(900, None, 1), (901, [], 1), (902, [0.0] * 8, None), (903, [1.0] * 7 + [None], 2), (904, [nan] * 8, 2),
            (950, [inf] + [1.0] * 7, 2), (None, [1.0] * 8, None)]


def fit(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.float64(np.float32(a)), np.float64(np.float32(b))
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def test_op11_against_brute_force(workers):  # noqa: F811
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).round(2).tolist(), None) for i in range(400)] + odd_rows()
    rows += [(50, rows[3][1], 0), (100, rows[100][1], 0), (777, rows[150][1], 0), (778, rows[150][1], 0),
             (800, [1.0, 2.0, 3.0], 0), (803, [3.0, 2.0, 1.0], 0)]
    want = []
    fits = [(n, i, v) for n, (i, v, _) in enumerate(rows) if i is not None and fit(v)]
    asked = {(i, tuple(v)): n for n, i, v in fits if i % 50 == 0}
    for (i, v), n in asked.items():
        near = sorted((-cosine(v, w), j) for m, j, w in fits if m != n and len(w) == len(v))[:5]
        want += [(i, r + 1, j, round(-s, 9)) for r, (s, j) in enumerate(near)]
    for block in (neighbours.BLOCK, 100):
        got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9))
               for r in neighbours.nearest(table(workers, rows), block=block).collect()]
        hits = sum((Counter(got) & Counter(want)).values())
        assert len(got) == len(want) and hits >= 0.9 * len(want)
        assert Counter(g[:2] for g in got) == Counter(w[:2] for w in want)
        by_place = {(i, r): s for i, r, _, s in want}
        assert all(s <= by_place[i, r] + 1e-8 for i, r, _, s in got if i not in (50, 100))


def test_op11_recall_and_scores_of_the_whole_table(workers):  # noqa: F811
    df = workers.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    got = {}
    for r in neighbours.nearest(df).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = total = 0
    for n in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[n]
        s[n] = -2
        best = set(ids[np.argsort(-s)[:5]].tolist())
        mine = [got[ids[n]][k] for k in range(1, 6)]
        hits, total = hits + len(best & {v for v, _ in mine}), total + 5
        assert all(abs(score - s[ids == v][0]) < 1e-12 for v, score in mine)
        assert [sc for _, sc in mine] == sorted((sc for _, sc in mine), reverse=True)
    assert hits >= 0.95 * total


def test_op11_little_data(workers):  # noqa: F811
    assert neighbours.nearest(table(workers, [])).count() == 0
    assert neighbours.nearest(table(workers, odd_rows())).count() == 0
    two = neighbours.nearest(table(workers, [(0, [1.0, 0.0], 1), (7, [1.0, 1.0], 1)])).collect()
    assert [(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in two] == [(0, 1, 7, round(math.sqrt(0.5), 12))]
    same = neighbours.nearest(table(workers, [(i, [1.0, 2.0], 1) for i in range(20)])).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(same, key=lambda r: r["rank"])] == [(k, k) for k in range(1, 6)]
    assert {r.query_id for r in same} == {0}


def product_codes(rows, parts=4, entries=256, rounds=4):
    """The contract, entry by entry, in Python's integers."""
    kept = [(i, y, [math.floor(1024 * x) for x in v]) for i, v, y in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    width = len(kept[0][2]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign(p):
        return [min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for c in cut]

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c, (_, k) in zip(cut, assign(p), strict=True):
                groups.setdefault(k, []).append(c[p])
            for k, g in groups.items():
                books[p][k] = [sum(col) // len(g) for col in zip(*g, strict=True)]
    last = [assign(p) for p in range(parts)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, "".join(f"{last[p][n][1]:02x}" for p in range(parts)), sum(last[p][n][0] for p in range(parts)), y)
           for n, (i, y, _) in enumerate(kept)]
    total = Counter()
    for _, _, e, y in out:
        total[y] += e
    return sorted(((i, c, e, total[y], digest) for i, c, e, y in out), key=str)


@pytest.mark.parametrize("entries", [256, 7])
def test_op12_against_brute_force(workers, entries):  # noqa: F811
    rng = np.random.default_rng(2)
    rows = [(int(i), (rng.integers(-6, 7, 8) / 512).tolist(), None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(600)]
    rows += [(3, rows[0][1], 1), (3, rows[0][1], 1), (None, [0.25] * 8, None), (700, [-60000.0] + [60000.0] * 7, 4)] + odd_rows()[:6]
    got = codes.compress(table(workers, rows), entries=entries).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == product_codes(rows, entries=entries)


def test_op12_little_data(workers):  # noqa: F811
    assert codes.compress(table(workers, [])).count() == 0
    assert codes.compress(table(workers, odd_rows()[:2])).count() == 0
    rows = [(2, [0.5] * 4, None), (1, [0.25] * 4, None), (4, [1e9] * 4, 1), (5, [1.0] * 8, 1), (6, [1.0] * 3, 1)]
    assert sorted(r.vec_id for r in codes.compress(table(workers, rows)).collect()) == [1, 2]


@pytest.mark.parametrize("spread", [3, 40, 1 << 25])
def test_op12_tree_is_exact(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread + 1, (300, 6))
    entries[50:60] = entries[7]
    x = np.concatenate([rng.integers(-spread, spread + 1, (700, 6)), entries[::3]])
    index, best = codes.Gnat(entries).nearest(x)
    d = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, e, strict=True)) for e in entries] for r in x]
    assert best.tolist() == [min(r) for r in d] and index.tolist() == [r.index(min(r)) for r in d]

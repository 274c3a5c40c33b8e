"""op4, op5, op6, op9: duplicates against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from llm_helpers import corpus, frame, words, workers  # noqa: F401

from pyspark.sql import functions as F
from quincena.llm import exact, lines, minhash, substrings


def repeats(rows, window=35):
    """For each row: (words, words removed, hash of what is left)."""
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[p:p + window]) for _, w in docs for p in range(len(w) - window + 1))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p:p + window])] > 1:
                gone[p:p + window] = [True] * window
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def removed(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("bucket_bytes", [4 << 20, 20_000])
def test_op4_rows(workers, bucket_bytes):  # noqa: F811
    rows = corpus() + [(None, "no id " * 30), (30, corpus()[-12][1])]
    assert removed(substrings.remove_repeats(frame(workers, rows), bucket_bytes=bucket_bytes)) == repeats(rows)


def test_op4_every_shift_and_odd_lengths(workers):  # noqa: F811
    rng = random.Random(11)
    rows = []
    for i in range(60):  # passages around the window's length, at all residues of the period
        passage = words(rng, 33 + i % 6, 10_000)
        for j in range(2):
            own = words(rng, rng.randrange(60), 10_000)
            at = rng.randrange(len(own) + 1)
            rows.append((2 * i + j, " ".join(own[:at] + passage + own[at:])))
    assert removed(substrings.remove_repeats(frame(workers, rows))) == repeats(rows)


def test_op4_repeated_rows(workers):  # noqa: F811
    """A row that stands very often is compared once, and others still find their passages in it."""
    rng = random.Random(5)
    often, other = words(rng, 90, 10_000), words(rng, 40, 10_000)
    rows = [(7, " ".join(often))] * 400 + [(None, " ".join(other))] * 3 + [(9, "too short")] * 50 + [(10, None), (10, "")]
    rows += [(11, " ".join(often[20:60] + words(rng, 30, 10_000))), (12, " ".join(other[:36])), (13, "\t".join(often[:34])),
             (14, " ".join(words(rng, 80, 10_000)))]
    assert removed(substrings.remove_repeats(frame(workers, rows, parts=5))) == repeats(rows)
    out = substrings.remove_repeats(frame(workers, rows[-6:] + rows[:2] + rows[403:405])).collect()
    assert sorted((str(r.doc_id), r.kept_text, r.home) for r in out if r.doc_id in (7, 9)) == [
        ("7", "", "h"), ("7", "", "h"), ("9", "too short", "h"), ("9", "too short", "h")]


def test_op4_interface(workers):  # noqa: F811
    docs = frame(workers, [(1, "a  b"), (2, None)])
    out = substrings.remove_repeats(docs)
    assert set(docs.columns) - {"n_words"} <= set(out.columns)
    assert {r.doc_id: (r.kept_text, r.n_words, r.home, r.key) for r in out.collect()} == {
        1: ("a  b", 2, "h", "k"), 2: ("", 0, "h", "k")}
    assert substrings.remove_repeats(frame(workers, [])).collect() == []
    with pytest.raises(ValueError):
        substrings.remove_repeats(docs, window=10)


def test_op4_cover_has_all_differences():
    cover = set(substrings.COVER)
    for a in range(substrings.PERIOD):
        for b in range(substrings.PERIOD):
            assert any((a + d) % substrings.PERIOD in cover and (b + d) % substrings.PERIOD in cover
                       for d in range(substrings.PERIOD))


def components(rows, percent=75):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def test_op6_rows(workers):  # noqa: F811
    rng = random.Random(9)
    rows = corpus()
    chain = words(rng, 100)
    for i in range(12):  # a chain: neighbours are linked, ends are not
        chain = chain[3:] + words(rng, 3, 100_000)
        rows.append((100 + i, " ".join(chain)))
    group = words(rng, 200)
    for i in range(60):  # a dense group around the threshold
        near = list(group)
        for k in rng.sample(range(200), 1 + i % 9):
            near[k] = f"x{i}_{k}"
        rows.append((200 + i, " ".join(near)))
    got = minhash.near_duplicates(frame(workers, rows)).collect()
    assert sorted(map(tuple, got)) == components(rows)


def test_op6_odd_rows(workers):  # noqa: F811
    rows = [(5, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, None)]
    got = sorted(map(tuple, minhash.near_duplicates(frame(workers, rows)).collect()), key=str)
    assert got == sorted([(5, 2, 3, False), (None, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (9, 0, 9, True)], key=str)
    assert minhash.near_duplicates(frame(workers, [])).collect() == []
    nameless = [(None, "a b c d e f"), (None, "a b c d e f"), (None, None), (None, "x")]
    got = sorted(map(tuple, minhash.near_duplicates(frame(workers, nameless)).collect()), key=str)
    assert got == sorted([(None, 2, None, True)] * 2 + [(None, 0, None, True), (None, 1, None, True)], key=str)


def test_op6_one_id_with_two_texts(workers):  # noqa: F811
    rng = random.Random(3)
    a, b = (words(rng, 60, 10_000) for _ in range(2))
    rows = [(5, " ".join(a)), (5, " ".join(b)), (9, " ".join([*a, "more"])), (11, " ".join([*b, "more"])), (2, "else " * 9),
            (None, " ".join(["less", *b])), (20, " ".join([*b[1:], "x", "y"]))]
    got = sorted(map(tuple, minhash.near_duplicates(frame(workers, rows)).select("doc_id", "component_id", "kept").collect()), key=str)
    assert got == sorted([(5, 5, True), (5, 5, True), (9, 5, False), (11, 5, False), (2, 2, True), (None, 5, False), (20, 5, False)], key=str)


def test_op6_components(workers):  # noqa: F811
    links = workers.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (95, 90)], "a long, b long")
    got = {r.node: r.component for r in minhash.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 90, 95: 90, 90: 90}


def test_op9_rows(workers):  # noqa: F811
    long = "p" * 5000
    rows = corpus() + [(500, long + "a"), (501, long + "b"), (502, long + "a"), (None, "only null"), (None, long + "a"),
                       (10, corpus()[8][1])]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    expected = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    got = exact.resolve(frame(workers, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert exact.resolve(frame(workers, [])).collect() == []
    kept = exact.keep_one(frame(workers, rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(e[0]) for e in expected if e[3])
    assert kept.columns == frame(workers, []).columns


def test_op5_rows(workers):  # noqa: F811
    rows = [(i, f"own {i} line\n Shared footer line \nshort\n\nonly some sites", f"site{i % 7}") for i in range(30)]
    rows += [(40 + i, "rare footer of four sites\nx", f"site{i % 4}") for i in range(8)]
    rows += [(60, None, "site1"), (61, "", None), (62, "Shared footer line", None), (63, "null site line here", None)]
    rows += [(None, "short\nShared footer line", "site9"), (64, "x", "site1"), (64, "x\nx", "site2")]
    rows += [(70 + i, f"{'many sites line ' * 3}\ntext {i} of its own", f"far{i}") for i in range(40)]
    sites = defaultdict(set)
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            if line.strip(" ") and s is not None:
                sites[line.strip(" ")].add(s)
    expected = []
    for i, t, _ in rows:
        parts = (t or "").split("\n")
        left = [p for p in parts if len(sites[p.strip(" ")]) < 5]
        expected.append((i, len(parts), len(parts) - len(left), "\n".join(left)))
    got = lines.remove_boilerplate(frame(workers, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert lines.remove_boilerplate(frame(workers, [])).collect() == []


def test_pairs_of_one_large_bucket_are_many_tasks_work(spark, monkeypatch):
    """Members around one first class are compared in shares, each pair once."""
    monkeypatch.setattr(minhash, "SHARE_ROWS", 8)
    rows = [(i, 10, 0, 0 if i < 30 else i // 2, [i] * 16) for i in range(100)] + [(1000, 10, 7, 1, [1] * 16), (1001, 10, 7, 1, [1] * 16)]
    a, b = minhash._blocks(spark.createDataFrame(rows, "cls long, n long, m long, component long, bits array<long>"))
    assert len({r.p for r in a.select(F.spark_partition_id().alias("p")).collect()}) > 1
    met = sorted(tuple(r) for r in a.join(b, ["m", "share"]).select("m", "a_cls", "b_cls").collect())
    assert met == sorted((0, x, y) for x in range(30, 100) for y in range(100))
    # The side that shares repeat is larger than its files tell: no driver is to hold it.
    open_ = spark.createDataFrame([r[:4] for r in rows], "cls long, n long, m long, component long")
    sets = spark.createDataFrame([(r[0], r[4]) for r in rows], "cls long, bits array<long>")
    plan = minhash._rest_pairs(open_, sets, 75)._jdf.queryExecution().executedPlan().toString()
    assert "share" in plan.split("SortMergeJoin")[1].split("\n")[0]


def test_blocks_leave_the_optimizer_nothing_to_infer_from_an_array(spark):
    """Aliases of an array's elements beside a sum over them gave 2 ** 16 constraints, more than a driver's heap."""
    rows = [(cls, 10, 0, cls % 3, list(range(16))) for cls in range(6)]
    for side in minhash._blocks(spark.createDataFrame(rows, "cls long, n long, m long, component long, bits array<long>")):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert "bits" not in plan and "bit_count" not in plan

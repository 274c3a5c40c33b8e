"""Rows that the operators used to lose, multiply or misjudge."""

import hashlib
import random
from collections import Counter

from llm_helpers import frame, words, workers  # noqa: F401
from test_llm_models import alike, toxic_corpus

import corpus_pipeline
from quincena.llm import exact, imatch, minhash, toxicity
from quincena.session import materialize


def trained(spark):
    rows, marks = toxic_corpus()
    return toxicity.train(frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int"))


def clean_text(seed, size):
    rng = random.Random(seed)
    out, n = [], 0
    while n < size:
        out.append(" ".join(words(rng, 8, 3000)))
        n += len(out[-1]) + 2
    return ". ".join(out) + "."


def test_op10_long_clean_texts_stay(workers):  # noqa: F811
    model = trained(workers)
    clean = [(i, clean_text(i, size)) for i, size in enumerate((200_000, 500_000, 1_000_000, 5_000_000))]
    bad = "Vileword9 vileword0 w1"
    toxic = [(100, ". ".join([clean_text(9, 200)] * 5 + [bad])), (101, ". ".join([bad + ". " + clean_text(8, 500)] * 2000))]
    docs = frame(workers, clean + toxic)
    assert {r.doc_id for r in toxicity.keep_clean(docs, model).collect()} == {0, 1, 2, 3}
    assert {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 100: 1, 101: 1}


def test_op10_part_of_long_clean_texts_is_learnt(workers):  # noqa: F811
    rows, marks = toxic_corpus(300)
    extra = [(1001, ". ".join(f"w{k % 50} seldom" for k in range(30_000)))]  # 'seldom' stands in toxic texts else
    rows = [(i, t + (" seldom." if y else "")) for (i, t), (_, y) in zip(rows, marks, strict=True)] + extra
    marks = marks + [(1001, 0)]
    labels = workers.createDataFrame(marks, "doc_id long, toxic int")
    place = toxicity.features(b"seldom")[0]
    with_it, without = (toxicity.train(frame(workers, r), labels).weights[place] for r in (rows, rows[:-1]))
    assert with_it < without


def test_op10_a_repeated_word_counts_once(workers):  # noqa: F811
    model = trained(workers)
    once, often = "w1 w2 w3 w4.", "w1 w2 w3 w4 " * 20 + "."
    bad = [("Vileword9 w1.", "Vileword9 " * 3 + "w1.")]
    pairs = [(once, often), *bad]
    rows = [(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)]
    got = {r.doc_id: r.score for r in toxicity.score(frame(workers, rows), model).collect()}
    assert all(abs(got[2 * i] - got[2 * i + 1]) < 1e-12 for i in range(len(pairs)))


def test_op9_keeps_one_row(workers):  # noqa: F811
    rows = [(1, "a b")] * 3 + [(None, "a b"), (None, "c")] + [(None, "d")] * 4 + [(2, "e"), (7, "a b"), (7, "a b"), (7, "f"), (5, None), (5, "")]
    docs = frame(workers, rows)
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((str(r.doc_id), r.text or "") for r in kept.collect())) == [
        ("2", "e"), ("5", ""), ("7", "a b"), ("7", "f"), ("None", "c"), ("None", "d")]


def test_op9_texts_stay_where_ids_tell_what_goes(workers):  # noqa: F811
    rows = [(i, f"text {i % 5000}") for i in range(15_000)]
    name, limit = "spark.sql.autoBroadcastJoinThreshold", workers.conf.get("spark.sql.autoBroadcastJoinThreshold")
    workers.conf.set(name, "256k")  # too little for 10,000 ids with hashes
    try:
        for more, moved in (([], False), ([(3, "another text of an id that goes")], True), ([(None, "text 3")], True)):
            kept = exact.keep_one(materialize(frame(workers, rows + more), "docs"))
            assert ("SortMergeJoin" in kept._jdf.queryExecution().executedPlan().toString()) == moved
            assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(
                [*range(10_000, 15_000), *[i for i, t in more if i == 3]])
    finally:
        workers.conf.set(name, limit)


def test_op6_keeps_one_row(workers):  # noqa: F811
    rng = random.Random(3)
    base, other = words(rng, 100), words(rng, 100)
    near = [" ".join(base[:-i] + [f"x{i}"] * i) for i in range(1, 4)]
    rows = [(None, near[0]), (None, near[1]), (9, near[2]), (4, " ".join(base)), (4, " ".join(other)), (4, " ".join(other)),
            (None, " ".join(other[:-1] + ["y"])), (6, None), (None, "alone"), (None, "alone"), (8, "alone")]
    docs = frame(workers, rows)
    kept = minhash.keep_one_row(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got.pop((9, near[2])) == 1 and got.pop((6, None)) == 1 and got.pop((8, "alone")) == 1
    assert len(got) == 1 and sum(got.values()) == 1 and next(iter(got))[1] in {" ".join(other), " ".join(other[:-1] + ["y"])}


def test_pipeline_keeps_a_row_of_repeated_rows(workers, tmp_dir):  # noqa: F811
    """Clean documents that stand several times, with and without an id, come out once."""
    rng = random.Random(5)
    texts = [" ".join(words(rng, 80, 100_000)) for _ in range(6)]
    rows = [(1, texts[0])] * 3 + [(None, texts[1])] * 3 + [(2, texts[2]), (None, texts[2]), (3, texts[3])]
    rows += [(None, texts[4] + " end"), (None, texts[4] + " stop"), (3, texts[5]), (3, texts[5])]
    docs = frame(workers, rows)
    workers.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = materialize(stage(workers, docs, tmp_dir), "stage")
    left = Counter(r.text.rsplit(" ", 1)[0] if r.text.endswith((" end", " stop")) else r.text for r in docs.collect())
    assert left == Counter(texts)


def test_op7_null_and_repeated_ids(workers):  # noqa: F811
    rng = random.Random(6)
    t = [" ".join(words(rng, 20 + 9 * i)) for i in range(6)]
    rows = [(1, t[0]), (2, t[1]), (2, t[1]), (2, t[3]), (3, t[2]), (3, t[4]), (3, t[4]), (None, t[5]), (None, t[5]), (None, None)]
    docs = frame(workers, rows)
    lex = imatch.lexicon(docs, 0.01, 0.9)
    begins = {1: t[0], 2: min(t[1], t[3]), 3: min(t[2], t[4])}
    expected = []
    for i, text in rows:
        text = text or ""
        ahead = text if i is None else begins[{3: 2, 2: 1, 1: 3}[i]]
        k = len(text) // 3
        changed = text[:len(text) - k] + ahead[:k]
        a, b, c = (imatch.fingerprint(x.encode(), lex.tobytes()) for x in (text, changed, ahead))
        expected.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, round(alike(a, b), 9), round(alike(a, c), 9)))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
           for r in imatch.edited(docs, lex).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert len(imatch.edited(frame(workers, [(None, "only")]), lex).collect()) == 1


def test_sizes_as_spark_writes_them():
    from quincena.llm.common import byte_string

    assert [byte_string(t) for t in ("64m", "1gb", "12", "7b", "2K", "-1", " 3 mib ")] == [64 << 20, 1 << 30, 12, 7, 2048, -1, 3 << 20]


def test_callers_columns_pass_through_whatever_their_names(workers):  # noqa: F811
    text = " ".join(words(random.Random(2), 60, 9000))
    rows = [(1, text), (2, text), (3, text + " more"), (4, "else " * 3)]
    extra = ["_id", "_sha256", "_id_sha256", "_node", "_judged", "n_words", "n_removed", "kept_text", "cls", "node", "n"]
    docs = workers.createDataFrame([(*r, *(f"{c}{r[0]}" for c in extra)) for r in rows],
                                   "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra))
    for kept in (exact.keep_one(docs), minhash.keep_one_row(docs), corpus_pipeline.drop_passages(workers, docs, "")):
        assert kept.columns == docs.columns
        assert all(getattr(r, c) == f"{c}{r.doc_id}" for r in kept.collect() for c in extra)
    assert sorted(r.doc_id for r in exact.keep_one(docs).collect()) == [2, 3, 4]
    assert sorted(r.doc_id for r in minhash.keep_one_row(docs).collect()) == [1, 4]

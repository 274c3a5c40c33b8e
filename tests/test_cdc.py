import datetime as dt
from hypothesis import given, settings
from hypothesis import strategies as st

from quincena.operators import cdc

SCHEMA = "k string, seq timestamp_ntz, sal double, gasto double, archivo string, upd timestamp_ntz, rid long"
T = [dt.datetime(2024, m, 1) for m in range(1, 13)]


def hist(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = cdc.scd2_history(df, ["k"], "seq", ["sal", "gasto"], ["upd", "rid"])
    got = [(r.k, r.sal, r.gasto, r.archivo, r["__START_AT"], r["__END_AT"]) for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


def ev(k, t, sal, gasto=None, archivo="f", rid=0):
    return (k, t, sal, gasto, archivo, t, rid)


def test_t12_a_b_a_gives_three_versions(spark):
    got = hist(spark, [ev("x", T[0], 1.0), ev("x", T[1], 2.0), ev("x", T[2], 1.0)])
    assert got == {("x", 1.0, None, "f", T[0], T[1]), ("x", 1.0, None, "f", T[2], None),
                   ("x", 2.0, None, "f", T[1], T[2])}


def test_late_event_splits_version(spark):
    # A at t1 and t3 collapse to one version; a late B at t2 splits it.
    assert hist(spark, [ev("x", T[0], 1.0), ev("x", T[2], 1.0)]) == {("x", 1.0, None, "f", T[0], None)}
    got = hist(spark, [ev("x", T[0], 1.0), ev("x", T[2], 1.0), ev("x", T[1], 2.0)])
    assert got == {("x", 1.0, None, "f", T[0], T[1]), ("x", 1.0, None, "f", T[2], None),
                   ("x", 2.0, None, "f", T[1], T[2])}


def test_untracked_change_updates_in_place(spark):
    got = hist(spark, [ev("x", T[0], 1.0, archivo="a"), ev("x", T[1], 1.0, archivo="b")])
    assert got == {("x", 1.0, None, "b", T[0], None)}


def test_nulls_compare_as_values(spark):
    got = hist(spark, [ev("x", T[0], 1.0, None), ev("x", T[1], 1.0, None), ev("x", T[2], 1.0, 1.0)])
    assert got == {("x", 1.0, None, "f", T[0], T[2]), ("x", 1.0, 1.0, "f", T[2], None)}


def test_null_keys_group_together(spark):
    got = hist(spark, [ev(None, T[0], 1.0), ev(None, T[1], 2.0)])
    assert got == {(None, 1.0, None, "f", T[0], T[1]), (None, 2.0, None, "f", T[1], None)}


def test_ties_keep_newest_update_then_row(spark):
    rows = [("x", T[0], 1.0, None, "a", T[3], 1), ("x", T[0], 2.0, None, "b", T[4], 0),
            ("x", T[0], 3.0, None, "c", T[4], 2)]
    assert hist(spark, rows) == {("x", 3.0, None, "c", T[0], None)}


def test_scd1_latest_by_sequence(spark):
    df = spark.createDataFrame([("a", "s", "OK", T[0]), ("a", "s", "FAIL", T[2]), ("a", "t", "OK", T[1]),
                                ("a", "s", "OK", T[1])], "i string, s string, run_status string, checked_at timestamp_ntz")
    got = {tuple(r) for r in cdc.scd1_latest(df, ["i", "s"], "checked_at").collect()}
    assert got == {("a", "s", "FAIL", T[2]), ("a", "t", "OK", T[1])}


events = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 7), st.sampled_from([1.0, 2.0, None])),
                  min_size=1, max_size=25)


@settings(max_examples=12, deadline=None)
@given(events, st.randoms())
def test_history_invariants(spark, evs, rnd):
    rows = [(k, T[t], s, None, "f", T[t], i) for i, (k, t, s) in enumerate(evs)]
    got = hist(spark, rows)
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    assert hist(spark, shuffled) == got           # order of arrival does not matter
    by_key = {}
    for k, sal, _g, _a, start, end in got:
        by_key.setdefault(k, []).append((start, end, sal))
    for k, vs in by_key.items():
        vs.sort(key=lambda v: v[0])
        assert sum(1 for v in vs if v[1] is None) == 1   # exactly one open version
        for a, b in zip(vs, vs[1:]):
            assert a[1] == b[0]                        # contiguous, no overlap
            assert a[2] != b[2]                        # adjacent versions differ
        starts = {T[t] for kk, t, _ in evs if kk == k}
        assert vs[0][0] == min(starts)


def test_history_needs_one_exchange_and_one_sort(spark):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        cdc.scd2_history(spark.createDataFrame([], SCHEMA), ["k"], "seq", ["sal", "gasto"], ["upd", "rid"]).explain()
    plan = buf.getvalue()
    assert plan.count("Exchange") == 1 and plan.count("+- Sort ") == 1


def test_null_sequence_comes_first_and_reduce_first_changes_nothing(spark):
    rows = [ev("x", None, 1.0, rid=1), ev("x", None, 3.0, rid=2), ev("x", T[0], 3.0), ev("x", T[1], 1.0), ev("x", T[1], 2.0, rid=5)]
    assert hist(spark, rows) == {("x", 3.0, None, "f", None, T[1]), ("x", 2.0, None, "f", T[1], None)}
    df = spark.createDataFrame(rows, SCHEMA)
    one, two = (cdc.scd2_history(df, ["k"], "seq", ["sal", "gasto"], ["upd", "rid"], reduce_first=r) for r in (False, True))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(*one.columns).collect()))

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from quincena.operators import dims, names

D = "spanish string, english string"


def translated(spark, found, entries):
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(found)], "name string, i int")
    got = names.translate_phrases(rows, "name", spark.createDataFrame(entries, D), "english")
    assert got.columns == ["name", "i", "english"]
    return [r.english for r in got.orderBy("i").collect()]


def plain(name, entries):
    """Longest phrase first, a shorter one where the rest cannot be cut."""
    known = {}
    for spanish, english in entries:
        if spanish is not None and english is not None:
            phrase = tuple(spanish.split())
            known[phrase] = min(known.get(phrase, english), english)
    known.pop((), None)

    def cut(words):
        if not words:
            return []
        for n in range(len(words), 0, -1):
            if words[:n] in known:
                rest = cut(words[n:])
                if rest is not None:
                    return [known[words[:n]], *rest]
        return None

    whole = [e for s, e in entries if s == name and e is not None]
    if name is None or whole:
        return min(whole) if whole else None
    parts = cut(tuple(name.split()))
    return " ".join(p for p in parts if p) if parts else None


def test_phrases_longest_first_with_a_way_back(spark):
    d = [("jefe", "chief"), ("jefe de", "head of"), ("de", "of"), ("de obra", "of works"), ("obra civil", "civil works"),
         ("la", ""), ("mesa", None), (None, "nothing"), ("", "blank"), ("jefe", "boss"), ("jefe la obra", "entry")]
    cases = {"jefe de obra civil": "head of civil works",   # 'jefe de' then 'obra civil'
             "jefe de obra": "boss of works",               # 'jefe de' leaves 'obra', which is no phrase
             "jefe la obra": "entry",                       # the whole name's own entry
             "jefe  la": "boss", " jefe ": "boss",          # blanks only part words; 'la' adds nothing
             "jefe mesa": None, "mesa": None, "obra": None, "": "blank", "  ": None, None: None}
    assert translated(spark, list(cases), d) == list(cases.values())
    assert translated(spark, ["a", None], []) == [None, None]
    assert translated(spark, [], d) == []


def test_repeated_names_and_long_ones(spark):
    long = " ".join(["a", "b"] * 300)
    assert translated(spark, ["a b", "a b", long, long + " c"], [("a", "x"), ("b", "y"), ("a b a", "z")]) == [
        "x y", "x y", plain(long, [("a", "x"), ("b", "y"), ("a b a", "z")]), None]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=7).map(" ".join), min_size=1, max_size=25),
       st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=3).map(" ".join),
                          st.sampled_from(["1", "2", "", None])), max_size=7))
def test_phrases_equal_a_plain_search(spark, found, entries):
    assert translated(spark, found, entries) == [plain(n, entries) for n in found]


def test_dimension_by_phrases(spark):
    audit = spark.createDataFrame([("A B", "OK", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))],
                                  "institution_name_spanish string, run_status string, source_update timestamp_ntz, "
                                  "checked_at timestamp_ntz")
    d = spark.createDataFrame([("A", "x"), ("B", "y")], D)
    assert [r.institution_name_english for r in dims.dim_institution(audit, d).collect()] == [None]
    assert [r.institution_name_english for r in
            dims.dim_institution(audit, d, names.translate_phrases).collect()] == ["x y"]

from quincena.operators.joins import null_safe_condition


def test_null_safe_condition_matches_nulls(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    b = spark.createDataFrame([(None,), ("y",)], "_k_k string")
    assert [r.v for r in a.join(b, null_safe_condition(a, b, ["k"], "_k_"), "left_semi").collect()] == [2]
    assert [r.v for r in a.join(b, null_safe_condition(a, b, ["k"], "_k_"), "left_anti").collect()] == [1]

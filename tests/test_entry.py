import __spark_entry__ as E

from conftest import SF0001
from quincena.plans.catalog import QUERIES
from quincena.plans.oracle import ORACLE


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 28      # position groups at sf0.001
    assert "total_compensation" in df.columns


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_known_counts_sf0001(spark):
    q = E.queries()
    assert q["snapshot_latest"](spark, SF0001).count() == 29
    assert q["scd2_history"](spark, SF0001).count() == 1314
    assert q["scd2_current"](spark, SF0001).count() == 723
    assert q["inactive_employees"](spark, SF0001).count() == 697

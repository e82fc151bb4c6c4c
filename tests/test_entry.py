import __spark_entry__ as E
from tests.conftest import SF


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["feature", "corr", "abs_corr"] and 0 < len(rows) <= 10
    assert [r["abs_corr"] for r in rows] == sorted((r["abs_corr"] for r in rows), reverse=True)


def test_registry_contract():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60


def test_some_queries_small(spark):
    q = E.queries()
    for name in ("clean_table", "describe_target", "train_test_split", "association_matrix", "kfold"):
        assert q[name](spark, SF).count() > 0

import __spark_entry__ as entry


def test_registry_consistent():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "quantity_region_mean" in df.columns

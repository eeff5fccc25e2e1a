import __spark_entry__ as e


def test_entry_and_registries(spark):
    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

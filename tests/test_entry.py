import __spark_entry__ as entry


def test_every_query_has_oracle_or_is_known(spark):
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "document_id" in df.columns

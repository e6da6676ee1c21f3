import __spark_entry__ as entry


def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["yyyy", "mm", "total_records", "total_price", "first_day", "last_day"] and df.count() > 0


def test_every_query_but_the_approximate_one_has_sql():
    own = {n for n in entry.queries() if not n.startswith("op") and n != "pipeline"}
    assert own - set(entry.oracle_sql()) == {"median_approx"}
    assert set(entry.oracle_sql()) <= set(entry.queries())

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_entry_density_filter_counts(spark):
    df = entry.entry(spark)
    assert df.columns == ["reviewerID", "asin", "overall", "reviewText"]
    assert df.count() == 601  # fixture expectation at sf 0.001 (cut-off 2001-01-01)


def test_every_query_has_a_callable_and_oracles_are_known():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


def test_fixture_numbers(spark):
    q = entry.queries()
    split = {r.split: r.n for r in q["split_sizes"](spark, SF).collect()}
    assert split == {"train": 4186, "val": 1187, "test": 627}
    assert q["row_count"](spark, SF).first().rows == 6000
    assert {r.verified: r.n for r in q["verified_counts"](spark, SF).collect()}[True] == 4032

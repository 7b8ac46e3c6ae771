import pytest

from folioscope.plans import catalogue, evidence  # noqa: F401 - registers its queries in the catalogue

from oracle import same


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, small, name):
    df = catalogue.QUERIES[name](spark, small)
    if name in catalogue.ORACLES:
        same(df, catalogue.ORACLES[name], small)
    else:
        assert df.count() >= 1


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_partitioning_does_not_change_results(spark, small):
    """Same rows with one shuffle partition and with many."""
    got = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append([sorted(map(str, catalogue.QUERIES[q](spark, small).collect())) for q in ("q02_claim_dedup_first_wins", "q04_interval_union_coverage", "q18_loose_token_match")])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]

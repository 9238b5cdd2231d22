import pytest
from duck import connect, same

from factloom.plans import catalogue


@pytest.fixture(scope="module")
def con(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_matches_its_sql(spark, tiny, con, name):
    same(catalogue.QUERIES[name](spark, tiny), catalogue.SQL[name], con)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_without_sql_gives_rows(spark, tiny, name):
    assert catalogue.QUERIES[name](spark, tiny).count() > 0


def test_fake_embedding_against_plain_counting(spark):
    import hashlib
    import math

    from pyspark.sql import functions as F

    from factloom.functions.exprs import fake_embedding

    text = "Average number of employees of the employees"
    want = [0.0] * 256
    for w in text.lower().split():
        want[int(hashlib.sha256(w.encode()).hexdigest(), 16) % 256] += 1
    norm = math.sqrt(sum(x * x for x in want))
    got = spark.createDataFrame([(text,), ("",)], "t string").select(fake_embedding(F.col("t"))).collect()
    assert got[0][0] == pytest.approx([x / norm for x in want])
    assert got[1][0] == [0.0] * 256


def test_entry_has_every_query(spark, tiny):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0

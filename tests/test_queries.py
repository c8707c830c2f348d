"""Every query with SQL gives the rows of its SQL."""

import pytest
from conftest import rows_of

from fanfold.plans import queries as plans
from fanfold.plans import value_queries  # noqa: F401  registers its queries


@pytest.mark.parametrize("name", list(plans.ORACLE_SQL))
def test_same_rows(spark, sf_dir, duck, name):
    got = plans.QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(plans.ORACLE_SQL[name]).df()
    assert rows_of(got) == rows_of(want)


def test_subsample_repeats_and_has_about_the_rate(spark, sf_dir):
    a = {r.read_id for r in plans.subsample(spark, sf_dir).collect()}
    assert a == {r.read_id for r in plans.subsample(spark, sf_dir).collect()}
    n = plans.event_reads(spark, sf_dir).count()
    assert 0.15 * n < len(a) < 0.35 * n


def test_entry_and_contract(spark, sf_dir):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

"""Every registered query beside its SQL, and the known answers of the derived inputs."""

from __future__ import annotations

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from medallion.plans.landing import spend_source, users_source

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duckdb():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duckdb, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.columns and len(df.collect()) > 0
    else:
        assert difference(df, duckdb, sql) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_known_answers(spark):
    users, spend = users_source(spark, SF_DIR), spend_source(spark, SF_DIR)
    assert (users.count(), users.where("loyalty IS NOT NULL").count(), spend.count()) == (150, 4, 136)


def test_entry(spark):
    assert entry.entry(spark).count() > 0

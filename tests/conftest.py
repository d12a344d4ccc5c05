from __future__ import annotations

import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medallion.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="medallion-warehouse-")
    session = build_session(
        "tests", "local[8]", spark_sql_shuffle_partitions=8, spark_sql_warehouse_dir=warehouse
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="medallion-shared-"))
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/tables'")
    return name


def rows_of(df) -> list[tuple]:
    """All rows as a sorted multiset of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)

"""Raw user and spend folders derived from the test tables.

The formulas are written twice, here for Spark and in ``plans/oracle.py`` for the
checking engine. Known answers are in FIXTURES.md.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import scratch_dir
from medallion.sources.files import sized_partitions

USERS = """
SELECT CASE WHEN c_custkey % 41 = 5 THEN 'bad-' || cast(c_custkey AS string)
            WHEN c_custkey % 53 = 11 THEN '-' || cast(c_custkey AS string)
            ELSE cast(c_custkey AS string) END AS id,
       CASE WHEN c_custkey % 31 = 4 THEN NULL
            ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
       lower(c_mktsegment) AS firstname,
       replace(lower(n_name), '_', ' ') AS lastname,
       cast(c_custkey AS string) || ' ' || c_mktsegment || ' street' AS address,
       n_name AS city,
       CASE WHEN c_custkey % 50 = 7 THEN '2019-01-01'
            ELSE date_format(o_orderdate + interval 6575 days, 'MM-dd-yyyy HH:mm:ss') END AS creation_date,
       date_format(o_orderdate + interval 6575 days
                   + make_interval(0, 0, 0, cast(c_custkey % 1000 AS int)),
                   'MM-dd-yyyy HH:mm:ss') AS last_activity_date,
       '10.0.' || cast(c_nationkey AS string) || '.' || cast(c_custkey % 256 AS string) AS last_ip,
       lpad(cast(c_custkey % 97 AS string), 5, '0') AS postcode,
       CASE WHEN c_custkey % 37 = 3 THEN 'gold' END AS loyalty
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {orders} ON o_orderkey = c_custkey
"""

SPEND = """
SELECT cast(c_custkey AS bigint) AS id,
       CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE cast(18 + c_custkey % 60 AS int) END AS age,
       CASE WHEN c_custkey % 43 = 2 THEN NULL ELSE cast(floor(c_acctbal) AS int) END AS annual_income,
       cast(1 + (c_custkey * 37) % 100 AS int) AS spending_core
FROM {customer} WHERE c_custkey % 10 <> 9
UNION ALL
SELECT cast(c_custkey AS bigint), 99, 0, 1 FROM {customer} WHERE c_custkey % 211 = 1
"""

USER_COLUMNS = (
    "email STRING, firstname STRING, lastname STRING, address STRING, city STRING, "
    "creation_date STRING, last_activity_date STRING, last_ip STRING, postcode STRING"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def users_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, USERS, "customer", "nation", "orders")


def spend_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, SPEND, "customer")


@dataclass(frozen=True)
class Landing:
    users: str
    spend: str
    user_files: int
    spend_files: int


def file_count(spark: SparkSession, sf_dir: str, name: str, least: int) -> int:
    """At least ``least`` files, more as the source grows."""
    source = spark.read.format("binaryFile").load(f"{sf_dir}/{name}.parquet").select("length")
    return sized_partitions(source.agg(F.sum("length")).first()[0], 16 * 1024 * 1024, least)


def write_landing(spark: SparkSession, sf_dir: str) -> Landing:
    root = scratch_dir(spark, "landing")
    users, spend = f"{root}/users_json", f"{root}/spend_csv"
    user_files = file_count(spark, sf_dir, "customer", 8)
    spend_files = file_count(spark, sf_dir, "customer", 4)
    users_source(spark, sf_dir).repartition(user_files, "address").write.json(users)
    rows = spend_source(spark, sf_dir).repartition(spend_files, "id", "age")
    rows.write.option("header", True).csv(spend)
    return Landing(users, spend, user_files, spend_files)


_users: dict[tuple[str, str], str] = {}


def users_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users as a written table, for queries that start after the ingest."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _users:
        path = f"{scratch_dir(spark, 'users')}/users"
        users_source(spark, sf_dir).write.parquet(path)
        _users[key] = path
    return spark.read.parquet(_users[key])


_written: dict[tuple[str, str], Landing] = {}


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    """The folders of a test table set, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        _written[key] = write_landing(spark, sf_dir)
    return _written[key]

from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from medallion.operators import hot_keys, hot_shares, spread_join
from medallion.operators.joins import salts_by_share
from medallion.plans.retail import join_spend


def sides(spark):
    left = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS k", "id % 500 AS v"
    )
    right = spark.range(2000).selectExpr("id AS k", "id * 2 AS w")
    return left, right.unionByName(spark.sql("SELECT 7L AS k, -1L AS w UNION ALL SELECT NULL, -2L"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [None, [7], [7, 11, 99999], {7: 0.33, 11: 0.001}])
def test_spread_join_equals_the_plain_join(spark, how, hot):
    left, right = sides(spark)
    want = rows_of(left.join(right, "k", how))
    assert rows_of(spread_join(left, right, ["k"], how, hot, salts=5)) == want
    assert rows_of(spread_join(left, right, ["k"], how, hot, salts=5, deal=F.xxhash64("v"))) == want


def test_hot_keys_are_found_and_null_is_none_of_them(spark):
    left, _ = sides(spark)
    assert hot_keys(left, "k", 0.05, look_at=1) == [7]
    assert hot_keys(left.where("k > 7"), "k", 0.05, look_at=1) == []
    assert hot_keys(left.limit(0), "k") == []


def test_hot_and_null_keys_are_dealt_over_tasks(spark):
    left, right = sides(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(joined):
            return joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain = largest(left.join(right, "k", "left"))
        spread = largest(spread_join(left, right, ["k"], "left", [7]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spread < plain / 2


def test_text_keys_match_by_value_and_stay_text(spark):
    users = spark.createDataFrame([("1", "a"), ("x", "b"), ("-2", "c"), ("3", "d")], "id string, n string")
    spend = spark.createDataFrame([(1, 10), (1, 11), (-2, 5)], "id int, age int")
    assert rows_of(join_spend(users, spend, "inner")) == [("-2", "c", 5), ("1", "a", 10), ("1", "a", 11)]
    left = rows_of(join_spend(users, spend, "left"))
    assert len(left) == 5 and ("x", "b", None) in left


def test_rows_of_hot_keys_are_repeated_by_share(spark):
    left, right = sides(spark)
    shares = hot_shares(left, "k", 0.05, look_at=1)
    assert list(shares) == [7] and abs(shares[7] - 1 / 2) < 0.01  # of the rows that have a key
    hot = {7: 1 / 3, 11: 0.002, 12: 0.0001, 13: 0.9}
    assert salts_by_share(hot, 2000) == {1334: [7], 8: [11], 2: [12], 2000: [13]}
    assert salts_by_share({7: 1 / 3, 11: 0.2}, 2) == {2: [7, 11]}
    many = {k: 0.001 for k in range(1000)}
    assert sum(n * len(v) for n, v in salts_by_share(many, 2000).items()) <= 2 * 2000
    joined = spread_join(left, right, ["k"], "inner", {7: 1 / 3, 11: 0.002}, salts=2000)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "1334" in plan and "8" in plan
    assert joined.where("k = 7").count() == 2000 and joined.where("k = 11").count() == left.where("k = 11").count()

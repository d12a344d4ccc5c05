from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from medallion.functions import (
    anonymised,
    capitalised,
    clean_users,
    label_for,
    parsed_time,
    soft_cast,
)
from medallion.functions.cleaning import clean_users_declared


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "c string").select(column).first()[0]


def test_known_answers(spark):
    assert one(spark, "abc", anonymised("c")) == "a9993e364706816aba3e25717850c26c9cd0d89d"
    assert one(spark, None, anonymised("c")) is None
    assert one(spark, "mary-ann o'NEIL", capitalised("c")) == "Mary-ann O'neil"
    assert one(spark, "12-31-2014 23:59:59", parsed_time("c")) == datetime(2014, 12, 31, 23, 59, 59)
    assert one(spark, "2014-12-31", parsed_time("c")) is None
    assert one(spark, None, parsed_time("c")) is None


def test_labels(spark):
    names = {"cluster_0": "small", "cluster_1": "large"}
    got = spark.range(3).select(label_for(F.col("id"), names).alias("n")).orderBy("id").collect()
    assert [row.n for row in got] == ["small", "large", None]


ODD = """1|-5|+7| 8 |1.5|.5|5.|1e3|0x1p3|1E|x|||-|--1|1 2|NaN|nan|inf|-Infinity|infinity|1f|2D|99999999999|
9223372036854775808|١|1_000|\x001|1\x7f|1.2.3|e5|+.e1|bad-5|nand|infx|5L|0x10|true"""


@pytest.mark.parametrize("dtype", ["tinyint", "int", "bigint", "float", "double", "decimal(10,2)", "date", "boolean"])
def test_soft_cast_equals_try_cast(spark, dtype):
    text = [(t,) for t in ODD.replace("\\x00", "\x00").split("|")] + [(None,)]
    df = spark.createDataFrame(text, "t string")
    odd = df.select("t", soft_cast(F.col("t"), dtype).alias("a"), F.col("t").try_cast(dtype).alias("b"))
    assert odd.where("NOT (a <=> b)").collect() == []


def user(spark):
    names = "id email firstname lastname address city creation_date last_activity_date last_ip postcode".split()
    values = ("x1", "a@b", "ann", "lee ray", "1 st", "rome", "01-02-2015 00:00:00", "bad", "1.1.1.1", "00001")
    return spark.createDataFrame([(*values, '{"k":1}')], ", ".join(f"{n} string" for n in [*names, "_rescued_data"]))


def test_variants_of_the_silver_step(spark):
    notebook = clean_users(user(spark), capitalise=True, cast_id=False).first()
    assert (notebook.id, notebook.firstname, notebook.lastname) == ("x1", "Ann", "Lee Ray")
    assert notebook.creation_date == datetime(2015, 1, 2) and notebook.last_activity_date is None
    assert "_rescued_data" not in notebook
    declared = clean_users_declared(user(spark)).first()
    assert (declared.id, declared.firstname) == (None, "ann")
    assert list(declared.asDict())[:4] == ["id", "email", "creation_date", "last_activity_date"]

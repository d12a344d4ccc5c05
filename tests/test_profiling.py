from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pytest
from conftest import rows_of

from medallion.operators import compact_folder, profiling
from medallion.operators.profiling import (
    density,
    frequent_values,
    histograms,
    pair_density,
    pair_histograms,
    pair_regression,
    table_profile,
)
from medallion.operators.ranking import latest_by, latest_for, top_groups


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(10, 3, 400)
    rows = [(float(x), float(2 * x + rng.normal()), "even" if i % 2 == 0 else None) for i, x in enumerate(a)]
    rows += [(None, 1.0, "odd")]
    return spark.createDataFrame(rows, "a double, b double, c string"), rows


def test_profile(points):
    df, rows = points
    got = {row.column: row for row in table_profile(df).collect()}
    a = np.array([r[0] for r in rows if r[0] is not None])
    assert (got["a"].rows, got["a"].nulls, got["c"].nulls) == (401, 1, 200)
    assert math.isclose(got["a"].mean, a.mean()) and math.isclose(got["a"].stddev, a.std(ddof=1))
    assert float(got["a"].min) == a.min() and float(got["a"].max) == a.max()
    assert abs(got["a"].quantiles[1] - np.median(a)) < 0.5 and abs(got["a"].approx_distinct - 400) < 40
    assert (got["c"].min, got["c"].max, got["c"].approx_distinct) == ("even", "odd", 2)
    assert got["c"].mean is None and got["c"].quantiles is None


def test_frequent_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v, 1) for v in "bbaac"] + [(None, 1)] * 9, "x string, y int")
    got = rows_of(frequent_values(df, ["x", "y"], k=2))
    assert got == [("x", "a", 2, 1), ("x", "b", 2, 2), ("y", "1", 14, 1)]


def test_regression_against_least_squares(points):
    df, rows = points
    a, b = np.array([r[:2] for r in rows if r[0] is not None]).T
    row = pair_regression(df, ["a", "b"]).first()
    slope, intercept = np.polyfit(a, b, 1)
    assert math.isclose(row.slope, slope, rel_tol=1e-9)
    assert math.isclose(row.intercept, intercept, rel_tol=1e-6)
    assert math.isclose(row["corr"], np.corrcoef(a, b)[0, 1], rel_tol=1e-9)


def test_histograms_count_every_value_once(points):
    df, rows = points
    a, b = np.array([r[:2] for r in rows if r[0] is not None]).T
    got = {row.bin: row.c for row in histograms(df, ["a"], bins=10).collect()}
    want, _ = np.histogram(a, bins=10)
    assert [got.get(i, 0) for i in range(10)] == want.tolist()
    pairs = pair_histograms(df, ["a", "b"], bins=6).collect()
    assert sum(row.c for row in pairs) == len(a)
    flat = histograms(df.selectExpr("1 AS k"), ["k"], bins=5).collect()
    assert [(row.bin, row.c) for row in flat] == [(0, 401)]


def test_density_against_a_direct_kernel_sum(points):
    df, rows = points
    a = np.array([r[0] for r in rows if r[0] is not None])
    h = a.std(ddof=1) * len(a) ** (-1 / 5)
    for row in density(df, ["a"], bins=400, points=15).collect():
        z = (row.at - a) / h
        want = np.exp(-z * z / 2).sum() / (len(a) * h * math.sqrt(2 * math.pi))
        assert abs(row.density - want) < 1e-3


def test_density_surface_against_a_direct_kernel_sum(points):
    df, rows = points
    xy = np.array([r[:2] for r in rows if r[0] is not None])
    known = df.where("a IS NOT NULL")
    h = xy.std(axis=0, ddof=1) * len(xy) ** (-1 / 6)
    low, span = xy.min(axis=0), np.ptp(xy, axis=0)
    got = pair_density(known, ["a", "b"], bins=80, points=6).collect()
    assert len(got) == 36
    for row in got:
        at = low + np.array([row.x_point, row.y_point]) / 5 * span
        z = (at - xy) / h
        want = np.exp(-(z**2) / 2).prod(axis=1).sum() / (len(xy) * h.prod() * 2 * math.pi)
        assert abs(row.density - want) < 5e-4


def test_rankings(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 6), ("b", 2, 1), ("b", 2, 2), ("c", None, 9)], "k string, t int, v int"
    )
    assert [tuple(r) for r in top_groups(df, "k", 2).collect()] == [("a", 2), ("b", 2)]
    assert rows_of(latest_by(df, "k", "t", "v")) == [("a", 2, 6), ("b", 2, 2), ("c", None, 9)]
    assert [tuple(r) for r in latest_for(df, "k = 'a'", "t").collect()] == [("a", 2, 6)]
    assert latest_for(df, "k = 'z'", "t").isEmpty()


def test_compact_folder_keeps_rows_and_splits_equal_values(spark, folder):
    rows = spark.range(2000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id % 2 AS v")
    rows.repartition(20).write.parquet(f"{folder}/small")
    compacted = compact_folder(spark, f"{folder}/small", f"{folder}/one")
    assert rows_of(compacted) == rows_of(rows) and len(compacted.inputFiles()) == 1
    split = compact_folder(spark, f"{folder}/small", f"{folder}/four", 6000, cluster_by=["v"])
    sizes = [n for (n,) in split.groupBy("_metadata.file_name").count().select("count").collect()]
    assert rows_of(split) == rows_of(rows) and len(sizes) > 2 and max(sizes) < 1000


def test_pairs_cover_all_columns(points):
    df, _ = points
    wide = df.selectExpr("a", "b", "a * b AS d")
    got = {(r.x, r.y) for r in pair_regression(wide, ["a", "b", "d"]).collect()}
    assert got == set(combinations("abd", 2))


def test_nan_and_maps(spark):
    rows = spark.sql("SELECT * FROM VALUES (1.0D, map('a', 1)), (3.0D, NULL), (double('NaN'), map('a', 1)), (NULL, NULL) AS t(x, m)")
    bins = {r["bin"]: r["c"] for r in profiling.histograms(rows, ["x"], bins=2).collect()}
    assert bins == {0: 1, 1: 1}
    assert all(r["density"] == r["density"] for r in profiling.density(rows, ["x"]).collect())
    found = {r["column"]: r for r in profiling.table_profile(rows).collect()}
    assert found["m"]["min"] is None and found["m"]["nulls"] == 2 and found["m"]["approx_distinct"] == 1

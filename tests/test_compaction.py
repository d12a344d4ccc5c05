from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from medallion.operators import compaction
from medallion.operators.compaction import compact_folder, with_curve


def files_that_may_hold(folder: str, column: str, low, high) -> tuple[int, int]:
    """Files whose bounds of ``column`` meet the range, and all files."""
    met = total = 0
    for path in glob.glob(f"{folder}/*.parquet"):
        meta = pq.read_metadata(path)
        place = meta.schema.to_arrow_schema().get_field_index(column)
        bounds = [meta.row_group(i).column(place).statistics for i in range(meta.num_row_groups)]
        met += any(b.has_min_max and b.min <= high and b.max >= low for b in bounds)
        total += 1
    return met, total


def test_filters_on_either_clustered_column_skip_files(spark, folder):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("a"),
        F.format_string("%05d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000))).alias("b"),
        "id",
    )
    rows.write.parquet(f"{folder}/raw")
    spark.read.parquet(f"{folder}/raw").write.parquet(f"{folder}/in")
    got = compact_folder(spark, f"{folder}/in", f"{folder}/out", 32 << 10, ["a", "b"])
    assert rows_of(got.agg(F.count("*"), F.sum(F.xxhash64("a", "b", "id") % 1000003))) == rows_of(
        rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b", "id") % 1000003))
    )
    for column, low, high in (("a", 4000, 4100), ("b", "04000", "04100")):
        met, total = files_that_may_hold(f"{folder}/out", column, low, high)
        assert total >= 32 and met <= total / 3, (column, met, total)


def test_curve_takes_nulls_nan_ties_and_empty_tables(spark):
    rows = spark.createDataFrame(
        [(1, float("nan"), None), (1, None, "x"), (1, 2.0, "y"), (None, -1.0, "")], "a int, b double, c string"
    )
    got = with_curve(rows, ["a", "b", "c"])
    assert got.count() == 4 and got.where("_curve IS NULL OR _curve < 0").isEmpty()
    assert with_curve(rows.limit(0), ["a", "b"]).isEmpty()
    ordered = with_curve(spark.range(1000).selectExpr("id", "id AS other"), ["id", "other"]).orderBy("id")
    curve = [row._curve for row in ordered.collect()]
    assert curve == sorted(curve) and len(set(curve)) > 200
    with pytest.raises(ValueError, match="cannot cluster"):
        with_curve(spark.range(1).select(F.array("id").alias("a")), ["a"])


def test_packing_small_files_takes_no_shuffle(spark, folder):
    spark.range(1000).repartition(40, "id").write.parquet(f"{folder}/small")
    spark.sparkContext.setJobGroup("pack", "pack")
    got = compact_folder(spark, f"{folder}/small", f"{folder}/sized")
    tracker = spark.sparkContext.statusTracker()
    stages = [len(tracker.getJobInfo(job).stageIds) for job in tracker.getJobIdsForGroup("pack")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(stages) == {1}
    assert rows_of(got) == [(i,) for i in sorted(range(1000), key=lambda i: repr((i,)))]
    assert len(got.inputFiles()) == 1
    sizes = compact_folder(spark, f"{folder}/small", f"{folder}/some", target_bytes=8000).inputFiles()
    assert 1 < len(sizes) < 20


def test_large_clustered_files_are_sorted_in_pieces(spark, folder, monkeypatch):
    rows = spark.range(0, 100_000, 1, 4).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("a"))
    rows.write.parquet(f"{folder}/in")
    monkeypatch.setattr(compaction, "SORT_BYTES", 32 << 10)
    ranged, ranges = type(rows).repartitionByRange, []
    monkeypatch.setattr(type(rows), "repartitionByRange", lambda self, n, *c: (ranges.append(n), ranged(self, n, *c))[1])
    got = compact_folder(spark, f"{folder}/in", f"{folder}/out", 256 << 10, ["a"])
    files = len(glob.glob(f"{folder}/out/*.parquet"))
    assert 1 < files < 6 and ranges[0] >= 4 * files
    assert rows_of(got.agg(F.count("*"), F.sum("id"), F.sum("a"))) == rows_of(rows.agg(F.count("*"), F.sum("id"), F.sum("a")))
    met, total = files_that_may_hold(f"{folder}/out", "a", 10, 20)
    assert met == 1 and total == files
    place = got.select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"), "a").orderBy("file", "n").collect()
    falls = sum(x.a > y.a for x, y in zip(place, place[1:]) if x.file == y.file)
    assert falls <= ranges[0]  # a piece stays in order

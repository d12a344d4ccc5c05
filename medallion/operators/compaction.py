"""Rewrite many small files as few sized ones."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources.files import TARGET_FILE_BYTES, folder_bytes, sized_partitions

DEAL = "_deal"
CURVE = "_curve"
FILE = "_file"
#: Bytes of files whose rows a task sorts at once.
SORT_BYTES = 32 * 1024 * 1024


def _as_number(name: str, kind: T.DataType) -> Column:
    """A number in the order of the column's values; text and binary go by their first six bytes."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    raise ValueError(f"cannot cluster by {name}, a column of type {kind.simpleString()}")


def with_curve(rows: DataFrame, columns: list[str], bits: int = 8) -> DataFrame:
    """``rows`` with ``_curve``, the place of a row on a Z-order curve through ``columns``.

    Each column is cut into 2^``bits`` ranges that hold about as many rows each (approximate
    quantiles, a sketch per task), and the bits of the ranges' numbers are dealt in turn. Rows
    near on the curve are near in every column, so files cut from it have narrow bounds in all
    of them. NULL and NaN share the last range. Columns whose values repeat have fewer ranges.
    """
    bits = min(bits, 62 // len(columns))
    numbers = [f"_number{i}" for i in range(len(columns))]
    ranges = [f"_range{i}" for i in range(len(columns))]
    kinds = rows.schema
    plain = rows.withColumns({n: _as_number(c, kinds[c].dataType) for n, c in zip(numbers, columns)})
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    known = [F.when(~F.isnan(n), F.col(n)) for n in numbers]
    quantiles = [F.percentile_approx(n, shares, 10 << bits).alias(c) for n, c in zip(known, numbers)]
    found = plain.agg(*quantiles).first()
    ends = [[-float("inf"), *sorted(set(found[n] or [0.0])), float("inf")] for n in numbers]
    cut = Bucketizer(splitsArray=ends, inputCols=numbers, outputCols=ranges, handleInvalid="keep")

    def bit(i: int, place: int) -> Column:
        number = F.least(F.col(ranges[i]).cast("bigint"), F.lit((1 << bits) - 1))
        one = F.shiftright(number, place).bitwiseAND(F.lit(1).cast("bigint"))
        return F.shiftleft(one, place * len(columns) + i)

    dealt = [bit(i, place) for i in range(len(columns)) for place in range(bits)]
    curve = reduce(lambda a, b: a.bitwiseOR(b), dealt)
    return cut.transform(plain).withColumn(CURVE, curve).drop(*numbers, *ranges)


def write_sized(
    rows: DataFrame,
    path: str,
    source: str,
    target_bytes: int | None = None,
    cluster_by: list[str] | None = None,
    deal_by: list[str] | None = None,
    share: float = 1.0,
) -> int:
    """Write ``rows`` to ``path`` in files of about ``target_bytes``; returns the file count aimed at.

    The count comes from the bytes below ``source``, which ``rows`` were read from, and the
    ``share`` of its rows that they are.
    With ``cluster_by`` rows are ranged and sorted on that column, or on a Z-order curve through
    several, so that row-group statistics let later filters on any of them skip files. Equal
    values fall into one range, so a hash of ``deal_by`` (columns unique per row; by default
    a row number taken at the scan) comes last in the range key and splits a value that fills
    many files. A file of more than ``SORT_BYTES`` is sorted in pieces by as many tasks, and then put
    together, one piece after another in any order, so that no task sorts a whole file. Without ``cluster_by`` the same hash deals the rows, so a retried task deals alike.
    """
    size = int(folder_bytes(rows.sparkSession, source) * share)
    files = sized_partitions(size, target_bytes or TARGET_FILE_BYTES)
    unique = [F.col(name) for name in deal_by] if deal_by else [F.monotonically_increasing_id()]
    dealt = rows.withColumn(DEAL, F.xxhash64(*unique))
    if cluster_by:
        order = list(cluster_by)
        if len(order) > 1:
            dealt, order = with_curve(dealt, order), [CURVE]
        pieces = max(1, -(-size // (files * SORT_BYTES)))
        placed = dealt.repartitionByRange(files * pieces, *order, DEAL).drop(DEAL).sortWithinPartitions(*order)
        if pieces > 1:
            placed = placed.withColumn(FILE, F.expr(f"int(spark_partition_id() div {pieces})")).repartitionById(files, F.col(FILE))
    else:
        placed = dealt.repartition(files, DEAL)
    placed = placed.drop(DEAL, CURVE, FILE)
    placed.write.mode("overwrite").parquet(path)
    return files


def packed(spark: SparkSession, source: str, target_bytes: int | None = None) -> DataFrame:
    """A parquet folder read so that a task has files of about ``target_bytes`` together: written
    again it has sized files, without a shuffle.

    The reader packs files itself; a session of its own tells it by what size.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", target_bytes or TARGET_FILE_BYTES)
    own.conf.set("spark.sql.files.openCostInBytes", 0)
    own.conf.set("spark.sql.files.minPartitionNum", 1)
    return own.read.parquet(source)


def compact_folder(
    spark: SparkSession,
    source: str,
    target: str,
    target_bytes: int | None = None,
    cluster_by: list[str] | None = None,
) -> DataFrame:
    """A parquet folder copied to ``target`` in sized files: the same rows, fewer files.

    Only ``cluster_by`` takes a shuffle, see :func:`write_sized`.
    """
    if cluster_by:
        write_sized(spark.read.parquet(source), target, source, target_bytes, cluster_by)
    else:
        packed(spark, source, target_bytes).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)

"""Landing folders: inventory, in-place queries, tolerance of a missing folder."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.session import no_rows

FILE_LIST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)

TARGET_FILE_BYTES = 256 * 1024 * 1024


def read_or_empty(
    spark: SparkSession, read: Callable[[], DataFrame], schema: T.StructType
) -> DataFrame:
    """``read()``, or no rows of ``schema`` when its folder does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, schema)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file below ``folder``. File contents are pruned, so none are opened."""

    def read() -> DataFrame:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        return files.load(folder).select(*FILE_LIST.names)

    return read_or_empty(spark, read, FILE_LIST)


def has_files(spark: SparkSession, folder: str) -> bool:
    return not list_files(spark, folder).isEmpty()


def backdate(spark: SparkSession, paths: list[str], days: int) -> None:
    """Set the modification time of files ``days`` back, as a copy that keeps times would."""
    jvm, then = spark._jvm, int((time.time() - days * 86400) * 1000)
    for path in paths:
        file = jvm.org.apache.hadoop.fs.Path(path)
        file.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(file, then, -1)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    return list_files(spark, folder).agg(F.sum("length")).first()[0] or 0


def sized_partitions(total_bytes: int, target_bytes: int = TARGET_FILE_BYTES, least: int = 1) -> int:
    """How many partitions of about ``target_bytes`` hold ``total_bytes``."""
    return max(least, -(-total_bytes // target_bytes))


def query_in_place(spark: SparkSession, folder: str, fmt: str = "json") -> DataFrame:
    """The files of a folder as a table, without loading them first."""
    quoted = folder.replace("`", "``")
    return spark.sql(f"SELECT * FROM {fmt}.`{quoted}`")

"""Bulk load of a folder into a table: files loaded before are skipped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.cleaning import RESCUED

from medallion.sources.csv_folder import csv_batches
from medallion.sources.files import has_files
from medallion.sources.json_lines import json_stream
from medallion.streaming.control import finish


#: Partition column of a table that CSV files are copied into: which micro-batch of which load wrote a row.
LOAD = "_load"


def table_appender(spark: SparkSession, table: str, schema: T.StructType) -> Callable[[DataFrame, int], None]:
    """A sink that adds micro-batches to a catalog table, made if absent, each as a partition of its own.

    A batch that is delivered again after a failure replaces its partition, so no row is lost or
    there twice. The partition is named after the stream's checkpoint, so other loads are untouched.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != RESCUED)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {RESCUED} STRING, {LOAD} STRING) "
        f"USING parquet PARTITIONED BY ({LOAD})"
    )
    if spark.table(table).columns[-1] != LOAD:
        raise ValueError(f"{table} is not partitioned by {LOAD}")

    def sink(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        loaded = rows.withColumn(LOAD, F.lit(f"{stream}-{batch_id}"))
        shaped = session.table(table).limit(0).unionByName(loaded, allowMissingColumns=True)
        shaped.write.insertInto(table, overwrite=True)

    return sink


def copy_into(
    spark: SparkSession,
    target,
    folder: str,
    fmt: str,
    schema: T.StructType,
    checkpoint: str,
) -> int:
    """Load the files of ``folder`` not loaded yet; returns the number of micro-batches.

    ``target`` is a table name, or for CSV also a :class:`ChangeLog`; see :func:`table_appender`
    for CSV into a table. A missing or empty folder loads nothing.
    """
    if not has_files(spark, folder):
        return 0
    if fmt == "json":
        writer = json_stream(spark, folder, schema).writeStream
        writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query = writer.toTable(target)
    elif fmt == "csv":
        to_table = isinstance(target, str)
        sink = table_appender(spark, target, schema) if to_table else target.batch_appender(checkpoint)
        writer = csv_batches(spark, folder, schema, sink)
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    else:
        raise ValueError(f"no bulk load for format {fmt!r}")
    loaded = sum(1 for progress in finish(query) if progress["numInputRows"] > 0)
    if isinstance(target, str):
        spark.catalog.refreshTable(target)
    return loaded

"""JSON lines to typed columns, keeping what does not fit as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.casting import soft_cast
from medallion.functions.cleaning import RESCUED

BATCH_BYTES = 1 << 40
#: A file source skips files this much older than the newest one it saw. Spark's default of a week
#: loses what is moved or copied in with its old time, so nothing is too old here.
MAX_AGE = "36500d"


def as_map(value: str) -> Column:
    """The cells of a line that is one JSON object and nothing else, NULL for any other line.

    A parser stops at the end of the first object and takes one of two equal keys; as the only
    element of an array, text after the object is an error, and repeated keys are counted.
    """
    cells = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    found = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), cells)
    keys = F.map_keys(found[0])
    whole = (F.size(found) == 1) & (F.size(F.array_distinct(keys)) == F.size(keys))
    return F.when(whole, found[0])


def misfits(cells: Column, schema: T.StructType) -> Column:
    """The cells that are unknown to ``schema`` or do not cast to it.

    ``cells`` is a string-to-string map of one raw row. String columns always
    cast, so only typed columns add a test.
    """
    typed = [field for field in schema if not isinstance(field.dataType, T.StringType)]

    def misfit(name: Column, cell: Column) -> Column:
        found = ~name.isin(schema.names)
        for field in typed:
            lost = cell.isNotNull() & soft_cast(cell, field.dataType).isNull()
            found = found | ((name == field.name) & lost)
        return found

    return F.map_filter(cells, misfit)


def rescued_text(cells: str) -> Column:
    """A map column as JSON text, NULL when it is empty."""
    return F.when(F.size(cells) > 0, F.to_json(cells))


def throttled(reader, max_files: int | None = None, max_age: str = MAX_AGE):
    """A stream reader with limited micro-batches that takes files of any age up to ``max_age``."""
    reader = reader.option("maxFileAge", max_age)
    if max_files:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", BATCH_BYTES)


def json_lines(reader, folder: str) -> DataFrame:
    """Raw non-blank lines from ``spark.read`` or ``spark.readStream``."""
    lines = reader.option("recursiveFileLookup", True).text(folder)
    return lines.where(F.length(F.trim("value")) > 0)


def parse_json(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Column ``value`` to the columns of ``schema`` and ``_rescued_data``.

    A line that is no JSON object gives NULL columns and is rescued whole. The
    schema of the text source never changes, so a wider ``schema`` can resume an
    old checkpoint.
    """
    return typed_cells(lines.select("value", as_map("value").alias("m")), schema)


def typed_cells(cells: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines (``value``) parsed to maps (``m``) as the columns of ``schema`` and ``_rescued_data``."""
    parsed = cells.select("*", misfits(F.col("m"), schema).alias("misfits"))
    columns = [
        soft_cast(F.col("m")[field.name], field.dataType).alias(field.name)
        for field in schema
        if field.name != RESCUED
    ]
    kept = F.when(F.col("m").isNull(), F.col("value")).otherwise(rescued_text("misfits"))
    return parsed.select(*columns, kept.alias(RESCUED))


def json_stream(
    spark: SparkSession, folder: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """New JSON files of ``folder`` as a stream, at most ``max_files`` per micro-batch.

    Without ``max_files`` a micro-batch is limited by bytes, so that a first load of a
    large folder is committed in steps.
    """
    reader = throttled(spark.readStream, max_files)
    return parse_json(json_lines(reader, folder), schema)

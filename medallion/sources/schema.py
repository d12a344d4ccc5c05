"""Schemas of landing folders: sampled inference, hints, and a remembered, widening schema."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.session import literal_rows
from medallion.sources.files import list_files
from medallion.sources.json_lines import as_map, json_lines, throttled, typed_cells


def _all_strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def infer_schema(
    spark: SparkSession, folder: str, fmt: str = "json", sample_files: int = 10
) -> T.StructType:
    """Column names seen in the first ``sample_files`` files, all typed as strings.

    Only names are inferred: a type guessed from a sample breaks on the first row
    that disagrees. Types come from hints, see :func:`apply_hints`.
    """
    sample = list_files(spark, folder).orderBy("path").limit(sample_files).collect()
    paths = [row.path for row in sample]
    if not paths:
        return T.StructType([])
    if fmt == "json":
        return _all_strings(spark.read.option("primitivesAsString", True).json(paths).columns)
    names: dict[str, None] = {}
    for path in paths:
        names.update(dict.fromkeys(spark.read.option("header", True).csv(path).columns))
    return _all_strings(list(names))


def apply_hints(schema: T.StructType, hints: str) -> T.StructType:
    """Override the types of hinted columns by name; hinted columns not seen yet are added."""
    hinted = {field.name: field for field in T.StructType.fromDDL(hints)}
    fields = [hinted.pop(field.name, field) for field in schema]
    return T.StructType([*fields, *hinted.values()])


class SchemaLog:
    """The schema of a folder, kept next to the checkpoint; each widening adds one row."""

    ROW = "version int, schema string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _latest(self) -> tuple[int, T.StructType | None]:
        try:
            log = self.spark.read.schema(self.ROW).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1, None
        row = log.orderBy(F.desc("version")).first()
        if row is None:
            return -1, None
        return row.version, T.StructType.fromJson(json.loads(row.schema))

    def load(self) -> T.StructType | None:
        return self._latest()[1]

    def save(self, schema: T.StructType) -> None:
        version, current = self._latest()
        if current == schema:
            return
        row = literal_rows(self.spark, [(version + 1, schema.json())], self.ROW)
        row.write.mode("append").parquet(self.path)

    def load_or_infer(
        self, folder: str, fmt: str = "json", hints: str = "", sample_files: int = 10
    ) -> T.StructType:
        schema = self.load()
        if schema is None:
            schema = infer_schema(self.spark, folder, fmt, sample_files)
            if not schema.fields:
                return apply_hints(schema, hints) if hints else schema
            if hints:
                schema = apply_hints(schema, hints)
            self.save(schema)
        return schema

    def widen(self, names: list[str]) -> T.StructType:
        """Add unseen columns as strings, in name order."""
        schema = self.load() or T.StructType([])
        extra = sorted(set(names) - set(schema.names))
        if extra:
            schema = T.StructType([*schema.fields, *_all_strings(extra).fields])
            self.save(schema)
        return schema


def _note_columns(cells: DataFrame, folder: str, log: SchemaLog, max_columns: int) -> T.StructType:
    """Widen ``log`` by the keys of the maps ``m``; the driver sees distinct names, ``max_columns`` of them at most."""
    keys = cells.select(F.explode(F.map_keys("m")).alias("name")).distinct()
    names = [row.name for row in keys.limit(max_columns + 1).collect()]
    if len(set(names) | set((log.load() or T.StructType([])).names)) > max_columns:
        raise ValueError(f"{folder} has more than {max_columns} column names; keys that are data belong in a map")
    return log.widen(names)


def track_json_columns(
    spark: SparkSession, folder: str, log: SchemaLog, checkpoint: str, max_columns: int = 1000
) -> T.StructType:
    """Widen the remembered schema with the columns of files that arrived since the last call.

    The checkpoint of this stream decides which files are new, so each file is
    looked at once. What reaches the driver is the set of distinct column names; a schema
    that would grow past ``max_columns`` fails.
    """

    def note_columns(batch: DataFrame, batch_id: int) -> None:
        _note_columns(batch, folder, log, max_columns)

    lines = json_lines(throttled(spark.readStream), folder).select(as_map("value").alias("m"))
    writer = lines.writeStream.foreachBatch(note_columns).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return log.load() or T.StructType([])


def json_batches(
    spark: SparkSession,
    folder: str,
    log: SchemaLog,
    sink: Callable[[DataFrame, int], None],
    max_files: int | None = None,
    max_columns: int = 1000,
):
    """A stream writer that hands new JSON files to ``sink(rows, batch_id)`` and lets unseen columns join the schema.

    Each file is read and parsed once: the parsed lines of a micro-batch stay on the executors' disks while their
    names widen ``log``, and then become typed columns and ``_rescued_data``. ``sink`` must be idempotent per
    batch id and take wider rows, as :meth:`ChangeLog.batch_appender` does.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        cells = batch.persist(StorageLevel.DISK_ONLY)
        try:
            sink(typed_cells(cells, _note_columns(cells, folder, log, max_columns)), batch_id)
        finally:
            cells.unpersist()

    lines = json_lines(throttled(spark.readStream, max_files), folder)
    return lines.select("value", as_map("value").alias("m")).writeStream.foreachBatch(load)

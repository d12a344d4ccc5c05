"""CSV files with a header line, bound by column name even when the headers differ."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.casting import soft_cast
from medallion.session import no_rows
from medallion.sources.json_lines import RESCUED, misfits, rescued_text, throttled
from medallion.sources.schema import SchemaLog

CORRUPT = "_corrupt_record"
OPEN_AT_ONCE = 16
BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _raw_cells(spark: SparkSession, paths: list[str], width: int) -> DataFrame:
    """The cells of files that have ``width`` columns as strings c0, c1, ..., by position."""
    names = [*(f"c{i}" for i in range(width)), CORRUPT]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(paths)


def _named_cells(
    cells: list[Column], headers: list[list[str]]
) -> tuple[Callable[[str], Column], Column]:
    """How to find the cell of a name, and the map of all cells by name.

    With one header both are fixed when the plan is made; with several a row finds its
    file's header in column ``header``.
    """
    if len(headers) == 1:
        places = dict(zip(headers[0], cells))
        pairs = [part for name, cell in places.items() for part in (F.lit(name), cell)]
        return lambda name: places.get(name, F.lit(None).cast("string")), F.create_map(*pairs)
    row = F.array(*cells)
    return lambda name: F.get(row, F.array_position("header", name) - 1), F.map_from_arrays("header", row)


def _parse_cells(cells: DataFrame, headers: list[list[str]], schema: T.StructType) -> DataFrame:
    """Typed columns plus ``_rescued_data``.

    The reader keeps the whole line when its cell count differs from the header's.
    A short line only lacks values; a long one has cells no column can take, so
    the line is rescued under the name of the corrupt-record column.
    """
    width = len(headers[0])
    find, named = _named_cells([F.col(f"c{i}") for i in range(width)], headers)
    wide = ", ".join(f"c{i} STRING" for i in range(width + 1))
    overflow = F.from_csv(F.col(CORRUPT), wide)[f"c{width}"]
    raw_line = F.when(overflow.isNotNull(), F.col(CORRUPT))
    all_cells = F.map_concat(named, F.create_map(F.lit(CORRUPT), raw_line))
    kept = F.map_filter(all_cells, lambda name, cell: cell.isNotNull())
    columns = [soft_cast(find(f.name), f.dataType).alias(f.name) for f in schema if f.name != RESCUED]
    cells = cells.withColumn("_misfits", misfits(kept, schema))
    return cells.select(*columns, rescued_text("_misfits").alias(RESCUED))


def header_lines(spark: SparkSession, paths: list[str]) -> list[str | None]:
    """First line that is not blank of each file, None where there is none.

    The driver opens every file and reads one buffer of it, many at a time: a scan cannot stop
    after a line per file, and a stream has at most ``max_files`` files a batch.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(path: str) -> str | None:
        file = jvm.org.apache.hadoop.fs.Path(path)
        data, codec = file.getFileSystem(conf).open(file), codecs.getCodec(file)
        data = codec.createInputStream(data) if codec else data
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8"))
        try:
            while (line := reader.readLine()) is not None and not line.strip():
                pass
            return line
        finally:
            reader.close()

    with ThreadPoolExecutor(OPEN_AT_ONCE) as pool:
        return list(pool.map(first, paths))


Groups = list[tuple[list[str], list[str]]]


def header_groups(spark: SparkSession, paths: list[str]) -> Groups:
    """(header, files) per distinct header; at most one group per listed file. Empty files have none."""
    by_line: dict[str, list[str]] = {}
    for path, line in zip(paths, header_lines(spark, paths)):
        if line is not None:
            by_line.setdefault(line, []).append(path)
    names = lambda path: spark.read.option("header", True).csv(path).columns
    return sorted((names(files[0]), sorted(files)) for files in by_line.values())


def read_csv_groups(spark: SparkSession, groups: Groups, schema: T.StructType) -> DataFrame:
    """Files by header group as typed columns by name, plus ``_rescued_data``.

    Every file is read once, all files with the same number of columns in one scan. Where their
    headers differ, a row looks its file's header up in a small table, a row per file.
    """
    by_width: dict[int, Groups] = {}
    for header, files in groups:
        by_width.setdefault(len(header), []).append((header, files))
    parts = []
    for width, same in sorted(by_width.items()):
        headers = [header for header, _ in same]
        cells = _raw_cells(spark, [path for _, files in same for path in files], width)
        if len(headers) > 1:
            listed = [(path, header) for header, files in same for path in files]
            of_file = F.broadcast(spark.createDataFrame(listed, "path string, header array<string>"))
            path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
            joined = cells.withColumn("path", path).join(of_file, "path", "left")
            unknown = F.raise_error(F.concat(F.lit("no header known of "), "path")).cast("array<string>")
            cells = joined.withColumn("header", F.coalesce("header", unknown))
        parts.append(_parse_cells(cells, headers, schema))
    return reduce(DataFrame.unionByName, parts) if parts else no_rows(spark, _with_rescue(schema))


def _with_rescue(schema: T.StructType) -> T.StructType:
    fields = [field for field in schema if field.name != RESCUED]
    return T.StructType([*fields, T.StructField(RESCUED, T.StringType())])


def read_csv_files(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    return read_csv_groups(spark, header_groups(spark, paths), schema)


def csv_batches(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    sink: Callable[[DataFrame, int], None],
    max_files: int = 1000,
    evolve: SchemaLog | None = None,
):
    """A stream writer that hands new CSV files to ``sink(rows, batch_id)``.

    The stream carries file names only, and the driver sees at most ``max_files``
    of them at a time, with their headers. ``sink`` must be idempotent per batch id.

    With ``evolve`` an unseen column joins the remembered schema, as text, and is
    part of ``rows`` from that batch on; without it its cells are rescued.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(row.path for row in batch.collect())
        if not paths:
            return
        session, known = batch.sparkSession, schema
        groups = header_groups(session, paths)
        if evolve is not None:
            known = evolve.widen([name for header, _ in groups for name in header])
        sink(read_csv_groups(session, groups, known), batch_id)

    files = (
        throttled(spark.readStream, max_files)
        .format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path")
    )
    return files.writeStream.foreachBatch(load)

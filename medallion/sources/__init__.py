from medallion.sources.csv_folder import csv_batches, read_csv_files, read_csv_groups
from medallion.sources.files import (
    folder_bytes,
    has_files,
    list_files,
    query_in_place,
    read_or_empty,
    sized_partitions,
)
from medallion.sources.json_lines import json_lines, json_stream, parse_json
from medallion.sources.schema import SchemaLog, apply_hints, infer_schema, json_batches, track_json_columns

__all__ = [
    "SchemaLog",
    "apply_hints",
    "csv_batches",
    "folder_bytes",
    "has_files",
    "infer_schema",
    "json_batches",
    "json_lines",
    "json_stream",
    "list_files",
    "parse_json",
    "query_in_place",
    "read_csv_files",
    "read_csv_groups",
    "read_or_empty",
    "sized_partitions",
    "track_json_columns",
]

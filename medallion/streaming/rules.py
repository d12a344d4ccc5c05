"""Data-quality rules: count violations, and drop the rows that must not pass."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import literal_rows

METRICS = "flow string, rule string, batch_id bigint, passed bigint, failed bigint, dropped bigint"
METRIC_NAMES = ["flow", "rule", "batch_id", "passed", "failed", "dropped"]


@dataclass(frozen=True)
class Rule:
    """``condition`` is SQL over the output columns; a NULL outcome counts as failed."""

    name: str
    condition: str
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ("warn", "drop"):
            raise ValueError(f"rule {self.name}: action is warn or drop, not {self.action}")

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def _counters(rules: list[Rule]) -> list[Column]:
    failed = [F.count_if(~rule.holds).alias(f"failed_{rule.name}") for rule in rules]
    return [F.count(F.lit(1)).alias("rows"), *failed]


def kept_rows(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    drops = [rule.holds for rule in rules if rule.action == "drop"]
    return rows.where(reduce(Column.__and__, drops)) if drops else rows


def apply_rules(rows: DataFrame, name: str, rules: list[Rule]) -> DataFrame:
    """Observe every rule on all rows, then drop the rows that fail a drop rule.

    ``name`` labels the counters in the progress of a stream: counting rides on the job
    that writes the rows, no extra pass. A batch counts with :func:`rule_counts`.
    """
    if not rules:
        return rows
    return kept_rows(rows.observe(name, *_counters(rules)), rules)


def _metric_rows(flow: str, batch_id: int, rules: list[Rule], counts: dict) -> list[tuple]:
    rows = []
    for rule in rules:
        failed = counts[f"failed_{rule.name}"]
        dropped = failed if rule.action == "drop" else 0
        rows.append((flow, rule.name, batch_id, counts["rows"] - failed, failed, dropped))
    return rows


def rule_metrics(
    spark: SparkSession, flow: str, rules: list[Rule], progress: list[dict]
) -> DataFrame:
    """The counters of a finished stream as a table, a row per rule and micro-batch."""
    rows = []
    for entry in progress:
        observed = entry["observedMetrics"].get(flow)
        if observed is not None:
            counts = observed if isinstance(observed, dict) else observed.asDict()
            rows += _metric_rows(flow, entry["batchId"], rules, counts)
    return literal_rows(spark, rows, METRICS)


def metrics_path(root: str) -> str:
    return f"{root}/quality_metrics"


def _write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole under its name; one that is there already stays."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(target):
        return
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = store.create(draft)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not store.rename(draft, target):
        store.delete(draft, False)


def keep_counts(spark: SparkSession, root: str, flow: str, batch_id: int, rows: list[tuple]) -> None:
    """Store the counters ``rows`` of one micro-batch below ``root``, without a Spark job.

    The file's name is flow and batch, so a batch counted twice is stored once.
    """
    lines = [json.dumps(dict(zip(METRIC_NAMES, row))) + "\n" for row in rows]
    _write_once(spark, f"{metrics_path(root)}/of_flow={flow}/{batch_id}.json", "".join(lines))


def keep_metrics(spark: SparkSession, root: str, flow: str, rules: list[Rule], progress: dict) -> None:
    """Store the counters that a micro-batch's progress reports."""
    counts = progress["observedMetrics"].get(flow)
    if rules and counts is not None:
        counts = counts if isinstance(counts, dict) else counts.asDict()
        rows = _metric_rows(flow, progress["batchId"], rules, counts)
        keep_counts(spark, root, flow, progress["batchId"], rows)


def kept_batches(spark: SparkSession, root: str, flow: str) -> list[int]:
    """Numbers of the micro-batches whose counters are stored, from the names of the files."""
    return numbered_files(spark, f"{metrics_path(root)}/of_flow={flow}", ".json")


def numbered_files(spark: SparkSession, folder: str, suffix: str = "") -> list[int]:
    """Numbers that name files of ``folder``, in order; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    names = [entry.getPath().getName() for entry in store.listStatus(path)]
    numbers = [name.removesuffix(suffix) for name in names if name.endswith(suffix)]
    return sorted(int(n) for n in numbers if n.isdigit())


def kept_metrics(spark: SparkSession, root: str, flow: str | None = None) -> DataFrame:
    """All counters stored below ``root``: once per flow, rule and micro-batch, whatever run took the batch."""
    try:
        rows = spark.read.schema(METRICS).json(metrics_path(root)).select(*METRIC_NAMES)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal_rows(spark, [], METRICS)
    return rows if flow is None else rows.where(F.col("flow") == flow)


def batch_counts(rows: DataFrame, flow: str, batch_id: int, rules: list[Rule]) -> list[tuple]:
    """The counters of a batch as rows for :func:`keep_counts`; one aggregate over ``rows``."""
    return _metric_rows(flow, batch_id, rules, rows.agg(*_counters(rules)).first().asDict())


def rule_counts(rows: DataFrame, flow: str, rules: list[Rule]) -> DataFrame:
    """The same table for a batch, one aggregate over ``rows``; batch_id is NULL."""
    counts = rows.agg(*_counters(rules))
    entries = []
    for rule in rules:
        failed = F.col(f"failed_{rule.name}")
        entries.append(
            F.struct(
                F.lit(flow).alias("flow"),
                F.lit(rule.name).alias("rule"),
                F.lit(None).cast("bigint").alias("batch_id"),
                (F.col("rows") - failed).alias("passed"),
                failed.alias("failed"),
                (failed if rule.action == "drop" else F.lit(0).cast("bigint")).alias("dropped"),
            )
        )
    return counts.select(F.inline(F.array(*entries)))

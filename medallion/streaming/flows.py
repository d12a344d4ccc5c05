"""Chained incremental tables: each flow reads what is new, checks it and appends it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from medallion.operators.changelog import ChangeLog
from medallion.session import literal_rows, scratch_dir
from medallion.sources.files import list_files
from medallion.sources.json_lines import throttled
from medallion.streaming.control import finish
from medallion.streaming.rules import (
    METRICS,
    Rule,
    apply_rules,
    batch_counts,
    keep_counts,
    keep_metrics,
    kept_batches,
    numbered_files,
    rule_metrics,
)


@dataclass
class Flow:
    """One table of a pipeline.

    ``build`` returns the stream of rows. The rows go to the catalog table
    ``name``, or to ``target`` where the table needs deletes and history.
    """

    name: str
    build: Callable[[SparkSession], DataFrame]
    rules: list[Rule] = field(default_factory=list)
    comment: str = ""
    target: ChangeLog | None = None

    @property
    def label(self) -> str:
        return self.name.rsplit(".", 1)[-1]

    def checkpoint(self, root: str) -> str:
        return f"{root}/checkpoints/{self.label}"


def create_database(spark: SparkSession, name: str, location: str, reset: bool = False) -> None:
    """Create the database at ``location`` and use it; ``reset`` empties it first."""
    if reset:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    spark.sql(f"USE {name}")


def new_rows(spark: SparkSession, table: str, max_files: int | None = None) -> DataFrame:
    """Rows added to a table since the reading flow's last run, as a stream."""
    return throttled(spark.readStream, max_files).table(table)


def add_missing_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Widen a parquet table; older rows read the new columns as NULL."""
    known = {name.lower() for name in spark.table(table).columns}
    extra = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name.lower() not in known]
    if extra:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(extra)})")


def append_to_table(spark: SparkSession, rows: DataFrame, table: str) -> None:
    """Batch append; columns the table lacks are added to it, columns ``rows`` lacks are NULL."""
    if not spark.catalog.tableExists(table):
        rows.write.format("parquet").saveAsTable(table)
        return
    add_missing_columns(spark, table, rows.schema)
    shape = spark.table(table).limit(0)
    shape.unionByName(rows, allowMissingColumns=True).write.mode("append").saveAsTable(table)


class _CounterListener(StreamingQueryListener):
    """Stores the counters of every micro-batch of the flows it knows, as each ends."""

    def __init__(self) -> None:
        self.flows: dict[str, Callable[[dict], None]] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        keep = self.flows.get(str(event.progress.id))
        if keep:
            keep({"batchId": event.progress.batchId, "observedMetrics": event.progress.observedMetrics})

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


_listeners: dict[SparkSession, _CounterListener] = {}


def _listener(spark: SparkSession) -> _CounterListener:
    if spark not in _listeners:
        _listeners[spark] = _CounterListener()
        spark.streams.addListener(_listeners[spark])
    return _listeners[spark]


def uncounted_batches(spark: SparkSession, flow: Flow, root: str) -> list[int]:
    """Micro-batches that were committed while nobody was left to store their counters."""
    if not flow.rules:
        return []
    done = numbered_files(spark, f"{flow.checkpoint(root)}/commits")
    counted = kept_batches(spark, root, flow.label)
    return [batch for batch in done if batch > max(counted, default=-1)]


def recount(spark: SparkSession, flow: Flow, root: str) -> None:
    """Store the counters that a killed driver left out.

    A copy of the checkpoint that ends before the commit of such a micro-batch makes the stream
    take it once more, with the offsets it had; it is counted and nothing else. What arrived
    since is no part of it. A joined table is read as it is now.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    checkpoint = flow.checkpoint(root)
    for batch in uncounted_batches(spark, flow, root):
        copy = scratch_dir(spark, "recount")
        store = hadoop.Path(copy).getFileSystem(conf)
        wanted = ["metadata", "sources", "state", f"offsets/{batch - 1}", f"offsets/{batch}", f"commits/{batch - 1}"]
        for name in wanted:
            source, target = hadoop.Path(f"{checkpoint}/{name}"), hadoop.Path(f"{copy}/{name}")
            if store.exists(source):
                store.mkdirs(target.getParent())
                hadoop.FileUtil.copy(store, source, store, target, False, conf)

        def count(rows: DataFrame, batch_id: int, only: int = batch) -> None:
            if batch_id == only:
                counts = batch_counts(rows, flow.label, batch_id, flow.rules)
                keep_counts(spark, root, flow.label, batch_id, counts)

        query = flow.build(spark).writeStream.foreachBatch(count).option("checkpointLocation", copy)
        query.trigger(availableNow=True).start().awaitTermination()
        store.delete(hadoop.Path(copy), True)


def start_flow(spark: SparkSession, flow: Flow, root: str, once: bool = False) -> StreamingQuery:
    """Start a flow: micro-batches as data arrives, or with ``once`` what is there now.

    The checkpoint belongs to this flow and this target alone, so a restart adds
    only what arrived since. The counters of its rules are stored below ``root`` micro-batch by
    micro-batch, see :func:`~medallion.streaming.rules.kept_metrics`; those that a killed
    driver did not get to are counted again first.
    """
    recount(spark, flow, root)
    rows = apply_rules(flow.build(spark), flow.label, flow.rules)
    writer = rows.writeStream.option("checkpointLocation", flow.checkpoint(root))
    if once:
        writer = writer.trigger(availableNow=True)
    if flow.target is not None:
        query = writer.foreachBatch(flow.target.batch_appender(flow.label)).start()
    else:
        if spark.catalog.tableExists(flow.name):
            add_missing_columns(spark, flow.name, rows.schema)
        query = writer.format("parquet").toTable(flow.name)
        if flow.comment:
            text = flow.comment.replace("'", "\\'")
            spark.sql(f"COMMENT ON TABLE {flow.name} IS '{text}'")
    if flow.rules and not once:
        keep = lambda progress: keep_metrics(spark, root, flow.label, flow.rules, progress)
        _listener(spark).flows[str(query.id)] = keep
        # what ended before the listener knew the query
        for progress in query.recentProgress:
            keep(progress)
    return query


def run_flow(spark: SparkSession, flow: Flow, root: str) -> DataFrame:
    """Take in everything new, then stop; returns the rule counters of this run.

    Each micro-batch's counters are also stored below ``root`` as it ends; a batch that failed adds nothing.
    """
    keep = lambda progress: keep_metrics(spark, root, flow.label, flow.rules, progress)
    progress = finish(start_flow(spark, flow, root, once=True), keep=keep)
    return rule_metrics(spark, flow.label, flow.rules, progress)


def last_commit(spark: SparkSession, flow: Flow, root: str) -> datetime | None:
    """When the flow last finished a micro-batch."""
    commits = list_files(spark, f"{flow.checkpoint(root)}/commits")
    return commits.agg(F.max("modificationTime")).first()[0]


def run_flows(spark: SparkSession, flows: list[Flow], root: str) -> DataFrame:
    """Run flows in the order given, each after the one before it has finished."""
    metrics = [run_flow(spark, flow, root) for flow in flows]
    return reduce(DataFrame.unionByName, metrics, literal_rows(spark, [], METRICS))

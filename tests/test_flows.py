from __future__ import annotations

import os
import time

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from medallion.operators import ChangeLog
from medallion.streaming import (
    Flow,
    Rule,
    apply_rules,
    new_rows,
    rule_counts,
    run_flow,
    run_flows,
    start_flow,
    stop_all_streams,
    wait_for_all_streams,
)
from medallion.streaming.flows import append_to_table, create_database, last_commit, uncounted_batches

RULES = [Rule("has_v", "v IS NOT NULL", "drop"), Rule("small", "v < 5", "drop"), Rule("warned", "k <> 'a'")]
ROWS = [("a", 1), ("a", None), ("b", 9), (None, 2)]


def frame(spark):
    return spark.createDataFrame(ROWS, "k string, v int")


def test_rules_count_before_they_drop(spark):
    assert rows_of(apply_rules(frame(spark), "rules", RULES)) == [("a", 1), (None, 2)]
    counts = {row.rule: tuple(row)[3:] for row in rule_counts(frame(spark), "f", RULES).collect()}
    assert counts == {"has_v": (3, 1, 1), "small": (2, 2, 2), "warned": (1, 3, 0)}
    with pytest.raises(ValueError):
        Rule("x", "true", "fail")


def feed(spark, database, rows=ROWS):
    append_to_table(spark, spark.createDataFrame(rows, "k string, v int"), f"{database}.feed")


def test_chained_flows_take_each_row_once(spark, database, folder):
    feed(spark, database)
    flows = [
        Flow(f"{database}.one", lambda s: new_rows(s, f"{database}.feed"), RULES[2:], "first, it's raw"),
        Flow(f"{database}.two", lambda s: new_rows(s, f"{database}.one"), RULES[:2]),
        Flow(f"{database}.three", lambda s: new_rows(s, f"{database}.two"), target=ChangeLog(spark, f"{folder}/log")),
    ]
    metrics = run_flows(spark, flows, folder)
    totals = {(r.flow, r.rule): (r.passed, r.failed, r.dropped) for r in metrics.collect()}
    assert totals == {
        ("one", "warned"): (1, 3, 0),
        ("two", "has_v"): (3, 1, 1),
        ("two", "small"): (2, 2, 2),
    }
    assert rows_of(flows[2].target.as_of()) == [("a", 1), (None, 2)]
    again = run_flows(spark, flows, folder)
    assert again.isEmpty() and flows[2].target.as_of().count() == 2
    feed(spark, database, [("c", 3)])
    run_flows(spark, flows, folder)
    assert flows[2].target.as_of().count() == 3 and spark.table(f"{database}.one").count() == 5
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.one").where("col_name = 'Comment'")
    assert described.first().data_type == "first, it's raw"
    assert last_commit(spark, flows[0], folder) is not None


def test_metrics_cover_every_batch(spark, database, folder):
    for i in range(3):
        feed(spark, database, [("a", i)])
    flow = Flow(f"{database}.one", lambda s: new_rows(s, f"{database}.feed", 1), RULES[2:])
    metrics = run_flow(spark, flow, folder).collect()
    files = [f for f in os.listdir(f"{folder}/tables/feed") if f.endswith(".parquet")]
    assert sum(row.failed for row in metrics) == 3 and len(metrics) == len(files)


def test_wider_rows_widen_the_table(spark, database):
    table = f"{database}.runs"
    append_to_table(spark, spark.createDataFrame([("a", "1")], "name string, date string"), table)
    append_to_table(spark, spark.createDataFrame([("x", "b")], "extra string, name string"), table)
    assert rows_of(spark.table(table)) == [("a", "1", None), ("b", None, "x")]


def test_database_reset_drops_and_creates(spark, folder):
    create_database(spark, "reset_me", f"{folder}/db")
    spark.range(3).write.saveAsTable("t")
    create_database(spark, "reset_me", f"{folder}/db", reset=True)
    assert spark.catalog.currentDatabase() == "reset_me" and not spark.catalog.tableExists("t")
    spark.sql("USE default")


def test_streams_without_a_trigger_run_until_stopped(spark, database, folder):
    feed(spark, database)
    flow = Flow(f"{database}.live", lambda s: new_rows(s, f"{database}.feed"))
    query = start_flow(spark, flow, folder)
    query.processAllAvailable()
    feed(spark, database, [("c", 3)])
    query.processAllAvailable()
    assert query.isActive and spark.table(flow.name).count() == 5
    assert stop_all_streams(spark) == 1
    wait_for_all_streams(spark)
    assert spark.streams.active == [] and stop_all_streams(spark) == 0


def test_waiting_for_all_streams(spark, database, folder):
    feed(spark, database)
    for name in ("x", "y"):
        flow = Flow(f"{database}.{name}", lambda s: new_rows(s, f"{database}.feed"))
        start_flow(spark, flow, folder, once=True)
    started = time.time()
    wait_for_all_streams(spark)
    assert spark.table(f"{database}.x").count() == spark.table(f"{database}.y").count() == 4
    assert time.time() - started < 60


def test_a_failed_flow_raises_and_can_be_resumed(spark, database, folder):
    feed(spark, database)
    name = f"{database}.shaky"
    broken = Flow(name, lambda s: new_rows(s, f"{database}.feed").withColumn("v", F.raise_error(F.lit("no"))))
    with pytest.raises(Exception):
        run_flow(spark, broken, folder)
    run_flow(spark, Flow(name, lambda s: new_rows(s, f"{database}.feed")), folder)
    assert spark.table(name).count() == 4


def test_counters_of_a_failed_run_are_kept(spark, database, folder):
    from medallion.streaming.rules import kept_metrics

    for i in range(3):
        spark.createDataFrame([(None if i != 1 else 3,)], "v int").coalesce(1).write.mode("append").json(f"{folder}/in")
        time.sleep(1.1)
    broken = f"{folder}/broken"
    os.makedirs(broken)

    def build(session):
        stop = F.udf(lambda v: 1 / 0 if v == 3 and os.path.exists(broken) else v, "int")
        rows = session.readStream.schema("v int").option("maxFilesPerTrigger", 1).json(f"{folder}/in")
        return rows.withColumn("v", stop("v"))

    flow = Flow(f"{database}.checked", build, [Rule("has_v", "v IS NOT NULL")])
    with pytest.raises(Exception):
        run_flow(spark, flow, folder)
    os.rename(broken, f"{folder}/mended")
    run_flow(spark, flow, folder)
    kept = kept_metrics(spark, folder, "checked")
    assert rows_of(kept.selectExpr("count(DISTINCT batch_id)", "count(*)", "sum(failed)", "sum(passed)")) == [(3, 3, 2, 1)]


def totals(spark, folder, flow):
    from medallion.streaming.rules import kept_metrics

    sums = [f"sum({c})" for c in ("passed", "failed", "dropped")]
    return rows_of(kept_metrics(spark, folder, flow).groupBy("rule").agg(F.count("*"), *map(F.expr, sums)))


def test_an_always_on_flow_keeps_its_counters(spark, database, folder):
    feed(spark, database)
    flow = Flow(f"{database}.live", lambda s: new_rows(s, f"{database}.feed"), RULES)
    query = start_flow(spark, flow, folder)
    query.processAllAvailable()
    feed(spark, database, [("c", None), ("a", 1)])
    query.processAllAvailable()
    expected = [("has_v", 2, 4, 2, 2), ("small", 2, 3, 3, 3), ("warned", 2, 2, 4, 0)]
    waited = time.time()
    while totals(spark, folder, "live") != expected and time.time() - waited < 20:
        time.sleep(0.2)
    query.stop()
    assert totals(spark, folder, "live") == expected


DRIVER = """
import os, sys
sys.path[:0] = [{root!r}, {tests!r}]
from medallion.session import build_session
from medallion.streaming import flows, rules
import test_flows
spark = build_session("killed", "local[2]", spark_sql_shuffle_partitions=2, spark_checkpoint_dir={folder!r})
flows.keep_metrics = lambda *given: os._exit(9)
flow = test_flows.file_flow({folder!r})
flow.target.spark = spark
flows.run_flow(spark, flow, {folder!r})
"""


def file_flow(folder, rules=RULES):
    def build(spark):
        lines = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).json(f"{folder}/in")
        return lines.where("k IS NULL OR k <> 'skipped'")

    return Flow("default.killed", build, rules, target=ChangeLog(None, f"{folder}/log"))


@pytest.mark.parametrize("arrives", [False, True])
def test_a_driver_killed_right_after_a_commit_loses_no_counter(spark, folder, arrives):
    import subprocess
    import sys

    for rows in (ROWS[:1], ROWS[1:], [("skipped", 7)]):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").json(f"{folder}/in")
    tests = os.path.dirname(os.path.abspath(__file__))
    script = DRIVER.format(root=os.path.dirname(tests), tests=tests, folder=folder)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=240)
    assert done.returncode == 9, done.stderr[-2000:]
    flow = file_flow(folder)
    flow.target.spark = spark
    assert uncounted_batches(spark, flow, folder) and totals(spark, folder, "killed") == []
    if arrives:
        spark.createDataFrame([("late", None)], "k string, v int").coalesce(1).write.mode("append").json(f"{folder}/in")
    run_flow(spark, flow, folder)
    run_flow(spark, flow, folder)
    late = int(arrives)
    found = [(rule, passed, failed, dropped) for rule, _, passed, failed, dropped in totals(spark, folder, "killed")]
    assert found == [("has_v", 3, 1 + late, 1 + late), ("small", 2, 2 + late, 2 + late), ("warned", 1 + late, 3, 0)]
    assert rows_of(flow.target.as_of()) == [("a", 1), (None, 2)] and uncounted_batches(spark, flow, folder) == []

from __future__ import annotations

import random
from collections import Counter
from datetime import timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from medallion.operators import ChangeLog

DDL = "k string, v int"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def log_of(spark, folder, rows):
    log = ChangeLog(spark, f"{folder}/log")
    log.append(frame(spark, rows))
    return log


ROWS = [("a", 1), ("a", 1), ("b", 2), ("c", None), (None, 5)]


def test_delete_keeps_duplicates_of_other_rows_and_null_outcomes(spark, folder):
    log = log_of(spark, folder, ROWS)
    log.delete("v = 2")
    assert rows_of(log.as_of()) == sorted([("a", 1), ("a", 1), ("c", None), (None, 5)], key=repr)
    log.delete("k = 'a'")
    assert rows_of(log.as_of()) == sorted([("c", None), (None, 5)], key=repr)
    assert rows_of(log.as_of(0)) == sorted(ROWS, key=repr)


def test_time_travel_history_and_missing_versions(spark, folder):
    log = log_of(spark, folder, ROWS)
    log.delete("k = 'a'")
    stamps = {row.version: row.committed_at for row in log.commits().collect()}
    assert log.version_at(stamps[1]) == 1
    assert log.as_of(timestamp=stamps[1] - timedelta(microseconds=1)).count() == len(ROWS)
    with pytest.raises(ValueError):
        log.version_at(stamps[0] - timedelta(seconds=1))
    with pytest.raises(ValueError):
        log.as_of(2)
    history = log.history().orderBy("version").drop("timestamp").collect()
    assert [tuple(row) for row in history] == [(0, "append", 5, 0), (1, "delete", 0, 2)]


def test_a_plain_table_is_read_without_a_shuffle(spark, folder):
    log = log_of(spark, folder, ROWS)
    log.append(frame(spark, [("d", 4)]))
    plan = log.as_of()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_filters_and_columns_reach_the_scan(spark, folder):
    log = log_of(spark, folder, ROWS)
    log.delete("k = 'b'")
    plan = log.as_of().where("v > 1").select("v")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThan(v,1)" in scan and "k:string" not in scan
    assert "_change_type" in scan.split("PartitionFilters")[1]


def test_restore_twice_and_across_compaction(spark, folder):
    log = log_of(spark, folder, ROWS)
    log.delete("k = 'a'")
    log.append(frame(spark, [("z", 9)]))
    for _ in range(2):
        log.restore(0)
        assert rows_of(log.as_of()) == sorted(ROWS, key=repr)
    log.compact()
    log.restore(2)
    assert rows_of(log.as_of()) == rows_of(log.as_of(2))
    assert rows_of(log.as_of(0)) == sorted(ROWS, key=repr)


def test_update_and_merge(spark, folder):
    log = log_of(spark, folder, ROWS)
    log.update("k = 'a'", {"v": F.col("v") + 10})
    assert Counter(rows_of(log.as_of()))[("a", 11)] == 2
    copies = sum(k == "a" for k, _ in ROWS)
    log.merge(frame(spark, [("a", 0), ("new", 1), (None, 6)]), ["k"], hot_keys=["a"])
    want = [("a", 0)] * copies + [("new", 1), (None, 6), ("b", 2), ("c", None), (None, 5)]
    assert rows_of(log.as_of()) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="repeats"):
        log.merge(frame(spark, [("a", 0), ("a", 1)]), ["k"])


def test_columns_are_added_and_types_kept(spark, folder):
    log = log_of(spark, folder, [("a", 1)])
    log.append(spark.createDataFrame([("b", "x")], "k string, tag string"))
    assert rows_of(log.as_of()) == [("a", 1, None), ("b", None, "x")]
    assert rows_of(log.as_of(0)) == [("a", 1)]
    with pytest.raises(ValueError, match="v is"):
        log.append(spark.createDataFrame([("b", "x")], "k string, v string"))
    with pytest.raises(ValueError, match="reserved"):
        log.append(spark.createDataFrame([(1,)], "_row_id long"))


def test_replayed_batches_add_nothing(spark, folder):
    log = ChangeLog(spark, f"{folder}/log")
    sink = log.batch_appender("stream")
    for batch in (0, 0, 1, 1, 0):
        sink(frame(spark, [("a", batch)]), batch)
    assert rows_of(log.as_of()) == [("a", 0), ("a", 1)]
    assert log.latest_version() == 1


def test_a_writer_that_died_before_its_commit_row_leaves_nothing(spark, folder):
    log = log_of(spark, folder, [("a", 1)])
    live = log._live(log._head())
    stray = live.withColumns({"_change_type": F.lit("delete"), "_commit_timestamp": F.current_timestamp()})
    stray.write.partitionBy("_change_type").parquet(f"{folder}/log/data/_commit_version=1")
    assert rows_of(log.as_of()) == [("a", 1)]
    log.append(frame(spark, [("b", 2)]))
    assert rows_of(log.as_of()) == [("a", 1), ("b", 2)]
    stray.write.partitionBy("_change_type").parquet(f"{folder}/log/data/_commit_version=2")
    log.compact()
    assert log.history().agg(F.sum("deleted")).first()[0] == 0
    assert log.changes().where("_change_type = 'delete'").isEmpty()
    log.restore(1)
    assert rows_of(log.as_of()) == [("a", 1), ("b", 2)]


def test_clones(spark, folder):
    log = log_of(spark, folder, ROWS)
    log.delete("k = 'a'")
    deep = log.clone(f"{folder}/copy", version=0)
    log.shallow_clone("shallow_copy", version=1)
    log.append(frame(spark, [("z", 9)]))
    assert rows_of(deep.as_of()) == sorted(ROWS, key=repr)
    assert rows_of(spark.table("shallow_copy")) == rows_of(log.as_of(1))
    deep.delete("true")
    assert deep.as_of().isEmpty() and log.as_of(0).count() == len(ROWS)


def test_changes_sum_up_to_the_table(spark, folder):
    log = log_of(spark, folder, ROWS)
    log.update("k = 'a'", {"v": F.lit(3)})
    log.delete("k = 'b'")
    total = Counter()
    for row in log.changes().collect():
        total[(row.k, row.v)] += 1 if row._change_type == "insert" else -1
    assert +total == Counter(rows_of(log.as_of())) and min(total.values()) >= 0
    assert log.changes(1, 1).count() == 4


def test_followers_see_each_commit_once(spark, folder):
    log = log_of(spark, folder, ROWS)
    seen = []

    def note(changes, batch_id):
        seen.extend((r.k, r._change_type, r._commit_version) for r in changes.collect())

    log.follow(note, f"{folder}/cp").awaitTermination()
    assert len(seen) == 5
    log.delete("k = 'b'")
    log.compact()
    for _ in range(2):
        log.follow(note, f"{folder}/cp").awaitTermination()
    assert seen[5:] == [("b", "delete", 1)]


def test_compaction_writes_few_files_and_keeps_rows(spark, folder):
    log = ChangeLog(spark, f"{folder}/log")
    for i in range(4):
        log.append(spark.range(50).selectExpr("cast(id AS string) AS k", f"{i} AS v").repartition(5))
    log.delete("k < '2'")
    before = rows_of(log.as_of())
    log.compact(cluster_by=["v"])
    assert rows_of(log.as_of()) == before
    assert len(log.as_of().inputFiles()) == 1
    log.compact(target_bytes=1000)
    assert rows_of(log.as_of()) == before and len(log.as_of().inputFiles()) > 1


def test_random_histories_match_a_multiset(spark, folder):
    rng = random.Random(3)
    log, model, versions = ChangeLog(spark, f"{folder}/log"), [], []

    def some():
        return [(rng.choice("abcd"), rng.randint(0, 3)) for _ in range(rng.randint(1, 6))]

    for step in range(14):
        kind = rng.choice(["append", "delete", "update", "merge", "restore", "compact"]) if step else "append"
        key = rng.choice("abcd")
        if kind == "append":
            rows = some()
            log.append(frame(spark, rows))
            model = model + rows
        elif kind == "delete":
            log.delete(f"k = '{key}' AND v > 0")
            model = [r for r in model if not (r[0] == key and r[1] > 0)]
        elif kind == "update":
            log.update(f"k = '{key}'", {"v": F.col("v") * 2})
            model = [(k, v * 2) if k == key else (k, v) for k, v in model]
        elif kind == "merge":
            rows = list(dict(some()).items())
            log.merge(frame(spark, rows), ["k"])
            model = [r for r in model if r[0] not in dict(rows)] + rows
        elif kind == "restore":
            back = rng.randrange(len(versions))
            log.restore(back)
            model = versions[back]
        else:
            log.compact()
        versions.append(model)
        assert rows_of(log.as_of()) == sorted(model, key=repr), (step, kind)
    for version in (0, 5, 9, 13):
        assert rows_of(log.as_of(version)) == sorted(versions[version], key=repr)


def test_a_new_checkpoint_is_a_new_writer(spark, folder):
    log = ChangeLog(spark, f"{folder}/log")
    frame(spark, [("a", 1), ("b", 2)]).write.parquet(f"{folder}/in")

    def run(checkpoint):
        stream = spark.readStream.schema(DDL).parquet(f"{folder}/in")
        writer = stream.writeStream.foreachBatch(log.batch_appender("feed"))
        writer = writer.option("checkpointLocation", f"{folder}/{checkpoint}").trigger(availableNow=True)
        writer.start().awaitTermination()

    for checkpoint in ("one", "one", "two"):
        run(checkpoint)
    assert log.as_of().count() == 4 and log.latest_version() == 1


def test_merge_updates_each_match_and_keeps_other_columns(spark, folder):
    log = ChangeLog(spark, f"{folder}/log")
    log.append(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "k string, v int, t string"))
    log.merge(spark.createDataFrame([("a", 9), ("n", 4)], "K string, v int"), ["k"])
    assert rows_of(log.as_of()) == [("a", 9, "x"), ("a", 9, "y"), ("b", 3, "z"), ("n", 4, None)]
    log.merge(spark.createDataFrame([("b", 7)], "k string, extra int"), ["k"])
    assert rows_of(log.as_of().where("k = 'b'")) == [("b", 3, "z", 7)]


def test_names_that_differ_in_case_are_one_column(spark, folder):
    log = ChangeLog(spark, f"{folder}/log")
    log.append(spark.createDataFrame([(1,)], "id long"))
    log.append(spark.createDataFrame([(2,)], "Id long"))
    assert rows_of(log.as_of()) == [(1,), (2,)] and log.as_of().columns == ["id"]
    with pytest.raises(ValueError, match="case only"):
        log.append(spark.createDataFrame([(1, 2)], "a long, A long"))


def test_untouched_versions_are_read_without_a_join(spark, folder):
    log = ChangeLog(spark, f"{folder}/log")
    for i in range(3):
        log.append(spark.range(i * 10, i * 10 + 10).withColumnRenamed("id", "v"))
    log.delete("v = 15")
    plan = log.as_of()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "Union" in plan
    assert sorted(r[0] for r in log.as_of().collect()) == [v for v in range(30) if v != 15]


def test_compaction_is_sized_by_live_rows(spark, folder):
    log = ChangeLog(spark, f"{folder}/log")
    log.append(spark.range(200_000).selectExpr("id", "cast(rand(1) AS string) AS t"))
    for i in range(4):
        log.update("true", {"t": F.concat("t", F.lit(str(i)))})
    one = log.as_of().write
    one.parquet(f"{folder}/one")
    size = sum(f.stat().st_size for f in __import__("pathlib").Path(f"{folder}/one").glob("*.parquet"))
    version = log.compact(target_bytes=size)
    assert len(list(__import__("pathlib").Path(f"{folder}/log/snapshots/_snapshot_version={version}").glob("*.parquet"))) <= 2

from __future__ import annotations

import json
import os
import time

import pytest
from conftest import rows_of
from pyspark.sql import types as T

from medallion.operators.changelog import ChangeLog
from medallion.sources import (
    SchemaLog,
    apply_hints,
    csv_batches,
    folder_bytes,
    has_files,
    infer_schema,
    json_lines,
    list_files,
    parse_json,
    query_in_place,
    read_csv_files,
    read_or_empty,
    sized_partitions,
    track_json_columns,
)
from medallion.sources.csv_folder import header_groups
from medallion.sources.json_lines import json_lines, json_stream, parse_json
from medallion.streaming import Flow, copy_into, run_flow

PEOPLE = T.StructType().add("id", "integer").add("name", "string").add("born", "date")


def write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)
    return path


def test_json_rows_are_typed_and_misfits_kept(spark, folder):
    lines = [
        '{"id": 1, "name": "a", "born": "2001-02-03"}',
        '{"id": "x", "name": "b"}',
        '{"id": 3, "name": null, "extra": {"k": [1]}}',
        '{"id": 4, "born": "soon", "extra": 7}',
        "not json",
        "",
        "[1, 2]",
    ]
    write(f"{folder}/in/a.json", "\n".join(lines))
    got = parse_json(json_lines(spark.read, f"{folder}/in"), PEOPLE).collect()
    by = {(row.id, row.name): row for row in got}
    assert len(got) == 6
    assert by[(1, "a")]._rescued_data is None and str(by[(1, "a")].born) == "2001-02-03"
    assert json.loads(by[(None, "b")]._rescued_data) == {"id": "x"}
    assert json.loads(by[(3, None)]._rescued_data) == {"extra": '{"k":[1]}'}
    assert json.loads(by[(4, None)]._rescued_data) == {"born": "soon", "extra": "7"}
    assert {row._rescued_data for row in got if row.id is None and row.name is None} == {"not json", "[1, 2]"}


def bronze(spark, database, folder, schema=PEOPLE, max_files=None):
    flow = Flow(f"{database}.bronze", lambda s: json_stream(s, f"{folder}/in", schema, max_files))
    run_flow(spark, flow, folder)
    return spark.table(flow.name)


def test_json_files_are_taken_once_across_runs(spark, database, folder):
    for i in range(3):
        write(f"{folder}/in/{i}.json", f'{{"id": {i}}}\n')
    assert bronze(spark, database, folder).count() == 3
    assert bronze(spark, database, folder).count() == 3
    write(f"{folder}/in/sub/3.json", '{"id": 3}\n')
    assert sorted(r.id for r in bronze(spark, database, folder).collect()) == [0, 1, 2, 3]


def test_throttle_limits_files_per_batch(spark, folder):
    for i in range(4):
        write(f"{folder}/in/{i}.json", f'{{"id": {i}}}\n')
    sizes = []
    stream = json_stream(spark, f"{folder}/in", PEOPLE, max_files=1)
    writer = stream.writeStream.foreachBatch(lambda df, i: sizes.append(df.count()))
    writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    assert sizes == [1, 1, 1, 1]


def test_schema_is_sampled_hinted_and_remembered(spark, folder):
    write(f"{folder}/in/0.json", '{"b": 1, "a": {"x": 1}}\n')
    write(f"{folder}/in/1.json", '{"c": "z"}\n')
    assert infer_schema(spark, f"{folder}/in").names == ["a", "b", "c"]
    assert infer_schema(spark, f"{folder}/in", sample_files=1).names == ["a", "b"]
    hinted = apply_hints(infer_schema(spark, f"{folder}/in", sample_files=1), "b INT, d FLOAT")
    assert [(f.name, f.dataType.simpleString()) for f in hinted][1:] == [("b", "int"), ("d", "float")]
    log = SchemaLog(spark, f"{folder}/schema")
    first = log.load_or_infer(f"{folder}/in", hints="b INT")
    write(f"{folder}/in/2.json", '{"e": 1}\n')
    assert log.load_or_infer(f"{folder}/in", hints="b INT") == first
    assert log.widen(["e", "b"]).names == ["a", "b", "c", "e"]
    assert SchemaLog(spark, f"{folder}/schema").load()["b"].dataType == T.IntegerType()


def test_missing_folder_leaves_no_schema_behind(spark, folder):
    log = SchemaLog(spark, f"{folder}/schema")
    assert log.load_or_infer(f"{folder}/absent").names == []
    write(f"{folder}/absent/0.json", '{"a": 1}\n')
    assert log.load_or_infer(f"{folder}/absent").names == ["a"]


def test_new_json_columns_join_the_table(spark, database, folder):
    log = SchemaLog(spark, f"{folder}/schema")
    write(f"{folder}/in/0.json", '{"id": 1}\n')
    log.load_or_infer(f"{folder}/in", hints="id INT")
    bronze(spark, database, folder, log.load())
    write(f"{folder}/in/1.json", '{"id": 2, "tier": "gold"}\n')
    wider = track_json_columns(spark, f"{folder}/in", log, f"{folder}/columns")
    assert wider.names == ["id", "tier"]
    got = bronze(spark, database, folder, wider).select("id", "tier", "_rescued_data")
    assert rows_of(got) == [(1, None, None), (2, "gold", None)]


SPEND = T.StructType().add("id", "integer").add("age", "integer").add("income", "float")


def test_csv_binds_by_name_when_headers_differ(spark, folder):
    paths = [
        write(f"{folder}/in/a.csv", "id,age,income\n1,20,10.5\n2,x,\n"),
        write(f"{folder}/in/b +%.csv", "income,channel,id,age\n7,web,3,30\n"),
        write(f"{folder}/in/c.csv", 'id,age,income\n4,40\n5,50,5,"odd, cell"\n'),
    ]
    listed = [row.path for row in list_files(spark, f"{folder}/in").orderBy("path").collect()]
    assert len(header_groups(spark, listed)) == 2
    got = {row.id: row for row in read_csv_files(spark, listed, SPEND).collect()}
    assert (got[1].age, got[1].income, got[1]._rescued_data) == (20, 10.5, None)
    assert (got[2].age, json.loads(got[2]._rescued_data)) == (None, {"age": "x"})
    assert (got[3].age, got[3].income) == (30, 7.0)
    assert json.loads(got[3]._rescued_data) == {"channel": "web"}
    assert (got[4].income, got[4]._rescued_data) == (None, None)
    assert json.loads(got[5]._rescued_data) == {"_corrupt_record": '5,50,5,"odd, cell"'}
    assert len(got) == 5 and len(paths) == 3


def test_headers_of_one_width_share_a_scan_and_bind_by_name(spark, folder):
    write(f"{folder}/in/a.csv", "id,age,income\n1,20,10\nid,age,income\n")
    write(f"{folder}/in/b +%.csv", "\n\nage,id,income\n30,2,20\n31,3,30,extra\n")
    write(f"{folder}/in/c.csv", 'age,"id",channel\nx,4,web\n')
    write(f"{folder}/in/empty.csv", "")
    listed = sorted(row.path for row in list_files(spark, f"{folder}/in").collect())
    rows = read_csv_files(spark, listed, SPEND)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Scan csv") == 1
    got = {row.id: row for row in rows.collect()}
    assert (got[1].age, got[1].income, got[1]._rescued_data) == (20, 10.0, None)
    assert (got[2].age, got[2].income, got[2]._rescued_data) == (30, 20.0, None)
    assert json.loads(got[3]._rescued_data) == {"_corrupt_record": "31,3,30,extra"}
    assert json.loads(got[4]._rescued_data) == {"age": "x", "channel": "web"}
    assert json.loads(got[None]._rescued_data) == {"id": "id", "age": "age", "income": "income"}
    assert read_csv_files(spark, listed[3:], SPEND).collect() == []


def test_headers_cost_one_buffer_a_file_and_no_job_fails(spark, folder):
    big = "".join(f"{i},{i % 90},{i}\n" for i in range(400_000))
    write(f"{folder}/in/a.csv", "id,age,income\n" + big)
    write(f"{folder}/in/b.csv", "age,income,id\n" + big)
    listed = sorted(row.path for row in list_files(spark, f"{folder}/in").collect())
    spark.sparkContext.setJobGroup("headers", "headers")
    assert len(header_groups(spark, listed)) == 2
    tracker, store = spark.sparkContext.statusTracker(), spark._jsc.sc().statusStore()
    time.sleep(1)
    stages = [i for job in tracker.getJobIdsForGroup("headers") for i in tracker.getJobInfo(job).stageIds]
    read = sum(store.lastStageAttempt(i).inputBytes() for i in stages)
    assert 0 < read < 0.1 * 2 * len(big)
    spark.sparkContext.setJobGroup("rows", "rows")
    assert read_csv_files(spark, listed, SPEND).count() == 800_000
    for group in ("headers", "rows"):
        jobs = [tracker.getJobInfo(job).status for job in tracker.getJobIdsForGroup(group)]
        assert jobs and set(jobs) == {"SUCCEEDED"}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_csv_copied_into_a_table_is_there_once(spark, folder, database):
    table = f"{database}.spend"
    write(f"{folder}/in/a.csv", "id,age,income\n1,20,10\n")
    write(f"{folder}/in/b.csv", "age,id\n30,2\nx,3\n")
    for _ in range(2):
        copy_into(spark, table, f"{folder}/in", "csv", SPEND, f"{folder}/cp")
    assert spark.table(table).columns == [*SPEND.names, "_rescued_data", "_load"]
    assert sorted(row.id for row in spark.table(table).collect()) == [1, 2, 3]
    # the commit of the batch is lost with the driver: the batch comes again and replaces what it wrote
    for name in ("0", ".0.crc"):
        os.remove(f"{folder}/cp/commits/{name}")
    write(f"{folder}/in/c.csv", "id,age,income\n4,40,30\n")
    copy_into(spark, table, f"{folder}/in", "csv", SPEND, f"{folder}/cp")
    assert sorted(row.id for row in spark.table(table).collect()) == [1, 2, 3, 4]
    copy_into(spark, table, f"{folder}/in", "csv", SPEND, f"{folder}/other")
    assert spark.table(table).count() == 8
    spark.sql(f"CREATE TABLE {database}.plain (id INT) USING parquet")
    with pytest.raises(ValueError, match="not partitioned"):
        copy_into(spark, f"{database}.plain", f"{folder}/in", "csv", SPEND, f"{folder}/third")


def test_csv_bulk_load_skips_loaded_files_and_survives_mixed_headers(spark, folder):
    write(f"{folder}/in/a.csv", "id,age,income\n1,20,10\n")
    write(f"{folder}/in/b.csv", "age,id,income\n30,2,20\n")
    log = ChangeLog(spark, f"{folder}/log")
    for _ in range(2):
        copy_into(spark, log, f"{folder}/in", "csv", SPEND, f"{folder}/cp")
    assert rows_of(log.as_of()) == [(1, 20, 10.0, None), (2, 30, 20.0, None)]
    write(f"{folder}/in/c.csv", "id,age,income\n3,40,30\n")
    copy_into(spark, log, f"{folder}/in", "csv", SPEND, f"{folder}/cp")
    assert log.as_of().count() == 3
    assert copy_into(spark, log, f"{folder}/absent", "csv", SPEND, f"{folder}/cp2") == 0


def test_folder_inventory(spark, folder):
    write(f"{folder}/in/a.txt", "12345")
    write(f"{folder}/in/sub/b.txt", "123")
    assert has_files(spark, f"{folder}/in") and not has_files(spark, f"{folder}/absent")
    assert folder_bytes(spark, f"{folder}/in") == 8 and folder_bytes(spark, f"{folder}/absent") == 0
    assert [sized_partitions(n, 10) for n in (0, 1, 10, 11)] == [1, 1, 1, 2]
    missing = read_or_empty(spark, lambda: spark.read.json(f"{folder}/absent"), PEOPLE)
    assert missing.schema == PEOPLE and missing.isEmpty()
    with pytest.raises(Exception):
        read_or_empty(spark, lambda: spark.table("no_such_table"), PEOPLE)


def test_query_in_place(spark, folder):
    write(f"{folder}/in/a.json", '{"id": 1}\n{"id": 2}\n')
    assert query_in_place(spark, f"{folder}/in").limit(1).count() == 1
    assert query_in_place(spark, f"{folder}/in").count() == 2


def test_csv_columns_join_the_table_even_in_a_mixed_batch(spark, folder):
    write(f"{folder}/in/a.csv", "id,age,income\n1,20,10\n")
    write(f"{folder}/in/b.csv", "channel,age,id,income\nweb,30,2,20\n")
    log, remembered = ChangeLog(spark, f"{folder}/log"), SchemaLog(spark, f"{folder}/schema")
    remembered.save(SPEND)

    def run():
        sink = log.batch_appender("spend")
        writer = csv_batches(spark, f"{folder}/in", remembered.load(), sink, evolve=remembered)
        writer = writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True)
        writer.start().awaitTermination()

    run()
    write(f"{folder}/in/c.csv", "id,region\n3,eu\n")
    run()
    assert remembered.load().names == ["id", "age", "income", "channel", "region"]
    got = {row.id: row for row in log.as_of().collect()}
    assert (got[1].channel, got[2].channel, got[3].channel) == (None, "web", None)
    assert (got[2].age, got[3].age, got[3].region) == (30, None, "eu")
    assert all(row._rescued_data is None for row in got.values())


def old(path: str, days: int = 30) -> None:
    then = time.time() - days * 86400
    os.utime(path, (then, then))


def test_lines_that_are_more_than_one_object_are_rescued_whole(spark, folder):
    lines = ['{"id":1,"name":"a"} trailing {"id":9}', '{"id":3,"id":4}', '{"id":5,"name":"b"}', '{"id":6},{"id":7}']
    write(f"{folder}/in/0.json", "\n".join(lines) + "\n")
    schema = T.StructType().add("id", "integer").add("name", "string")
    got = rows_of(parse_json(json_lines(spark.read, f"{folder}/in"), schema))
    assert got == sorted([(5, "b", None), *((None, None, lines[i]) for i in (0, 1, 3))], key=repr)


def test_files_of_any_age_are_read(spark, database, folder):
    write(f"{folder}/in/0.json", '{"id": 0}\n')
    write(f"{folder}/csv/0.csv", "id,age,income\n1,20,10\n")
    log, columns = ChangeLog(spark, f"{folder}/log"), SchemaLog(spark, f"{folder}/schema")

    def load() -> None:
        bronze(spark, database, folder)
        copy_into(spark, f"{database}.copied", f"{folder}/in", "json", T.StructType().add("id", "integer"), f"{folder}/cp")
        copy_into(spark, log, f"{folder}/csv", "csv", SPEND, f"{folder}/cp2")
        track_json_columns(spark, f"{folder}/in", columns, f"{folder}/cp3")

    load()
    write(f"{folder}/in/1.json", '{"id": 1, "late": 2}\n')
    write(f"{folder}/csv/1.csv", "id,age,income\n2,30,20\n")
    old(f"{folder}/in/1.json")
    old(f"{folder}/csv/1.csv")
    load()
    assert spark.table(f"{database}.bronze").count() == spark.table(f"{database}.copied").count() == log.as_of().count() == 2
    assert columns.load().names == ["id", "late"]


def test_schemas_that_grow_without_end_are_refused(spark, folder):
    write(f"{folder}/in/0.json", "".join(f'{{"key{i}": 1}}\n' for i in range(30)))
    with pytest.raises(Exception, match="more than 20 column names"):
        track_json_columns(spark, f"{folder}/in", SchemaLog(spark, f"{folder}/schema"), f"{folder}/cp", max_columns=20)


def test_unseen_columns_join_while_each_file_is_read_once(spark, folder):
    from medallion.operators import ChangeLog
    from medallion.sources import json_batches
    from medallion.streaming.control import finish

    def drop(name, *lines):
        os.makedirs(f"{folder}/in", exist_ok=True)
        with open(f"{folder}/in/{name}.json", "w") as file:
            file.write("\n".join(lines))

    log, rows = SchemaLog(spark, f"{folder}/schema"), ChangeLog(spark, f"{folder}/rows")
    log.save(T.StructType.fromDDL("id long"))

    def load():
        writer = json_batches(spark, f"{folder}/in", log, rows.batch_appender("rows"), max_files=1)
        return finish(writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start())

    drop("a", '{"id": 1}', '{"id": "x", "n": "one"}', "no json")
    assert [p["numInputRows"] for p in load()] == [3]
    drop("b", '{"id": 2, "b": {"c": [1]}}', '{"id": 3, "n": null}')
    drop("c", '{"id": 4}')
    assert [p["numInputRows"] for p in load()] == [2, 1] and not any(p["numInputRows"] for p in load())
    assert log.load().names == ["id", "n", "b"]
    assert rows_of(rows.as_of().select("id", "n", "b", "_rescued_data")) == sorted(
        [
            (1, None, None, None),
            (None, "one", None, '{"id":"x"}'),
            (None, None, None, "no json"),
            (2, None, '{"c":[1]}', None),
            (3, None, None, None),
            (4, None, None, None),
        ],
        key=repr,
    )

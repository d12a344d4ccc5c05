"""The retail pipeline in its three variants: overview, notebook and declarative.

They build "the same" gold table in different ways and the differences are kept:
key types, capitalised names, rescued data, join type and what the rules count.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.cleaning import clean_users, clean_users_declared
from medallion.operators.changelog import ChangeLog
from medallion.operators.joins import hot_shares, key_as, spread_join
from medallion.plans.landing import USER_COLUMNS, Landing
from medallion.session import scratch_dir
from medallion.sources.csv_folder import csv_batches
from medallion.sources.files import has_files
from medallion.sources.json_lines import RESCUED, json_stream
from medallion.sources.schema import SchemaLog
from medallion.streaming.bulk import copy_into
from medallion.streaming.control import finish
from medallion.streaming.flows import Flow, last_commit, new_rows, run_flow
from medallion.streaming.rules import Rule, batch_counts, keep_counts, kept_batches

# Type hints, rules and comments of the pipeline.
USERS_TEXT_ID = f"id STRING, {USER_COLUMNS}"
USERS_LONG_ID = f"id LONG, {USER_COLUMNS}"
SPEND_INT_HINTS = "age int, annual_income int, spending_core int"
SPEND_FLOAT_HINTS = "id int, age int, annual_income float, spending_core float"
BRONZE_RULES = [Rule("correct_schema", "_rescued_data IS NULL")]
ID_RULES = [Rule("valid_id", "id IS NOT NULL AND id > 0")]
GOLD_RULES = [
    Rule("valid_age", "age IS NOT NULL", "drop"),
    Rule("valid_income", "annual_income IS NOT NULL", "drop"),
    Rule("valid_score", "spending_core IS NOT NULL", "drop"),
]
BRONZE_COMMENT = "raw users from JSON files, taken in incrementally; unexpected fields are kept"
SILVER_COMMENT = "users cleaned and anonymised"
GOLD_COMMENT = "users with their spend, ready for analysis"
SEGMENT_COMMENT = "users with their segment"


@dataclass
class Workspace:
    """A database, its checkpoints and its change-log tables below one folder."""

    spark: SparkSession
    root: str
    database: str

    @staticmethod
    def create(spark: SparkSession, label: str) -> Workspace:
        root = scratch_dir(spark, label)
        database = "retail_" + root.rsplit("-", 1)[1]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/tables'")
        return Workspace(spark, root, database)

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def log(self, table: str) -> ChangeLog:
        return ChangeLog(self.spark, f"{self.root}/logs/{table}")


def create_bronze(spark: SparkSession, table: str, columns: str) -> None:
    """Bronze with declared columns. Parquet tables do not enforce NOT NULL; rules do."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {RESCUED} STRING) USING parquet")


# ---- bronze ------------------------------------------------------------------


def bronze_flow(name: str, folder: str, schema: T.StructType, max_files: int | None = None, rules=()) -> Flow:
    return Flow(
        name,
        lambda spark: json_stream(spark, folder, schema, max_files),
        list(rules),
        BRONZE_COMMENT,
    )


def load_spend(
    space: Workspace,
    folder: str,
    hints: str,
    table: str = "spend_silver",
    cast_id: bool = False,
    max_files: int = 1000,
    evolve: bool = False,
) -> ChangeLog:
    """Run-once CSV ingest into a table with history; columns are inferred, hints type some.

    ``cast_id`` casts the key after the read, as the notebook flow does: a key that is
    no number becomes NULL. A hinted key that is no number is rescued as well. With
    ``evolve`` columns that turn up later join the table.
    """
    spark, log = space.spark, space.log(table)
    if not has_files(spark, folder):
        return log
    remembered = SchemaLog(spark, f"{space.root}/schemas/{table}")
    schema = remembered.load_or_infer(folder, "csv", hints)
    append = log.batch_appender(table)

    def sink(rows: DataFrame, batch_id: int) -> None:
        append(rows.withColumn("id", key_as("id", "int")) if cast_id else rows, batch_id)

    writer = csv_batches(spark, folder, schema, sink, max_files, remembered if evolve else None)
    writer = writer.option("checkpointLocation", f"{space.root}/checkpoints/{table}")
    finish(writer.trigger(availableNow=True).start())
    return log


def load_checked_spend(space: Workspace, folder: str) -> ChangeLog:
    """The declarative spend table. The counters of its rules are stored by version, of all versions
    since the last one counted, so a run that ended before it counted leaves none out."""
    table = "spend_silver_dlt"
    spend = load_spend(space, folder, SPEND_FLOAT_HINTS, table)
    latest = spend.latest_version()
    counted = max(kept_batches(space.spark, space.root, table), default=-1)
    if latest > counted:
        rows = batch_counts(spend.changes(counted + 1, latest), table, latest, ID_RULES)
        keep_counts(space.spark, space.root, table, latest, rows)
    return spend


# ---- silver ------------------------------------------------------------------


def silver_flow(name: str, source: str, declared: bool, drop_rescued: bool = True) -> Flow:
    def build(spark: SparkSession) -> DataFrame:
        users = new_rows(spark, source)
        if declared:
            return clean_users_declared(users)
        return clean_users(users, capitalise=True, cast_id=False, drop_rescued=drop_rescued)

    return Flow(name, build, ID_RULES if declared else [], SILVER_COMMENT)


# ---- gold --------------------------------------------------------------------


def join_spend(users: DataFrame, spend: DataFrame, how: str, hot: dict | None = None) -> DataFrame:
    """Users with their spend on ``id``, ``inner`` or ``left``; duplicate spend ids fan out.

    A text ``id`` is matched by value and stays text; what is no number matches nothing.
    """
    if not isinstance(users.schema["id"].dataType, T.StringType):
        return spread_join(users, spend, ["id"], how, hot)
    dtype = spend.schema["id"].dataType.simpleString()
    keyed = users.withColumnRenamed("id", "_text_id").withColumn("id", key_as("_text_id", dtype))
    joined = spread_join(keyed, spend, ["id"], how, hot)
    others = [c for c in joined.columns if c not in ("id", "_text_id")]
    return joined.select(F.col("_text_id").alias("id"), *others)


def _hot_ids(spark: SparkSession, silver: str, spend: DataFrame, since: datetime | None) -> dict:
    """Ids that dominate the silver files written after ``since``; only ids are read.

    What is found only tells the join which keys to spread, so a file missed or
    counted twice changes no row.
    """
    users = spark.table(silver)
    if since is not None:
        users = users.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    key = users.select(key_as("id", spend.schema["id"].dataType.simpleString()).alias("id"))
    return hot_shares(key, "id")


def gold_flow(
    space: Workspace,
    name: str,
    silver: str,
    spend: ChangeLog,
    how: str,
    declared: bool,
    target: ChangeLog | None = None,
) -> Flow:
    flow = Flow(name, None, GOLD_RULES if declared else [], GOLD_COMMENT, target)

    def build(spark: SparkSession) -> DataFrame:
        users, rows = new_rows(spark, silver), spend.as_of()
        hot = _hot_ids(spark, silver, rows, last_commit(spark, flow, space.root))
        joined = join_spend(users, rows, how, hot)
        return joined if declared else joined.drop(RESCUED)

    flow.build = build
    return flow


# ---- segments ----------------------------------------------------------------


def segment_flow(name: str, gold: str, function: str) -> Flow:
    """New gold rows with the segment a registered SQL function gives them."""

    def build(spark: SparkSession) -> DataFrame:
        call = f"{function}(age, annual_income, spending_core)"
        return new_rows(spark, gold).select("*", F.expr(call).alias("segment"))

    return Flow(name, build, [], SEGMENT_COMMENT)


# ---- whole pipelines ---------------------------------------------------------


def notebook_pipeline(space: Workspace, source: Landing) -> ChangeLog:
    """Bronze, silver, spend and gold; each step is awaited before the next one starts."""
    spark = space.spark
    bronze, silver = space.name("user_bronze"), space.name("user_silver")
    schema = T.StructType.fromDDL(USERS_TEXT_ID)
    create_bronze(spark, bronze, USERS_TEXT_ID)
    run_flow(spark, bronze_flow(bronze, source.users, schema), space.root)
    run_flow(spark, silver_flow(silver, bronze, declared=False), space.root)
    spend = load_spend(space, source.spend, SPEND_INT_HINTS, cast_id=True)
    gold = space.log("user_gold")
    flow = gold_flow(space, space.name("user_gold"), silver, spend, "inner", False, gold)
    run_flow(spark, flow, space.root)
    return gold


def overview_pipeline(space: Workspace, source: Landing) -> ChangeLog:
    """Bulk-loaded bronze with a numeric id, capitalised silver, inner-joined gold."""
    spark = space.spark
    bronze, silver = space.name("user_bronze"), space.name("user_silver")
    schema = T.StructType.fromDDL(USERS_LONG_ID)
    create_bronze(spark, bronze, USERS_LONG_ID)
    copy_into(spark, bronze, source.users, "json", schema, f"{space.root}/checkpoints/user_bronze")
    run_flow(spark, silver_flow(silver, bronze, declared=False, drop_rescued=False), space.root)
    spend = load_spend(space, source.spend, SPEND_INT_HINTS, cast_id=True)
    gold = space.log("user_gold")
    flow = gold_flow(space, space.name("user_gold"), silver, spend, "inner", False, gold)
    run_flow(spark, flow, space.root)
    return gold


def declarative_pipeline(space: Workspace, source: Landing) -> str:
    """The pipeline with rules; returns gold's table name. The counters of the rules are stored below the
    workspace, see :func:`~medallion.streaming.rules.kept_metrics`.

    The list below is the graph: a flow reads only tables written above it.
    """
    spark = space.spark
    bronze, silver = space.name("users_bronze_dlt"), space.name("user_silver_dlt")
    remembered = SchemaLog(spark, f"{space.root}/schemas/users_bronze_dlt")
    remembered.save(T.StructType.fromDDL(USERS_TEXT_ID))
    run_flow(spark, bronze_flow(bronze, source.users, remembered.load(), rules=BRONZE_RULES), space.root)
    run_flow(spark, silver_flow(silver, bronze, declared=True), space.root)
    spend = load_checked_spend(space, source.spend)
    gold = space.name("user_gold_dlt")
    run_flow(spark, gold_flow(space, gold, silver, spend, "left", declared=True), space.root)
    return gold

"""Registered queries: every operator over whole test tables.

Each takes (spark, sf_dir) and returns a DataFrame. The users and spend folders are
derived from the test tables and written once per application; the streams over them
run every time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from medallion.functions.cleaning import (
    clean_users,
    clean_users_declared,
    file_of_row,
)
from medallion.operators import profiling, ranking, segmentation
from medallion.operators.changelog import ChangeLog
from medallion.operators.compaction import compact_folder
from medallion.operators.model_search import RunTable, search_classifier
from medallion.plans import retail
from medallion.plans.landing import (
    file_count,
    landing,
    spend_source,
    table,
    users_source,
    users_table,
)
from medallion.plans.retail import (
    SPEND_FLOAT_HINTS,
    SPEND_INT_HINTS,
    USERS_TEXT_ID,
    Workspace,
)
from medallion.session import literal_rows, scratch_dir
from medallion.sources.files import backdate, folder_bytes, list_files, query_in_place, read_or_empty
from medallion.sources.json_lines import RESCUED
from medallion.sources.schema import SchemaLog, json_batches
from medallion.streaming.bulk import LOAD, copy_into
from medallion.streaming.control import finish
from medallion.streaming.flows import append_to_table, run_flow
from medallion.streaming.rules import kept_metrics, kept_rows

Query = Callable[[SparkSession, str], DataFrame]

CUT_OFF = "creation_date < '2015-01-01'"
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# Centres on the 0..10 scale for the checks of nearest-centre scoring.
CENTRES = [[2.0, 2.0, 2.0], [7.0, 3.0, 4.0], [3.0, 7.0, 6.0], [7.0, 7.0, 8.0]]


def _zoneless(rows: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, which is how the test tables store them."""
    stamps = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in rows.schema
        if isinstance(f.dataType, T.TimestampType)
    }
    return rows.withColumns(stamps) if stamps else rows


# ---- sources -----------------------------------------------------------------


def bronze_json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, space = landing(spark, sf_dir), Workspace.create(spark, "bronze")
    name = space.name("user_bronze")
    retail.create_bronze(spark, name, USERS_TEXT_ID)
    half = -(-source.user_files // 2)
    schema = T.StructType.fromDDL(USERS_TEXT_ID)
    run_flow(spark, retail.bronze_flow(name, source.users, schema, half), space.root)
    return spark.table(name)


def late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of users into one folder; the files of the second carry the times of a month ago."""
    space = Workspace.create(spark, "late")
    folder, name = f"{space.root}/drop", space.name("user_bronze")
    files = file_count(spark, sf_dir, "customer", 4)
    users = users_source(spark, sf_dir)
    flow = retail.bronze_flow(name, folder, T.StructType.fromDDL(f"{USERS_TEXT_ID}, loyalty STRING"))
    seen: set[str] = set()
    for drop in (users.where("length(id) % 2 = 0"), users.where("length(id) % 2 = 1")):
        drop.repartition(files, "address").write.mode("append").json(folder)
        paths = {row.path for row in list_files(spark, folder).select("path").collect()}
        if seen:
            backdate(spark, sorted(paths - seen), days=30)
        seen = paths
        run_flow(spark, flow, space.root)
    return spark.table(name).drop(RESCUED)


def bronze_json_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops into one folder; only the second has the column ``loyalty``. Each file is read once."""
    space = Workspace.create(spark, "evolved")
    folder, bronze = f"{space.root}/drop", space.log("user_bronze")
    files = file_count(spark, sf_dir, "customer", 4)
    users = users_source(spark, sf_dir)
    log = SchemaLog(spark, f"{space.root}/schema")
    first = users.where("loyalty IS NULL").drop("loyalty")
    for drop in (first, users.where("loyalty IS NOT NULL")):
        drop.repartition(files, "address").write.mode("append").json(folder)
        log.load_or_infer(folder)
        writer = json_batches(spark, folder, log, bronze.batch_appender("user_bronze"))
        writer = writer.option("checkpointLocation", f"{space.root}/checkpoints/user_bronze")
        finish(writer.trigger(availableNow=True).start())
    return bronze.as_of().drop(RESCUED)


def copy_into_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, space = landing(spark, sf_dir), Workspace.create(spark, "copy")
    name = space.name("user_bronze")
    retail.create_bronze(spark, name, retail.USERS_LONG_ID)
    schema = T.StructType.fromDDL(retail.USERS_LONG_ID)
    for _ in range(2):
        copy_into(spark, name, source.users, "json", schema, f"{space.root}/checkpoints/copy")
    return spark.table(name)


def copy_csv_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files copied into a catalog table; the second load finds nothing new."""
    source, space = landing(spark, sf_dir), Workspace.create(spark, "copy-csv")
    name = space.name("spend_silver")
    schema = T.StructType.fromDDL("id INT, age INT, annual_income INT, spending_core INT")
    for _ in range(2):
        copy_into(spark, name, source.spend, "csv", schema, f"{space.root}/checkpoints/copy")
    return spark.table(name).drop(LOAD)


def json_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = query_in_place(spark, landing(spark, sf_dir).users)
    return raw.agg(
        F.count("*").alias("users"),
        F.count_distinct("id").alias("ids"),
        F.count("email").alias("emails"),
        F.count_if(F.col("loyalty") == "gold").alias("gold"),
    )


def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = landing(spark, sf_dir)
    parts = []
    for folder in (source.users, source.spend):
        files = list_files(spark, folder)
        parts.append(files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes")))
    absent = read_or_empty(
        spark, lambda: spark.read.json(f"{source.users}-absent"), T.StructType.fromDDL("id STRING")
    )
    parts.append(absent.agg(F.count("*").alias("files"), F.sum(F.length("id")).alias("bytes")))
    names = {"users": source.user_files, "spend": source.spend_files, "absent": 0}
    named = [
        part.select(
            F.lit(name).alias("folder"),
            F.coalesce(F.col("bytes") > 0, F.lit(False)).alias("has_bytes"),
            (F.col("files") == written).alias("all_files"),
        )
        for (name, written), part in zip(names.items(), parts)
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


def spend_csv_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.create(spark, "spend")
    log = retail.load_spend(space, landing(spark, sf_dir).spend, SPEND_INT_HINTS, cast_id=True)
    return log.as_of()


def spend_csv_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.create(spark, "spend")
    source = landing(spark, sf_dir)
    half = -(-source.spend_files // 2)
    log = retail.load_spend(space, source.spend, SPEND_FLOAT_HINTS, max_files=half)
    return log.as_of()


def spend_csv_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder with two headers: reordered columns and a column no one expects."""
    space = Workspace.create(spark, "drift")
    folder = f"{space.root}/drop"
    spend = spend_source(spark, sf_dir)
    files = file_count(spark, sf_dir, "customer", 2)
    plain, odd = spend.where("id % 3 <> 0"), spend.where("id % 3 = 0")
    moved = odd.select("spending_core", F.lit("web").alias("channel"), "annual_income", "id", "age")
    for part in (plain, moved):
        part.repartition(files, "id", "age").write.mode("append").option("header", True).csv(folder)
    space_schema = SchemaLog(spark, f"{space.root}/schemas/spend_silver")
    space_schema.save(T.StructType.fromDDL(SPEND_FLOAT_HINTS))
    return retail.load_spend(space, folder, SPEND_FLOAT_HINTS).as_of()


def spend_csv_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops into one folder; the column only the second has joins the table."""
    space = Workspace.create(spark, "spend")
    folder = f"{space.root}/drop"
    spend = spend_source(spark, sf_dir)
    files = file_count(spark, sf_dir, "customer", 2)
    later = spend.where("id % 3 = 0").withColumn("channel", F.lit("web"))
    for drop in (spend.where("id % 3 <> 0"), later):
        drop.repartition(files, "id", "age").write.mode("append").option("header", True).csv(folder)
        log = retail.load_spend(space, folder, SPEND_FLOAT_HINTS, evolve=True)
    return log.as_of()


# ---- silver ------------------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str, label: str) -> Workspace:
    space = Workspace.create(spark, label)
    schema = T.StructType.fromDDL(USERS_TEXT_ID)
    flow = retail.bronze_flow(space.name("user_bronze"), landing(spark, sf_dir).users, schema)
    run_flow(spark, flow, space.root)
    return space


def silver_notebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = _bronze(spark, sf_dir, "silver")
    name = space.name("user_silver")
    flow = retail.silver_flow(name, space.name("user_bronze"), declared=False)
    for _ in range(2):
        run_flow(spark, flow, space.root)
    return _zoneless(spark.table(name))


def silver_declarative(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = _bronze(spark, sf_dir, "silver")
    name = space.name("user_silver_dlt")
    run_flow(spark, retail.silver_flow(name, space.name("user_bronze"), declared=True), space.root)
    return _zoneless(spark.table(name))


def date_and_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _bronze(spark, sf_dir, "dates")
    users = spark.table(bronze.name("user_bronze"))
    return users.select(
        "id",
        F.try_to_date("creation_date", "MM-dd-yyyy HH:mm:ss").alias("created_on"),
        F.regexp_extract("email", r"\.([0-9]+)@", 1).alias("email_number"),
        F.regexp_extract("address", r"^([0-9]+) (\S+)", 2).alias("street_name"),
        F.endswith(file_of_row(), F.lit(".parquet")).alias("from_parquet"),
    )


def sample_rand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A draw for every customer: how many, and whether they look uniform."""
    draws = table(spark, sf_dir, "customer").select(F.rand(seed=42).alias("draw"))
    return draws.agg(
        F.count("*").alias("draws"),
        ((F.min("draw") >= 0) & (F.max("draw") < 1)).alias("in_range"),
        (F.abs(F.avg("draw") - 0.5) < 0.1).alias("mean_in_bounds"),
    )


# ---- gold --------------------------------------------------------------------


def gold_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.create(spark, "overview")
    return _zoneless(retail.overview_pipeline(space, landing(spark, sf_dir)).as_of())


def gold_notebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.create(spark, "notebook")
    return _zoneless(retail.notebook_pipeline(space, landing(spark, sf_dir)).as_of())


def gold_declarative(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.create(spark, "declarative")
    gold = retail.declarative_pipeline(space, landing(spark, sf_dir))
    return _zoneless(spark.table(gold))


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace.create(spark, "quality")
    retail.declarative_pipeline(space, landing(spark, sf_dir))
    totals = kept_metrics(spark, space.root).groupBy("flow", "rule")
    return totals.agg(*[F.sum(c).alias(c) for c in ("passed", "failed", "dropped")])


def top_postcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _bronze(spark, sf_dir, "postcodes")
    return ranking.top_groups(spark.table(bronze.name("user_bronze")), "postcode")


# ---- table changes -----------------------------------------------------------


def _gold_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner-joined gold rows in one batch plan, to start a change log from."""
    users = clean_users(users_table(spark, sf_dir).drop("loyalty"), capitalise=True, cast_id=False)
    spend = spend_source(spark, sf_dir).withColumn("id", F.col("id").cast("int"))
    return retail.join_spend(users, spend, "inner")


def _gold_log(spark: SparkSession, sf_dir: str, delete: bool = True) -> ChangeLog:
    """Version 0 holds gold, version 1 deletes the rows before the cut-off."""
    log = ChangeLog(spark, scratch_dir(spark, "gold"))
    log.append(_gold_source(spark, sf_dir))
    if delete:
        log.delete(CUT_OFF)
    return log


def gold_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(_gold_log(spark, sf_dir).as_of())


def gold_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(_gold_log(spark, sf_dir).as_of(version=0))


def gold_as_of_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _gold_log(spark, sf_dir)
    first = log.commits().where("version = 0").first().committed_at
    return _zoneless(log.as_of(timestamp=first))


def gold_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _gold_log(spark, sf_dir)
    log.restore(0)
    return _zoneless(log.as_of())


def gold_clone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deep and shallow clone of one version; rows of both, told apart by ``kind``."""
    log = _gold_log(spark, sf_dir)
    deep = log.clone(scratch_dir(spark, "clone"), version=0).as_of()
    shallow = log.shallow_clone("user_gold_clone", version=1)
    both = deep.withColumn("kind", F.lit("deep")).unionByName(
        shallow.withColumn("kind", F.lit("shallow"))
    )
    return _zoneless(both)


def gold_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _gold_log(spark, sf_dir)
    log.restore(0)
    return log.history().select("version", "operation", "inserted", "deleted")


def gold_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _gold_log(spark, sf_dir).changes(0, 1).drop("_commit_timestamp")
    return _zoneless(changes)


def gold_change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A follower copies the changes to a table of its own, one run per commit."""
    log = ChangeLog(spark, scratch_dir(spark, "gold"))
    copy = ChangeLog(spark, scratch_dir(spark, "feed"))
    names = {"_commit_version": "version", "_change_type": "change"}

    def deliver(changes: DataFrame, batch_id: int) -> None:
        rows = changes.drop("_commit_timestamp").withColumnsRenamed(names)
        copy.append(rows, "follower", batch_id)

    log.append(_gold_source(spark, sf_dir))
    log.follow(deliver, f"{copy.path}-checkpoint").awaitTermination()
    log.delete(CUT_OFF)
    log.follow(deliver, f"{copy.path}-checkpoint").awaitTermination()
    return _zoneless(copy.as_of())


def _update_set(gold: DataFrame) -> DataFrame:
    """One row per id divisible by seven, with a new score and no address; half of them once more under a new id."""
    touched = gold.where("try_cast(id AS int) % 7 = 0")
    newest = ranking.latest_by(touched, "id", "spending_core", "age")
    newest = newest.withColumn("spending_core", F.lit(100)).drop("address")
    unmatched = newest.where("try_cast(id AS int) % 2 = 0")
    return newest.unionByName(unmatched.withColumn("id", F.concat(F.lit("new-"), "id")))


def gold_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _gold_log(spark, sf_dir, delete=False)
    log.merge(_update_set(log.as_of()), ["id"])
    return _zoneless(log.as_of())


def gold_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with history, after a delete, as SQL sees it."""
    _gold_log(spark, sf_dir).as_view("user_gold_latest")
    return _zoneless(spark.sql("SELECT * FROM user_gold_latest"))


def gold_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _gold_log(spark, sf_dir, delete=False)
    log.update(CUT_OFF, {"city": F.lit("archived"), "spending_core": F.col("spending_core") + 1})
    return _zoneless(log.as_of())


def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete, compact, delete again: later reads start from the compacted rows."""
    log = _gold_log(spark, sf_dir)
    log.compact(cluster_by=["creation_date"])
    log.delete("postcode < '00010'")
    return _zoneless(log.as_of())


def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "compact")
    orders = table(spark, sf_dir, "orders").repartition(32, "o_orderkey")
    orders.write.parquet(f"{root}/small")
    return compact_folder(spark, f"{root}/small", f"{root}/sized", cluster_by=["o_orderdate"])


def pack_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small files to sized ones without a shuffle."""
    root = scratch_dir(spark, "pack")
    table(spark, sf_dir, "orders").repartition(32, "o_orderkey").write.parquet(f"{root}/small")
    return compact_folder(spark, f"{root}/small", f"{root}/sized")


def cluster_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items clustered by two columns at once; the rows that a filter on each of them finds."""
    root, source = scratch_dir(spark, "cluster"), f"{sf_dir}/lineitem.parquet"
    rows = compact_folder(
        spark, source, root, target_bytes=max(1, folder_bytes(spark, source) // 64), cluster_by=["l_shipdate", "l_partkey"]
    )
    few = F.col("l_partkey") <= 20
    early = F.col("l_shipdate") < F.lit("1992-03-01").cast("date")
    found = [
        rows.where(condition).select(F.lit(name).alias("filter"), "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
        for name, condition in (("few", few), ("early", early))
    ]
    return found[0].unionByName(found[1])


# ---- profiles and rankings ---------------------------------------------------


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of lineitem; sketches are judged against exact counts of the same rows."""
    rows = table(spark, sf_dir, "lineitem")
    return _profile_checked(rows).select(
        "column",
        "rows",
        "nulls",
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
        F.expr("try_cast(min AS double)").alias("min"),
        F.expr("try_cast(max AS double)").alias("max"),
        F.when(F.expr("try_cast(min AS double) IS NULL"), F.substring("min", 1, 10)).alias("min_text"),
        F.when(F.expr("try_cast(max AS double) IS NULL"), F.substring("max", 1, 10)).alias("max_text"),
        "distinct_close",
        "median_close",
    )


def _profile_checked(rows: DataFrame) -> DataFrame:
    """The profile, and whether the sketches are within 10 % of the distinct count and 5 % of the ranks of the median."""
    profile = profiling.table_profile(rows)
    numbers = [f.name for f in rows.schema if isinstance(f.dataType, T.NumericType)]
    medians = {r["column"]: r["quantiles"][1] for r in profile.where("quantiles IS NOT NULL").select("column", "quantiles").collect()}
    measures = []
    for name in rows.columns:
        below, least = F.lit(None).cast("double"), F.lit(None).cast("double")
        if name in numbers and name in medians:
            below, least = F.avg((F.col(name) <= medians[name]).cast("double")), F.avg((F.col(name) < medians[name]).cast("double"))
        measures += [F.count_distinct(name).alias(f"n_{name}"), below.alias(f"b_{name}"), least.alias(f"l_{name}")]
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"), F.col(f"b_{c}").alias("b"), F.col(f"l_{c}").alias("l"))
        for c in rows.columns
    ]
    exact = rows.agg(*measures).select(F.inline(F.array(*entries)))
    close = F.abs(F.col("approx_distinct") - F.col("n")) <= F.greatest(F.lit(1), 0.1 * F.col("n"))
    return profile.join(exact, "column").withColumns(
        {"distinct_close": close, "median_close": (F.col("b") >= 0.45) & (F.col("l") <= 0.55)}
    )


def landing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of the raw users, sketches included."""
    rows = query_in_place(spark, landing(spark, sf_dir).users)
    return _profile_checked(rows).select("column", "rows", "nulls", "min", "max", "distinct_close")


def frequent_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"]
    return profiling.frequent_values(table(spark, sf_dir, "lineitem"), columns, k=5)


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return ranking.latest_by(orders, "o_custkey", "o_orderdate", "o_orderkey")


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return ranking.latest_for(orders, F.col("o_orderstatus") == "F", "o_orderdate", "o_orderkey")


def pair_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = profiling.pair_regression(table(spark, sf_dir, "lineitem"), MEASURES)
    return lines.select("x", "y", *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "corr")])


def density_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.histograms(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])


def pair_density_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return profiling.pair_histograms(lines, ["l_quantity", "l_extendedprice", "l_tax"])


def density_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = profiling.density(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])
    return curve.select("column", "point", F.round("at", 6).alias("at"), F.round("density", 9).alias("density"))


def density_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    surface = profiling.pair_density(lines, ["l_quantity", "l_extendedprice"])
    return surface.withColumn("density", F.round("density", 12))


# ---- segmentation ------------------------------------------------------------


def _gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarative gold in one batch plan: left join, then the drop rules."""
    users = clean_users_declared(users_table(spark, sf_dir))
    spend = spend_source(spark, sf_dir).select(
        F.col("id").cast("int").alias("id"),
        "age",
        F.col("annual_income").cast("float").alias("annual_income"),
        F.col("spending_core").cast("float").alias("spending_core"),
    )
    return kept_rows(retail.join_spend(users, spend, "left"), retail.GOLD_RULES)


def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segmentation.scale(_gold_features(spark, sf_dir).select("id", *segmentation.FEATURES))
    return rows.select("id", *[F.round(c, 6).alias(c) for c in segmentation.FEATURES])


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _gold_features(spark, sf_dir).select("id", *segmentation.FEATURES)
    return segmentation.assign(segmentation.scale(features), segmentation.FEATURES, CENTRES)


def nearest_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {f"cluster_{i}": name for i, name in enumerate(segmentation.SEGMENTS)}
    label = segmentation.label_for(F.col("cluster"), names)
    return _assigned(spark, sf_dir).select(
        "id", "cluster", label.alias("segment"), F.round("distance", 6).alias("distance")
    )


def segment_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed centres as a vectorised function called in SQL."""
    features = _gold_features(spark, sf_dir).select("id", *segmentation.FEATURES)
    limits = segmentation.bounds(features, segmentation.FEATURES)
    names = {f"cluster_{i}": name for i, name in enumerate(segmentation.SEGMENTS)}
    segmentation.register_segments_vectorised(spark, "arrow_segment", limits, CENTRES, names)
    features.createOrReplaceTempView("arrow_features")
    return spark.sql(
        "SELECT id, arrow_segment(age, annual_income, spending_core) AS segment FROM arrow_features"
    )


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred rows, and how many of them the table has."""
    rows = table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    some = rows.select(*key, *MEASURES).limit(100)
    members = some.join(rows.select(*key).distinct(), key, "left_semi")
    return some.agg(F.count("*").alias("shown")).join(members.agg(F.count("*").alias("members")), F.lit(True))


def inertia(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = segmentation.inertia(_assigned(spark, sf_dir))
    return total.select(F.round("inertia", 3).alias("inertia"))


def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = segmentation.cluster_profile(_assigned(spark, sf_dir))
    return means.select("cluster", *[F.round(c, 6).alias(c) for c in segmentation.FEATURES])


def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.distinct_labels(_assigned(spark, sf_dir))


def elbow_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fit per k; inertia falls, but for what a local minimum costs, and agrees with the fit's own, which is from a step before."""
    runs = segmentation.elbow(_gold_features(spark, sf_dir))
    last = F.lag("inertia").over(Window.orderBy("k"))  # a row per k
    return runs.select(
        "k",
        F.coalesce(F.col("inertia") < 1.05 * last, F.col("inertia") > 0).alias("falls"),
        F.col("inertia").between(0.99 * F.col("reported"), (1 + 1e-9) * F.col("reported")).alias("agrees"),
    )


def latest_sweep_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = segmentation.elbow(_gold_features(spark, sf_dir))
    finished = (F.col("status") == "FINISHED") & (F.col("tag") == segmentation.RUN_TAG)
    newest = ranking.latest_for(runs, finished, "finished_at")
    return newest.select("status", "tag", F.col("k").between(2, 9).alias("k_in_range"), (F.col("inertia") > 0).alias("has_inertia"))


def segment_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load, register and score in SQL."""
    features = _gold_features(spark, sf_dir)
    path = scratch_dir(spark, "model")
    segmentation.fit_segments(features).save(path)
    model = segmentation.SegmentModel.load(path)
    model.register_sql(spark)
    model.check_input(features).createOrReplaceTempView("user_gold_features")
    scored = spark.sql(
        "SELECT id, age, annual_income, spending_core, "
        f"{segmentation.SQL_NAME}(age, annual_income, spending_core) AS segment FROM user_gold_features"
    )
    checked = _nearest(scored, model).withColumn("age", F.col("age").cast("int"))
    return checked.select("id", *segmentation.FEATURES, "nearest")


def _nearest(scored: DataFrame, model: segmentation.SegmentModel) -> DataFrame:
    """Whether each row's segment is that of the centre nearest to its scaled features, worked out anew."""
    scaler, means = model.pipeline.stages[1:]
    pairs = list(zip(segmentation.FEATURES, scaler.originalMin.toArray(), scaler.originalMax.toArray()))
    low, high = segmentation.SCALED_RANGE
    axes = [(F.col(c).cast("double") - float(a)) / (float(b) - float(a)) * (high - low) + low for c, a, b in pairs]
    choices = []
    for i, centre in enumerate(means.clusterCenters()):
        distance = sum(((x - float(v)) * (x - float(v)) for x, v in zip(axes, centre)), F.lit(0.0))
        choices.append(F.struct(distance.alias("d"), F.lit(model.labels[f"cluster_{i}"]).alias("label")))
    return scored.withColumn("nearest", F.col("segment") == F.array_min(F.array(*choices))["label"])


def segment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows scored as they arrive, by a SQL function with fixed centres."""
    space = Workspace.create(spark, "segments")
    gold = retail.declarative_pipeline(space, landing(spark, sf_dir))
    limits = segmentation.bounds(spark.table(gold), segmentation.FEATURES)
    names = {f"cluster_{i}": name for i, name in enumerate(segmentation.SEGMENTS)}
    function = "fixed_centre_segment"
    segmentation.register_segments(spark, function, limits, CENTRES, names)
    name = space.name("user_segmentation_dlt")
    run_flow(spark, retail.segment_flow(name, gold, function), space.root)
    return _zoneless(spark.table(name))


def labelled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _gold_features(spark, sf_dir)
    model = segmentation.fit_segments(features)
    return _nearest(segmentation.labelled_points(model, features), model).drop("segment")


def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the clusters that fixed centres make."""
    points = _assigned(spark, sf_dir).withColumn("weight", F.lit(1.0))
    known = points.select("cluster", "weight", F.array(*segmentation.FEATURES).cast("array<double>").alias("v"))
    score = segmentation.judged(known.select("cluster", "weight", array_to_vector("v").alias("features")))
    return literal_rows(spark, [(len(CENTRES), round(score, 6))], "k int, silhouette double")


def classify_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search a quality classifier once, then take its stored result."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    rows = table(spark, sf_dir, "labels").join(documents, "doc_id")
    runs = RunTable(ChangeLog(spark, scratch_dir(spark, "runs")))

    calls = []

    def search() -> DataFrame:
        calls.append(search_classifier(rows, "quality", ["n_chars"], ["lang", "source"]))
        return calls[-1]

    first = runs.get_or_search("quality", search).first()
    again = runs.get_or_search("quality", search)
    best = calls[0].agg(F.max("f1")).first()[0]
    return again.select(
        "name",
        F.col("family").isin("logistic_regression", "random_forest").alias("known_family"),
        (F.col("f1") == F.lit(str(best))).alias("is_best"),
        (F.lit(len(calls) == 1) & (F.col("best_trial_run_id") == first["best_trial_run_id"])).alias("reused"),
    )


def queries() -> dict[str, Query]:
    listed = [
        bronze_json_stream,
        late_files,
        bronze_json_evolved,
        copy_into_twice,
        copy_csv_twice,
        json_in_place,
        landing_inventory,
        spend_csv_int,
        spend_csv_float,
        spend_csv_drift,
        spend_csv_evolved,
        silver_notebook,
        silver_declarative,
        date_and_pattern,
        sample_rand,
        gold_overview,
        gold_notebook,
        gold_declarative,
        quality_metrics,
        top_postcodes,
        gold_delete,
        gold_as_of,
        gold_as_of_time,
        gold_restore,
        gold_clone,
        gold_history,
        gold_changes,
        gold_change_stream,
        gold_merge,
        gold_by_name,
        gold_update,
        compact_table,
        compact_files,
        pack_files,
        cluster_files,
        preview,
        table_profile,
        landing_profile,
        frequent_values,
        latest_orders,
        latest_run,
        pair_regression,
        density_bins,
        pair_density_bins,
        density_curve,
        density_surface,
        minmax_scale,
        nearest_centre,
        segment_arrow,
        inertia,
        cluster_profile,
        distinct_labels,
        elbow_sweep,
        latest_sweep_run,
        segment_kmeans,
        segment_stream,
        labelled_points,
        silhouette,
        classify_search,
    ]
    return {query.__name__: query for query in listed}

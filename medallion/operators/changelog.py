"""Tables with delete, update, merge, history, time travel, restore, clone and change feed.

Layout below one folder, all of it parquet:

* ``data/_commit_version=N/_change_type=insert|delete/``: the rows a commit added or removed;
* ``snapshots/_snapshot_version=N/``: the live rows at version N, written by ``compact``;
* ``commits/commit_id=N/``: one row per commit, written last.

Every inserted row gets an identity, (``_row_version``, ``_row_id``), and a delete
repeats the identity of the row it removes. The rows at a version are then the
inserts up to it, minus an anti join on the identities deleted up to it: duplicates
survive, no data column is compared, the join key is unique so no key is hot, and a
table nothing was ever deleted from is read without a shuffle. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.compaction import write_sized
from medallion.operators.joins import hot_shares, spread_join
from medallion.session import literal_rows, no_rows, scratch_dir
from medallion.sources.json_lines import throttled

VERSION = "_commit_version"
CHANGE = "_change_type"
TIMESTAMP = "_commit_timestamp"
IDENTITY = ["_row_version", "_row_id"]
META = [VERSION, CHANGE, TIMESTAMP, *IDENTITY]

COMMIT_ROW = (
    "version int, committed_at timestamp, operation string, has_deletes boolean, "
    "writer string, batch_id bigint, columns string"
)


def _columns(head: Row) -> T.StructType:
    return T.StructType.fromDDL(head.columns) if head.columns else T.StructType([])


class ChangeLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # ---- commits -------------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row per commit."""
        try:
            return self.spark.read.schema(COMMIT_ROW).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return literal_rows(self.spark, [], COMMIT_ROW)

    def _head(
        self, version: int | None = None, writer: str | None = None, batch_id: int | None = None
    ) -> Row:
        """What a read of ``version`` (default: the latest) has to know, in one small job.

        ``seen`` is the version that holds batch ``batch_id`` of ``writer``, if any.
        """
        latest = F.max("version").alias("latest")
        done = self.commits()
        if version is not None:
            done = done.where(F.col("version") <= version)
        return done.agg(
            F.coalesce(latest, F.lit(-1)).alias("version"),
            F.max_by("columns", "version").alias("columns"),
            F.coalesce(
                F.max(F.when(F.col("operation") == "compact", F.col("version"))), F.lit(-1)
            ).alias("snapshot"),
            F.coalesce(F.max(F.when(F.col("has_deletes"), F.col("version"))), F.lit(-1)).alias(
                "last_delete"
            ),
            F.max(
                F.when((F.col("writer") == writer) & (F.col("batch_id") == batch_id), F.col("version"))
            ).alias("seen"),
        ).first()

    def latest_version(self) -> int:
        """The last committed version, -1 for a table without commits."""
        return self._head().version

    def version_at(self, moment: datetime) -> int:
        """The last version committed at or before ``moment``."""
        done = self.commits().where(F.col("committed_at") <= F.lit(moment))
        found = done.agg(F.max("version")).first()[0]
        if found is None:
            raise ValueError(f"no version is as old as {moment}")
        return found

    def schema(self, version: int | None = None) -> T.StructType:
        """The data columns as of ``version``; columns are only ever added."""
        return _columns(self._head(version))

    def _as_known(self, rows: DataFrame, current: T.StructType) -> DataFrame:
        """``rows`` with column names spelled as the table has them, where Spark takes them for the same."""
        if self.spark.conf.get("spark.sql.caseSensitive") == "true":
            return rows
        known = {name.lower(): name for name in current.names}
        if len({name.lower() for name in rows.columns}) < len(rows.columns):
            raise ValueError(f"columns differ in case only: {rows.columns}")
        return rows.toDF(*[known.get(name.lower(), name) for name in rows.columns])

    def _widened(self, current: T.StructType, incoming: T.StructType) -> T.StructType:
        known = {field.name: field.dataType for field in current}
        for field in incoming:
            if field.name in META:
                raise ValueError(f"{field.name} is reserved")
            if known.get(field.name, field.dataType) != field.dataType:
                raise ValueError(f"{field.name} is {known[field.name]}, got {field.dataType}")
        extra = [T.StructField(f.name, f.dataType) for f in incoming if f.name not in known]
        return T.StructType([*current.fields, *extra])

    def _commit(
        self,
        version: int,
        operation: str,
        changes: DataFrame,
        columns: T.StructType,
        has_deletes: bool = False,
        writer: str | None = None,
        batch_id: int | None = None,
    ) -> int:
        """Write the changes, then the commit row that makes them visible.

        A writer that died in between left a folder no commit row names; the next
        commit takes the same version and overwrites it.
        """
        now = datetime.now(timezone.utc)
        fresh = F.col(CHANGE) == "insert"
        stamped = changes.withColumns(
            {
                TIMESTAMP: F.lit(now).cast("timestamp"),
                "_row_version": F.when(fresh, F.lit(version)).otherwise(F.col("_row_version")),
                "_row_id": F.when(fresh, F.monotonically_increasing_id()).otherwise(F.col("_row_id")),
            }
        )
        rows = stamped.write.mode("overwrite").option("partitionOverwriteMode", "static")
        rows.partitionBy(CHANGE).parquet(f"{self.path}/data/{VERSION}={version}")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        row = (version, now, operation, has_deletes, writer, batch_id, ddl)
        commit = literal_rows(self.spark, [row], COMMIT_ROW)
        commit.write.mode("overwrite").parquet(f"{self.path}/commits/commit_id={version}")
        return version

    # ---- reads ---------------------------------------------------------------

    def _log(self, columns: T.StructType, after: int, upto: int) -> DataFrame:
        """Log rows of versions ``after`` < v <= ``upto``; both bounds prune folders."""
        fields = [
            *columns.fields,
            T.StructField(TIMESTAMP, T.TimestampType()),
            T.StructField("_row_version", T.IntegerType()),
            T.StructField("_row_id", T.LongType()),
            T.StructField(VERSION, T.IntegerType()),
            T.StructField(CHANGE, T.StringType()),
        ]
        schema = T.StructType(fields)
        try:
            log = self.spark.read.schema(schema).parquet(f"{self.path}/data")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return no_rows(self.spark, schema)
        return log.where((F.col(VERSION) > after) & (F.col(VERSION) <= upto))

    def _at(self, version: int | None = None) -> Row:
        head = self._head(version)
        if version is not None and head.version != version:
            raise ValueError(f"there is no version {version}, the last one is {head.version}")
        return head

    def _live(self, head: Row) -> DataFrame:
        """Data columns and identity of the rows live at the version of ``head``."""
        columns = _columns(head)
        wanted = [*columns.names, *IDENTITY]
        log = self._log(columns, head.snapshot, head.version)
        rows = log.where(F.col(CHANGE) == "insert").select(*wanted)
        if head.snapshot >= 0:
            kept = T.StructType([field for field in log.schema if field.name in wanted])
            folder = f"{self.path}/snapshots/_snapshot_version={head.snapshot}"
            rows = self.spark.read.schema(kept).parquet(folder).select(*wanted).unionByName(rows)
        if head.last_delete <= head.snapshot:
            return rows
        gone = log.where(F.col(CHANGE) == "delete").select(*IDENTITY)
        # rows of versions that no delete touched need no join; a version per commit, so the list is short
        touched = [r[0] for r in gone.select("_row_version").distinct().collect()]
        hit = F.col("_row_version").isin(touched)
        checked = rows.where(hit).join(gone, IDENTITY, "left_anti").select(*wanted)
        return rows.where(~hit).unionByName(checked)

    def as_of(self, version: int | None = None, timestamp: datetime | None = None) -> DataFrame:
        """The rows at a version or at a point in time; the latest rows by default."""
        if timestamp is not None:
            version = self.version_at(timestamp)
        head = self._at(version)
        return self._live(head).select(*_columns(head).names)

    def history(self) -> DataFrame:
        """Per version: when, which operation, rows inserted and deleted."""
        log = self._log(T.StructType([]), -1, self.latest_version())
        counts = log.groupBy(VERSION).pivot(CHANGE, ["insert", "delete"]).count()
        done = self.commits().select(
            "version", F.col("committed_at").alias("timestamp"), "operation"
        )
        joined = done.join(counts, done["version"] == counts[VERSION], "left")
        return joined.select(
            "version",
            "timestamp",
            "operation",
            F.coalesce("insert", F.lit(0)).cast("bigint").alias("inserted"),
            F.coalesce("delete", F.lit(0)).cast("bigint").alias("deleted"),
        )

    def changes(self, first: int = 0, last: int | None = None) -> DataFrame:
        """Rows inserted and deleted by versions ``first``..``last``, both included."""
        head = self._at(last)
        columns = _columns(head)
        log = self._log(columns, first - 1, head.version)
        return log.select(*columns.names, VERSION, TIMESTAMP, CHANGE)

    def follow(self, handler: Callable[[DataFrame, int], None], checkpoint: str):
        """A run-once stream of committed changes: ``handler(changes, batch_id)``."""

        def deliver(batch: DataFrame, batch_id: int) -> None:
            span = batch.agg(F.min("version"), F.max("version")).first()
            if span[0] is not None:
                handler(self.changes(span[0], span[1]), batch_id)

        commits = throttled(self.spark.readStream).schema(COMMIT_ROW).parquet(f"{self.path}/commits")
        writer = commits.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()

    # ---- writes --------------------------------------------------------------

    def _inserts(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                CHANGE: F.lit("insert"),
                "_row_version": F.lit(None).cast("int"),
                "_row_id": F.lit(None).cast("bigint"),
            }
        )

    def append(
        self,
        rows: DataFrame,
        writer: str | None = None,
        batch_id: int | None = None,
        operation: str = "append",
    ) -> int:
        """Add rows; unseen columns join the schema.

        With ``writer`` and ``batch_id`` a batch that was committed before is left
        out, so a replayed micro-batch adds nothing.
        """
        head = self._head(writer=writer, batch_id=batch_id)
        if head.seen is not None:
            return head.seen
        rows = self._as_known(rows, _columns(head))
        columns = self._widened(_columns(head), rows.schema)
        return self._commit(
            head.version + 1, operation, self._inserts(rows), columns, writer=writer, batch_id=batch_id
        )

    def batch_appender(self, writer: str) -> Callable[[DataFrame, int], None]:
        """``append`` in the shape ``foreachBatch`` wants, exactly once per batch.

        Batch ids start anew with a new checkpoint, and so does the query id that is
        stored in it; together they name a batch.
        """

        def sink(rows: DataFrame, batch_id: int) -> None:
            query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            name = f"{writer}:{query}" if query else writer
            self.append(rows, name, batch_id, "stream append")

        return sink

    def delete(self, condition: str | Column) -> int:
        """Remove the rows that satisfy ``condition``; where it is NULL the row stays."""
        head = self._head()
        rows = self._live(head).where(condition).withColumn(CHANGE, F.lit("delete"))
        return self._commit(head.version + 1, "delete", rows, _columns(head), has_deletes=True)

    def update(self, condition: str | Column, assignments: dict[str, Column]) -> int:
        """Assign columns in the rows that satisfy ``condition``, in one commit."""
        head = self._head()
        columns = _columns(head)
        old = self._live(head).where(condition)
        kinds = F.explode(F.array(F.lit("delete"), F.lit("insert")))
        assigned = old.withColumns(
            {f"_new_{name}": value.cast(columns[name].dataType) for name, value in assignments.items()}
        )
        both = assigned.withColumn(CHANGE, kinds)
        picked = {
            name: F.when(F.col(CHANGE) == "insert", F.col(f"_new_{name}")).otherwise(F.col(name))
            for name in assignments
        }
        both = both.withColumns(picked).select(*columns.names, *IDENTITY, CHANGE)
        return self._commit(head.version + 1, "update", both, columns, has_deletes=True)

    def merge(self, source: DataFrame, keys: list[str], hot_keys: dict | list | None = None) -> int:
        """Upsert: every row whose key is in ``source`` takes the columns ``source`` has and keeps its
        others; the rest of ``source`` is added.

        A key may occur once in ``source``; NULL keys match nothing and are added. ``source`` is
        computed once, into the scratch folder. Without ``hot_keys`` they are looked for.
        """
        head = self._head()
        source = self._as_known(source, _columns(head))
        columns = self._widened(_columns(head), source.schema)
        path = scratch_dir(self.spark, "merge")
        source.write.parquet(path)
        source = self.spark.read.schema(source.schema).parquet(path)
        named = source.where(" AND ".join(f"`{key}` IS NOT NULL" for key in keys))
        if not named.groupBy(*keys).count().where("count > 1").isEmpty():
            raise ValueError(f"the merge source repeats a key of {keys}")
        live = self._live(head)
        hot = hot_shares(live, keys[0]) if hot_keys is None else hot_keys
        given = {name: f"_new_{name}" for name in source.columns if name not in keys}
        matched = spread_join(
            live, named.withColumnsRenamed(given), keys, "inner", hot, deal=F.xxhash64(*IDENTITY)
        )
        both = matched.withColumn(CHANGE, F.explode(F.array(F.lit("delete"), F.lit("insert"))))
        fresh = F.col(CHANGE) == "insert"

        def value(field: T.StructField) -> Column:
            old = F.col(f"`{field.name}`") if field.name in live.columns else F.lit(None).cast(field.dataType)
            new = F.col(f"`{given[field.name]}`") if field.name in given else old
            return F.when(fresh, new).otherwise(old).alias(field.name)

        changed = both.select(*map(value, columns), *IDENTITY, CHANGE)
        unmatched = spread_join(source, live.select(*keys).distinct(), keys, "left_anti")
        changes = changed.unionByName(self._inserts(unmatched), allowMissingColumns=True)
        return self._commit(head.version + 1, "merge", changes, columns, has_deletes=True)

    def restore(self, version: int) -> int:
        """Make the rows of ``version`` current again; reads only the log after it."""
        version, head = self._at(version).version, self._head()
        columns = _columns(head)
        log = self._log(columns, version, head.version)
        removed = log.where(F.col(CHANGE) == "delete")
        added = log.where(F.col(CHANGE) == "insert")
        undo_delete = self._inserts(removed.where(F.col("_row_version") <= version).select(*columns.names))
        undo_insert = added.join(removed.select(*IDENTITY), IDENTITY, "left_anti")
        undo_insert = undo_insert.select(*columns.names, *IDENTITY, F.lit("delete").alias(CHANGE))
        both = undo_delete.unionByName(undo_insert)
        return self._commit(head.version + 1, "restore", both, columns, has_deletes=True)

    def clone(self, path: str, version: int | None = None) -> ChangeLog:
        """Deep clone: a new table holding the rows of ``version``."""
        copy = ChangeLog(self.spark, path)
        copy.append(self.as_of(version), operation="clone")
        return copy

    def as_view(self, name: str) -> DataFrame:
        """The latest rows under a name of SQL; call it again after a commit."""
        return self.shallow_clone(name)

    def shallow_clone(self, view: str, version: int | None = None) -> DataFrame:
        """Shallow clone: a view over the rows of ``version``, no data copied."""
        rows = self.as_of(version)
        rows.createOrReplaceTempView(view)
        return rows

    def compact(self, target_bytes: int | None = None, cluster_by: list[str] | None = None) -> int:
        """Write the live rows as few well-sized files; later reads start from them.

        Rows keep their identity, and older versions stay readable.
        """
        head = self._head()
        rows = self._live(head)
        logged = self._log(T.StructType([]), -1, head.version)
        share = rows.select(*IDENTITY).count() / max(1, logged.count())
        write_sized(
            rows,
            f"{self.path}/snapshots/_snapshot_version={head.version + 1}",
            source=f"{self.path}/data",
            share=share,
            target_bytes=target_bytes,
            cluster_by=cluster_by,
            deal_by=IDENTITY,
        )
        nothing = self._inserts(no_rows(self.spark, _columns(head)))
        return self._commit(head.version + 1, "compact", nothing, _columns(head))

"""Session settings, the shared scratch folder and small literal tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str, master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings every job here assumes; ``conf`` uses ``_`` for ``.``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), str(value))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the cluster shares for checkpoints.

    Nothing is created here; the writers create what they need. A machine-local
    folder is used only by a local session that names no checkpoint folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="medallion-")
    return f"{base.rstrip('/')}/medallion/{label}-{uuid.uuid4().hex[:12]}"


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(0).select(*nothing)


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A handful of rows as literals of the plan, so that no Python worker has to start."""
    schema = T.StructType.fromDDL(ddl)
    if not rows:
        return no_rows(spark, schema)
    structs = [
        F.struct(*[F.lit(cell).cast(field.dataType).alias(field.name) for field, cell in zip(schema, row)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))

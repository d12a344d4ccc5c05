"""Tables written to the shared folder, and slices of Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
import os
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.session import scratch_dir

#: Where the package is; workers look there too. A cluster has it at that place, or gets it by --py-files.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Bytes of text that one numpy step works on; a longer text makes a slice of its own.
SLICE_BYTES = 4 << 20


#: Whether a query's shuffle files go when it ends, not when the driver next collects garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, cleaned: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage and survives lost executors.

    An aggregate that is joined back on its own key is stored first: read again, neither side of the join is tied
    to the aggregate's partitions, so that adaptive execution can split a hot key. ``cleaned`` deletes the shuffle
    files of the writing job when it is done.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    before = spark.conf.get(CLEANED, None)
    if cleaned:
        spark.conf.set(CLEANED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if cleaned:
            spark.conf.unset(CLEANED) if before is None else spark.conf.set(CLEANED, before)
    found = spark.read.schema(df.schema).parquet(path)
    found.scratch = path
    return found


def release(found: DataFrame) -> None:
    """Delete the table that :func:`stored` wrote, once all that read it is stored itself."""
    spark = found.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(found.scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` as struct ``doc`` beside a row number that stays, as they are written to the shared folder."""
    row, doc = F.monotonically_increasing_id().alias("row"), F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    return stored(docs.select(row, doc), "numbered")


def sampled(rows: DataFrame, key: str, size: int) -> DataFrame:
    """About ``size`` rows, picked by a hash of ``key``; all if there are no more, and twice ``size`` at most."""
    share = size / max(size, rows.count())
    return rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 31)) < int(share * (1 << 31))).limit(2 * size)


#: What a Python worker keeps from task to task: owner, key and value of one memory.
_memory: list[tuple[str, object, object]] = []


def remembered(owner: str, key: object, make: Callable[[], object]) -> object:
    """The memory of ``owner`` for ``key``; a worker holds one, the one before it is let go."""
    if not _memory or _memory[0][:2] != (owner, key):
        _memory.clear()
        _memory.append((owner, key, make()))
    return _memory[0][2]


def tidy(owner: str | None = None) -> None:
    """Let go of a memory that is not ``owner``'s, and give freed blocks back to the system."""
    if _memory and _memory[0][0] != owner:
        _memory.clear()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def mapped(df: DataFrame, function: Callable, schema: str | T.StructType, owner: str | None = None) -> DataFrame:
    """``mapInArrow`` by workers that can import this package; between tasks they keep the memory of ``owner`` alone."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, ROOT]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(owner)
        yield from function(batches)
        tidy(owner)

    return df.mapInArrow(task, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def binary(column: pa.Array) -> pa.Array:
    """Texts as bytes, null as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``SLICE_BYTES`` of ``column``, every row whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        numbers = (np.cumsum(sizes, dtype=np.int64) - sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)

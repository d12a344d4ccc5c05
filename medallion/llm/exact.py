"""Exact dedup on an extendible-hash index kept in shared files.

Keys are 64-bit hashes of the normalised text, spread over buckets by their leading bits. The
directory starts with one entry and doubles while a bucket holds more than ``capacity`` keys;
only overfull buckets split, the others are shared by several entries. Owner tasks hold ranges
of directory entries, so each key range has one owner. An owner reads its rows in key order,
keeps a chain of the different texts of a key and compares bytes, and writes its buckets as
Parquet; those files are the index. Copies within a task are left out before the shuffle, so a
text that fills a third of the table reaches its owner once per task.

* null text: counts as the empty text, and empty texts equal each other
* null doc_id: stays only if no equal text has an id
* rows that repeat an id and text: one of them is kept, all count in group_size
* keys that collide: a chain in the bucket, told apart by bytes, at any ``key_bits``
* empty table: an empty index and no rows
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import binary, mapped, stored

#: Bytes of texts that a task remembers to leave out copies before the shuffle.
SEEN_BYTES = 64 << 20


def directory(cells: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """First cell of the bucket of each directory entry, and the bucket's local depth.

    ``cells`` counts keys by their leading bits, finer than the directory can get.
    """
    finest = len(cells).bit_length() - 1
    local, depth = np.zeros(1, dtype=np.int64), 0
    while depth < finest:
        held = cells.reshape(1 << depth, -1).sum(axis=1)
        overfull = (local == depth) & (held > capacity)
        if not overfull.any():
            break
        depth += 1
        local = np.repeat(np.where(overfull, depth, local), 2)
    entry = np.arange(1 << depth)
    return (entry >> (depth - local) << (depth - local)) << (finest - depth), local


def keyed(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """A narrow row per document, written to the shared folder: row number, doc_id, key and SHA-256."""
    shift = 64 - key_bits
    kind = docs.schema["doc_id"].dataType.simpleString()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [t.lower() for t in binary(batch.column("text")).to_pylist()]
            key = np.array([xxhash.xxh64_intdigest(t) >> shift << shift for t in texts], dtype=np.uint64)
            sha = pa.array([hashlib.sha256(t).digest() for t in texts], type=pa.binary())
            rows = pa.array(np.arange(row, row + len(texts)))
            row += len(texts)
            yield pa.RecordBatch.from_arrays(
                [rows, batch.column("doc_id"), pa.array(key.view(np.int64)), sha], ["row", "doc_id", "key", "sha"]
            )

    narrow = docs.select("doc_id", "text").transform(mapped, keys, f"row long, doc_id {kind}, key long, sha binary")
    return stored(narrow, "exact-keys")


def build_index(
    docs: DataFrame, keys: DataFrame, capacity: int = 2048, max_depth: int = 18, owners: int | None = None, key_bits: int = 64
) -> DataFrame:
    """The index: bucket, local depth, key, place in the key's chain, SHA-256 and bytes of each different text.

    The directory has at most 2 ** ``max_depth`` entries; a bucket of that depth may go over its capacity.
    """
    spark = docs.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cell = F.shiftrightunsigned("key", 64 - max_depth)
    cells = np.zeros(1 << max_depth, dtype=np.int64)
    counted = keys.select("key").distinct().groupBy(cell.alias("cell")).count().toArrow()  # 2 ** max_depth rows at most
    cells[counted["cell"].to_numpy()] = counted["count"].to_numpy()
    buckets, depths = directory(cells, capacity)
    wide = len(cells) // len(buckets)
    held = np.bincount(buckets // wide, cells.reshape(len(buckets), -1).sum(axis=1), len(buckets))
    owner = np.minimum(owners - 1, (np.cumsum(held) - held) * owners // max(1, held.sum())).astype(np.int32)[buckets // wide]
    bits, shift = (len(buckets) - 1).bit_length(), 64 - key_bits

    def first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = {}, 0
        for batch in batches:
            out = []
            for text in binary(batch.column("text")).to_pylist():
                text = text.lower()
                key = xxhash.xxh64_intdigest(text) >> shift << shift
                chain = seen.setdefault(key, [])
                if text not in chain:
                    chain.append(text)
                    size += len(text) + 200
                    entry = key >> 64 - bits if bits else 0
                    out.append((int(owner[entry]), int(buckets[entry]), int(depths[entry]), key - (key >> 63 << 64), text))
                if size > SEEN_BYTES:
                    seen, size = {}, 0
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, sent)], schema=sent)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chain = None, []
        for batch in batches:
            out = []
            for bucket, depth, key, text in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                if key != now:
                    now, chain = key, []
                if text not in chain:
                    chain.append(text)
                    out.append((bucket, depth, key, len(chain) - 1, hashlib.sha256(text).digest(), len(text)))
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, kept)], schema=kept)

    sent = pa.schema([("owner", pa.int32()), ("bucket", pa.int64()), ("depth", pa.int64()), ("key", pa.int64()), ("text", pa.binary())])
    kept = pa.schema([*list(sent)[1:4], ("link", pa.int64()), ("sha", pa.binary()), ("bytes", pa.int64())])
    return stored(
        docs.select("text")
        .transform(mapped, first_of_task, "owner int, bucket long, depth long, key long, text binary")
        .repartitionById(owners, "owner")
        .sortWithinPartitions("key")
        .transform(mapped, chained, "bucket long, depth long, key long, link long, sha binary, bytes long"),
        "exact-index",
    )


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """doc_id, keep_id (the largest id of equal texts), group_size, kept and text_sha256 of every row; bucket and link
    are its place in the index."""
    keys = keyed(docs, options.get("key_bits", 64))
    index = build_index(docs, keys, **options)
    groups = keys.groupBy("key", "sha").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    entries = stored(index.select("key", "sha", "bucket", "link").join(groups, ["key", "sha"]), "exact-groups")
    return keys.join(entries, ["key", "sha"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "bucket",
        "link",
    )

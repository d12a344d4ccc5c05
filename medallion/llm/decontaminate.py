"""Benchmark decontamination by winnowing.

Of every window of ``span - k + 1`` hashes of ``k`` words, the smallest (the last of equals) is kept
as a fingerprint, so texts that share ``span`` words share a fingerprint at the same place of it.
Fingerprints of documents and of benchmark items are joined; a hit is extended word by word over
what surrounds it on both sides, and counts where ``span`` words agree. An item shorter than
``span`` is one window of its own length, and documents are probed with all grams of those lengths.

Documents send only fingerprints that a bitmap of the items' fingerprints lets through (at most
2 ** BITS bits; it lets through too many when there are more items, never too few).

* null or empty text, or one without words: n_words 0, not contaminated; such items never occur
* null item_id: its words count as hit, the item is in no list; several rows of an item_id: one item
* rows that repeat a doc_id: each judged by itself
* empty tables: no rows, or nothing contaminated
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medallion.llm.store import mapped, numbered, slices, stored
from medallion.llm.words import LETTERED, U64, Words, grams, words_of

#: Size of the bitmap, as a power of two.
BITS = 24
#: Fill of words outside a text; the two sides never agree there.
OUTSIDE_DOC, OUTSIDE_ITEM = U64(1), U64(2)


def winnowed(hashes: np.ndarray, ends: np.ndarray, span: int, k: int) -> np.ndarray:
    """Whether each word of concatenated texts starts a fingerprint; ``ends`` has the end of its text."""
    chosen = np.zeros(len(hashes), dtype=bool)
    width = span - k + 1
    windows = len(hashes) - span + 1
    if windows <= 0:
        return chosen
    found = grams(hashes, k)
    least, place = found[:windows].copy(), np.arange(windows)
    for j in range(1, width):
        smaller = found[j : j + windows] <= least
        least[smaller] = found[j : j + windows][smaller]
        place[smaller] = np.flatnonzero(smaller) + j
    whole = np.arange(windows) + span <= ends[:windows]
    chosen[place[whole]] = True
    return chosen


def _probes(words: Words, span: int, k: int, lengths: list[int], whole_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, hash and reach of every fingerprint. ``whole_only``: grams of the short lengths only for texts of that length."""
    counts = np.diff(words.bounds)
    ends, sizes = np.repeat(words.bounds[1:], counts), np.repeat(counts, counts)
    at = np.flatnonzero(winnowed(words.hashes, ends, span, k))
    places, hashes, reach = [at], [grams(words.hashes, k)[at] if len(at) else np.empty(0, U64)], [np.full(len(at), span)]
    for n in lengths:
        found = grams(words.hashes, n)
        fits = np.arange(len(found)) + n <= ends[: len(found)]
        if whole_only:
            fits &= sizes[: len(found)] == n
        at = np.flatnonzero(fits)
        places.append(at)
        hashes.append(found[at])
        reach.append(np.full(len(at), n))
    return np.concatenate(places), np.concatenate(hashes), np.concatenate(reach)


def _around(words: Words, at: np.ndarray, text: np.ndarray, span: int, k: int, outside: np.uint64) -> np.ndarray:
    index = at[:, None] + np.arange(k - span, span)
    inside = (index >= words.bounds[text][:, None]) & (index < words.bounds[text + 1][:, None])
    return np.where(inside, words.hashes[np.clip(index, 0, len(words.hashes) - 1)], outside)


def _fixed(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * 8
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def item_prints(items: DataFrame, span: int, k: int) -> DataFrame:
    """Fingerprints of the items: fp, item_id (text), reach, words around."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = words_of(part.column("text"), LETTERED)
            at, found, reach = _probes(words, span, k, list(range(1, span)), True)
            text = np.searchsorted(words.bounds, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), part.column("item_id").take(pa.array(text)), pa.array(reach), _fixed(_around(words, at, text, span, k, OUTSIDE_ITEM))],
                ["fp", "item_id", "reach", "item_words"],
            )

    given = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return stored(given.transform(mapped, prints, "fp long, item_id string, reach long, item_words binary"), "item-prints")


def _bitmap(prints: DataFrame) -> np.ndarray:
    """Bytes of the bitmap of all fingerprints, 2 ** BITS bits."""
    place = F.shiftrightunsigned("fp", 64 - BITS)
    rows = (
        prints.select(F.shiftright(place, 3).cast("int").alias("byte"), F.pow(F.lit(2), place % 8).cast("int").alias("bit"))
        .groupBy("byte")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()  # 2 ** (BITS - 3) rows at most
    )
    held = np.zeros(1 << BITS - 3, dtype=np.uint8)
    held[rows["byte"].to_numpy()] = rows["bits"].to_numpy()
    return held


def doc_prints(docs: DataFrame, prints: DataFrame, span: int, k: int) -> DataFrame:
    """A row per document: row, doc_id, n_words and its fingerprints that items may have."""
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(_bitmap(prints))  # 2 ** (BITS - 3) bytes
    lengths = sorted(r["reach"] for r in prints.where(F.col("reach") < span).select("reach").distinct().collect())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, known = TaskContext.get().partitionId() << 40, bitmap.value
        for part in slices(batches, "text"):
            words = words_of(part.column("text"), LETTERED)
            at, found, _ = _probes(words, span, k, lengths, False)
            place = found >> U64(64 - BITS)
            kept = (known[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1
            at, found = at[kept], found[kept]
            order = np.argsort(at, kind="stable")
            at, found = at[order], found[order]
            text = np.searchsorted(words.bounds, at, side="right") - 1
            probes = pa.StructArray.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(at - words.bounds[text]), _fixed(_around(words, at, text, span, k, OUTSIDE_DOC))],
                ["fp", "at", "doc_words"],
            )
            offsets = np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32)
            rows = pa.array(np.arange(row, row + len(part)))
            row += len(part)
            yield pa.RecordBatch.from_arrays(
                [rows, part.column("doc_id"), pa.array(np.diff(words.bounds)), pa.ListArray.from_arrays(offsets, probes)],
                ["row", "doc_id", "n_words", "probes"],
            )

    schema = f"row long, doc_id {kind}, n_words long, probes array<struct<fp long, at long, doc_words binary>>"
    return stored(docs.select("doc_id", "text").transform(mapped, probe, schema), "doc-prints")


def extended(joined: DataFrame, span: int, k: int) -> DataFrame:
    """Spans (row, item_id, start, end) of the joined fingerprints whose surroundings agree."""
    wide = 2 * span - k

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=U64).reshape(-1, wide) for c in ("doc_words", "item_words")
            )
            at, reach = batch.column("at").to_numpy(), batch.column("reach").to_numpy()
            same = (a == b).astype(np.int64)
            run = np.concatenate([np.zeros((len(same), 1), np.int64), same.cumsum(axis=1)], axis=1)
            # windows that start from span - k words before the fingerprint up to its own start
            hits = (run[:, span : 2 * span - k + 1] - run[:, : span - k + 1] == span) & (reach == span)[:, None]
            own = np.minimum(span - k + reach, wide)
            hits[:, span - k] |= (reach < span) & (run[np.arange(len(run)), own] - run[:, span - k] == reach)
            on = np.flatnonzero(hits.any(axis=1))
            hits = hits[on]
            first, last = hits.argmax(axis=1), hits.shape[1] - 1 - hits[:, ::-1].argmax(axis=1)
            base = at[on] - (span - k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(on)), batch.column("item_id").take(pa.array(on)), pa.array(base + first), pa.array(base + last + reach[on])],
                ["row", "item_id", "start", "end"],
            )

    return joined.select("row", "item_id", "at", "reach", "doc_words", "item_words").transform(
        mapped,
        extend, "row long, item_id string, start long, end long"
    )


def contamination(docs: DataFrame, items: DataFrame, span: int = 10, k: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit (words inside a window that occurs), items (ids of items with such windows, sorted) and
    spans (start, end, word numbers, merged) of every document."""
    prints = item_prints(items, span, k)
    found = doc_prints(docs, prints, span, k)
    probes = found.select("row", F.inline("probes"))
    hits = extended(probes.join(prints, "fp"), span, k)
    before = F.max("end").over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))))
    totals = (
        hits.withColumn("fresh", fresh)
        .groupBy("row")
        .agg(
            F.sum("fresh").alias("n_hit"),
            F.array_sort(F.collect_set("item_id")).alias("items"),
            F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
        )
    )
    return (
        found.select("row", "doc_id", "n_words")
        .join(totals, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        )
    )


def uncontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a word inside a window of an item, all columns as they are."""
    held = numbered(docs)
    found = contamination(held.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), items)
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("row"))
    return held.join(hit, "row", "left_anti").select("doc.*")

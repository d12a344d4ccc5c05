"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The words of a source, its documents in a fixed order, are cut into blocks of ``block_words``
words (the last one may be shorter). The blocks of the mix are apportioned to the sources by
the highest quotients target / (2 * seats + 1), the target in blocks of the source. The method is house-monotone, so the seats
after the blocks of shard j minus those before it are non-negative integer quotas for every
shard and source. Each source deals its blocks in the order of a seeded permutation, round after
round, to the shards by their quotas.

* null text: size 0, takes 0; an empty source: target 0; an empty table: no rows
* null source: a source of its own, after all others
* equal doc_id: ordered by size; rows that are equal in both may swap what they take
* very long texts: the work of a document grows with its blocks; no text is cut short
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import cycle, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medallion.llm.store import mapped, stored
from medallion.llm.words import SPACED, U64, mixed, words_of

#: Sources whose totals the driver plans with; more are refused.
MAX_SOURCES = 100_000
#: Parts of a source whose running totals are made apart, so that no source is one task.
SLOTS = 4096

#: Words of a block unless told otherwise: a source is off its target by half a block or so.
BLOCK_WORDS = 64

#: A word, for Spark's own count.
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: tuple[int, ...] = (1, 2, 3), limit: int = 3) -> list[float]:
    """The whole of ``sizes`` shared by weight, no source above ``limit`` times its size."""
    share = list(islice(cycle(weights), len(sizes)))
    out, free, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        unit = rest / sum(share[i] for i in free)
        over = [i for i in free if share[i] * unit > limit * sizes[i]]
        for i in over or free:
            out[i] = float(limit * sizes[i]) if over else share[i] * unit
        if not over:
            break
        free -= set(over)
        rest -= sum(out[i] for i in over)
    return out


def sainte_lague(goals: list[float], seats: int, most: list[int]) -> list[int]:
    """``seats`` by highest quotients goal / (2 * seats + 1), none above ``most``; ties go to the first."""
    total = sum(goals)
    if total <= 0:
        return [0] * len(goals)
    # the multiplier that seats them all is above this one, which seats fewer even when every quotient rounds up
    low = max(0.0, seats - len(goals) / 2 - 1) / total
    out = [min(most[i], int(g * low + 0.5)) for i, g in enumerate(goals)]
    heap = [(-g / (2 * out[i] + 1), i) for i, g in enumerate(goals) if g > 0 and out[i] < most[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-goals[i] / (2 * out[i] + 1), i))
    return out


def plan(
    totals: list[tuple[str | None, int]],
    weights: tuple[int, ...] = (1, 2, 3),
    limit: int = 3,
    block_words: int | None = None,
    shards: int = 16,
) -> tuple[list[dict], int]:
    """Per source: name, size, target, blocks and the quota of each shard; and the words of a block.

    Seats are blocks, so a source's target counts in blocks of its own: ``block_words`` words, but for a
    source shorter than that its only block is all it has.
    """
    totals = sorted(totals, key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in totals]
    goals = targets(sizes, weights, limit)
    block = block_words or BLOCK_WORDS
    blocks = [-(-n // block) for n in sizes]
    wanted = [g * b / n if n else 0.0 for g, b, n in zip(goals, blocks, sizes)]
    seats, most = round(sum(wanted)), [limit * n for n in blocks]
    held = [sainte_lague(wanted, seats * j // shards, most) for j in range(shards + 1)]
    return [
        {"source": name, "source_size": sizes[i], "target": goals[i], "blocks": blocks[i], "key": zlib.crc32(repr(name).encode())}
        | {"quotas": [after[i] - before[i] for before, after in zip(held, held[1:])]}
        for i, (name, _) in enumerate(totals)
    ], block


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of each index in a permutation of 0..size-1 that ``key`` picks: a Feistel network, walked on
    until it is inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(2, size)) / 2)).astype(np.int64)).astype(U64)
    low, x, todo = (U64(1) << half) - U64(1), index.astype(U64), np.ones(len(index), dtype=bool)
    while todo.any():
        h, m, k = half[todo], low[todo], key[todo].astype(U64)
        left, right = x[todo] >> h, x[todo] & m
        for i in range(4):
            left, right = right, left ^ (mixed(right + (k << U64(8)) + U64(i)) & m)
        x[todo] = (left << h) | right
        todo[todo] = x[todo] >= size[todo].astype(U64)
    return x.astype(np.int64)


def _blocks(batch: pa.RecordBatch, block: int, seed: int) -> tuple[np.ndarray, ...]:
    """For each document and block of it: row, number of words, words before them in the document, place of the block
    in its source's permutation."""
    get = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
    before, size, blocks = get("before"), get("size"), get("blocks")
    first, last = before // block, (before + size - 1) // block
    count = np.where(size > 0, last - first + 1, 0)
    row = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    low = np.maximum(number * block, before[row])
    words = np.minimum((number + 1) * block, (before + size)[row]) - low
    return row, words, low - before[row], permuted(number, blocks[row], get("key")[row] * 1000003 + seed)


def _placed(docs: DataFrame, weights, limit, block_words, shards) -> tuple[DataFrame, int]:
    """Documents as ``doc``, with size, words before it in its source, and the source's plan."""
    spark = docs.sparkSession
    sized = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc")).select(
        "doc",
        F.col("doc.source").alias("of"),
        F.coalesce(F.regexp_count("doc.text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.pmod(F.xxhash64("doc.doc_id"), F.lit(SLOTS)).alias("slot"),
    )
    per_slot = stored(sized.groupBy("of", "slot").agg(F.sum("size").alias("words")), "mix-slots")
    totals = per_slot.groupBy("of").agg(F.sum("words").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sources, block = plan([(r["of"], r["words"]) for r in totals], weights, limit, block_words, shards)
    schema = "sid long, name string, source_size long, target double, blocks long, key long, full long, extra long, quotas array<long>"
    planned = F.broadcast(spark.createDataFrame([
        (i, x["source"], x["source_size"], x["target"], x["blocks"], x["key"], *divmod(sum(x["quotas"]), max(1, x["blocks"])), x["quotas"])
        for i, x in enumerate(sources)
    ], schema))  # at most MAX_SOURCES rows
    same = F.col("of").eqNullSafe(F.col("name"))
    until_here = lambda w: F.coalesce(F.sum(w[0]).over(w[1].rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per_slot.join(planned.select("sid", "name"), same).select(
        "sid", "slot", until_here(("words", Window.partitionBy("sid").orderBy("slot"))).alias("base")
    )
    placed = (
        sized.join(planned, same)
        .withColumn("here", until_here(("size", Window.partitionBy("sid", "slot").orderBy("doc.doc_id", "size"))))
        .join(offsets, ["sid", "slot"])
        .withColumn("before", F.col("base") + F.col("here"))
    )
    return placed, block


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    limit: int = 3,
    block_words: int | None = None,
    shards: int = 16,
    seed: int = 1,
) -> DataFrame:
    """doc_id, size, source_size, target, the words ``taken`` of each document, repeats counted, and those for each shard."""
    placed, block = _placed(docs.select("doc_id", "source", "text"), weights, limit, block_words, shards)
    columns = ["size", "source_size", "target", "before", "blocks", "key", "full", "extra", "quotas"]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, words, _, place = _blocks(batch, block, seed)
            full, extra, blocks = (batch.column(c).to_numpy()[row] for c in ("full", "extra", "blocks"))
            quotas = batch.column("quotas").flatten().to_numpy().reshape(-1, shards)
            ends, out = np.cumsum(quotas, axis=1), np.zeros(len(batch) * shards)
            for r in range(int(full.max(initial=0)) + 1):
                on = np.where(r < full, True, (r == full) & (place < extra))
                shard = ((r * blocks[on] + place[on])[:, None] >= ends[row[on]]).sum(axis=1)
                out += np.bincount(row[on] * shards + shard, words[on], len(out))
            out = out.astype(np.int64).reshape(-1, shards)
            by_shard = pa.ListArray.from_arrays(np.arange(len(batch) + 1, dtype=np.int32) * shards, out.ravel())
            kept = batch.select(["doc_id", "size", "source_size", "target"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(out.sum(axis=1)), by_shard], [*kept.schema.names, "taken", "shard_words"]
            )

    narrow = placed.select(F.col("doc.doc_id").alias("doc_id"), *columns)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.transform(
        mapped,
        take, f"doc_id {kind}, size long, source_size long, target double, taken long, shard_words array<long>"
    )


def mixed_documents(docs: DataFrame, seed: int = 1, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for every full round of a document's source, and one
    whose text is the chosen blocks of the last round. Blocks that follow each other stay as they stand in the
    text; others are joined by a line end."""
    given = {"weights": (1, 2, 3), "limit": 3, "block_words": None, "shards": 16} | options
    placed, block = _placed(docs, **given)
    text = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, words, skip, place = _blocks(batch, block, seed)
            chosen = place < batch.column("extra").to_numpy()[row]
            columns = batch.column("doc").flatten()
            rounds = np.repeat(np.arange(len(batch)), batch.column("full").to_numpy())
            some, cuts = np.unique(row[chosen]), []
            for i in some.tolist():
                mine = slice(*np.searchsorted(row, [i, i + 1]))
                at, n, on, whole = skip[mine], words[mine], chosen[mine], columns[text][i].as_py()
                if not on.all():
                    found, data = words_of(pa.array([whole]), SPACED), whole.encode()
                    begin, end = at[on], at[on] + n[on]
                    apart = begin[1:] != end[:-1]
                    runs = zip(begin[np.append(True, apart)], end[np.append(apart, True)])
                    whole = "\n".join(data[found.starts[a] : found.ends[b - 1]].decode() for a, b in runs)
                cuts.append(whole)
            index = pa.array(np.concatenate([rounds, some]).astype(np.int64))
            out = [c.take(index) for c in columns]
            out[text] = pa.concat_arrays([columns[text].take(pa.array(rounds)), pa.array(cuts, type=columns[text].type)])
            yield pa.RecordBatch.from_arrays(out, names)

    names = docs.columns
    flat = placed.select("doc", "size", "before", "blocks", "key", "full", "extra")
    return flat.transform(mapped, cut, docs.schema)

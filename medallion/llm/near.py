"""MinHash near-dedup by a multi-index Hamming join, confirmed on whole shingle sets.

A document's set is its distinct shingles of five words. ``CHUNKS`` * ``WIDTH`` minima of seeded
permutations, ``BITS`` bits of each, make its signature; two signatures are as far apart as the
numbers they differ in. If they differ in at most ``CHUNKS`` * (``ERRORS`` + 1) - 1 numbers, then
some chunk differs in at most ``ERRORS`` of its ``WIDTH`` numbers (pigeonhole). So every chunk gives
a key for each choice of ``ERRORS`` numbers left out, and all pairs within that distance share a key.
A pair at Jaccard 0.75, be it nearer or farther, shares none with probability 6e-6.

Equal sets are one class from the start. Links within a key need not be tried for all pairs, as only
the components count. First each class of a key is compared with the smallest of that key; then, with
the components known so far, with one picked at random in each key, if that is of another
component; at last all pairs of a key that are still in different components: as rows in keys of few
classes, and in blocks of classes with their sets in larger ones, where a task counts shared shingles for
two blocks at once and returns links only. Every link is confirmed on the two whole sets. No pair is
left untried because of a count.

* null or empty text, no words: n_shingles 0, a component of its own; one to four words: one shingle
* equal texts, rows that repeat a doc_id: one class, one component
* null doc_id: takes part, and gives no component its id; a component without an id has null
* empty table: no rows; very long texts: whole sets
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import mapped, numbered, release, slices, stored
from medallion.llm.words import SPACED, U64, grams, mixed, words_of

SHINGLE = 5
#: Jaccard of at least 75 of 100.
PERCENT = 75
CHUNKS, WIDTH, ERRORS, BITS = 12, 5, 1, 32
#: Classes of a key whose pairs are rows; classes of a block where they are more; shingles counted at once.
FEW, BLOCK, COLUMNS = 32, 512, 8192
#: Bits of the filter that tells which sets a pair needs; it lets through too many when they are more.
FILTER_BITS = 24

_NUMBERS = CHUNKS * WIDTH
_FACTORS = np.random.default_rng(75).integers(1, 2**63, _NUMBERS, dtype=U64) * U64(2) + U64(1)
_KEPT = list(combinations(range(WIDTH), WIDTH - ERRORS))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words = words_of(texts, SPACED)
    for low, high in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        found = grams(words.hashes[low:high], min(SHINGLE, max(1, high - low)))
        found.sort()
        yield found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima, ``BITS`` of each."""
    least = np.full(_NUMBERS, 2**64 - 1, dtype=U64)
    for low in range(0, len(shingles), 1 << 14):
        least = np.minimum(least, (_FACTORS[:, None] * shingles[None, low : low + (1 << 14)]).min(axis=1))
    return mixed(least) >> U64(64 - BITS)


def keys_of(signatures: np.ndarray) -> np.ndarray:
    """A row of keys for each signature: every chunk without every choice of ``ERRORS`` numbers."""
    out = []
    for chunk in range(CHUNKS):
        for choice in _KEPT:
            key = np.full(len(signatures), chunk * 1000 + len(out), dtype=U64)
            for i in choice:
                key = mixed(key + signatures[:, chunk * WIDTH + i])
            out.append(key)
    return np.stack(out, axis=1)


def shingled(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_shingles, the id of its set (null if empty) and the set's keys."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches, "text"):
            sizes, ids, signs = [], [], []
            for found in shingle_sets(part.column("text")):
                sizes.append(len(found))
                ids.append(set_id(found) if len(found) else None)
                signs.append(signature(found))
            keys = keys_of(np.stack(signs)).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * keys.shape[1], keys.ravel())
            rows = pa.array(np.arange(row, row + len(part)))
            row += len(part)
            yield pa.RecordBatch.from_arrays(
                [rows, part.column("doc_id"), pa.array(sizes, type=pa.int64()), pa.array(ids, type=pa.binary()), lists],
                ["row", "doc_id", "n_shingles", "set_id", "keys"],
            )

    schema = f"row long, doc_id {kind}, n_shingles long, set_id binary, keys array<long>"
    return stored(docs.select("doc_id", "text").transform(mapped, sets, schema), "near-sets")


def _needed(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The shingle sets of ``classes`` (set_id, cid), made anew from the texts: cid, shingles."""
    spark = docs.sparkSession
    taken = classes.select(F.conv(F.hex(F.substring("set_id", 1, 3)), 16, 10).cast("int").alias("at")).distinct().toArrow()
    flags = np.zeros(1 << FILTER_BITS, dtype=bool)  # 2 ** FILTER_BITS rows and bits at most
    flags[taken["at"].to_numpy()] = True
    wanted = spark.sparkContext.broadcast(np.packbits(flags, bitorder="little"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = wanted.value, set()
        for part in slices(batches, "text"):
            ids, found = [], []
            for shingles in shingle_sets(part.column("text")):
                if not len(shingles):
                    continue
                name = set_id(shingles)
                at = int.from_bytes(name[:3], "big")
                if known[at >> 3] >> (at & 7) & 1 and name not in seen:
                    if len(seen) < 1_000_000:
                        seen.add(name)
                    ids.append(name)
                    found.append(shingles.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, type=pa.binary()), pa.array(found, type=pa.list_(pa.int64()))], ["set_id", "shingles"]
            )

    made = docs.select("text").transform(mapped, sets, "set_id binary, shingles array<long>")
    return stored(made.join(classes, "set_id").dropDuplicates(["cid"]).select("cid", "shingles"), "near-shingles")


def _confirmed(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose ``sets`` are similar enough."""
    a = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("a_set"))
    b = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("b_set"))
    both = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - both
    return stored(pairs.join(b, "b").join(a, "a").where(100 * both >= PERCENT * union).select("a", "b"), "near-links")


def _tried(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """As ``_confirmed``, for pairs whose sets are not at hand."""
    involved = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    sets = _needed(docs, classes.select("set_id", "cid").join(involved, "cid", "left_semi"))
    found = _confirmed(sets, pairs)
    release(sets)
    return found


def linked(sets: list[np.ndarray], components: np.ndarray, sides: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of different components that are similar enough; where there are two sides, one of each."""
    sizes = np.array([len(s) for s in sets])
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = (np.cumsum(counts > 1) - 1)[inverse]
    kept = counts[inverse] > 1  # the others are in no intersection
    owner, place = np.repeat(np.arange(len(sets)), sizes)[kept], place[kept]
    members = np.unique(components, return_inverse=True)[1]
    odd = np.flatnonzero(members != np.bincount(members).argmax())  # every pair wanted has one of these
    both = np.zeros((len(odd), len(sets)), dtype=np.float32)
    for low in range(0, int(place.max(initial=-1)) + 1, COLUMNS):
        here = (place >= low) & (place < low + COLUMNS)
        marks = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        marks[owner[here], place[here] - low] = 1
        both += marks[odd] @ marks.T
    union = sizes[odd][:, None] + sizes[None, :] - both
    good = (100 * both >= percent * union) & (components[odd][:, None] != components[None, :])
    if len(np.unique(sides)) > 1:
        good &= sides[odd][:, None] != sides[None, :]
    return [(int(odd[i]), int(j)) for i, j in zip(*np.nonzero(good))]


def _in_blocks(members: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Pairs (a, b) of ``members`` (key, cid, component, size) that are links, found block by block within each key.

    Sets are sent as 31 bits of each shingle, which may make some equal; so a percent less is asked for here, and
    what is found is confirmed on the whole hashes.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    short = sets.select("cid", F.transform("shingles", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("set"))
    sent = (
        members.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("cid"), blocks).cast("int")})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "cid", "component", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
        .join(short, "cid")
    )
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs_of(group: list[tuple]) -> list[tuple[int, int]]:
            cids, components, own, sets = zip(*group)
            found = linked(list(sets), np.array(components), np.array(own), PERCENT - 1)
            return [(min(cids[i], cids[j]), max(cids[i], cids[j])) for i, j in found]

        now, group = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            sets = batch.column("set")
            for i, (key, x, y, *rest) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "x", "y", "cid", "component", "own")))):
                if (key, x, y) != now:
                    out += pairs_of(group) if len(group) > 1 else []
                    now, group = (key, x, y), []
                group.append((*rest, sets[i].values.to_numpy()))
            yield batch_of(out)
        yield batch_of(pairs_of(group) if len(group) > 1 else [])

    def batch_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        columns = list(zip(*pairs)) if pairs else [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], ["a", "b"])

    dealt = sent.repartition(tasks, "key", "x", "y").sortWithinPartitions("key", "x", "y")
    return dealt.transform(mapped, compare, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """id and the smallest id of its component, for every id in ``links`` (a, b), by alternating large and small stars."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "near-edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "near-least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "near-edges")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "near-least")
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = stored(small.distinct(), "near-edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        state = now


def near_duplicates(docs: DataFrame, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id its links lead to) and kept, for every row."""
    rows = shingled(docs)
    classes = stored(
        rows.where("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min("row").alias("cid"), F.min("doc_id").alias("low"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")),
        "near-classes",
    )
    keyed = classes.select("cid", "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min(F.struct("cid", "n")).alias("least"), F.count("*").alias("members")).where("members > 1")
    buckets = stored(keyed.join(stored(shared, "near-shared"), "key").select("key", "cid", "n", "least"), "near-buckets")

    alike = lambda x, y: 100 * F.least(x, y) >= PERCENT * F.greatest(x, y)  # noqa: E731  sizes alone can tell
    stars = buckets.where(F.col("cid") != F.col("least.cid")).where(alike(F.col("n"), F.col("least.n")))
    stars = stored(stars.select(F.col("least.cid").alias("a"), F.col("cid").alias("b")).distinct(), "near-pairs")
    links = _tried(docs, classes, stars)

    def unresolved(found: DataFrame) -> DataFrame:
        """Members, with their component so far, of the keys that have several components."""
        placed = buckets.join(found, F.col("cid") == F.col("id"), "left").select("key", "cid", "n", F.coalesce("component", "cid").alias("component"))
        sums = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"))
        several = stored(sums.where("x <> y").select("key", "size"), "near-several")
        return stored(placed.join(several, "key"), "near-open")

    open_ = unresolved(stored(components(links), "near-found"))
    pick = F.min(F.struct(F.xxhash64("key", "cid").alias("order"), "cid", "n", "component")).alias("pick")
    tried = (
        open_.join(stored(open_.groupBy("key").agg(pick), "near-picks"), "key")
        .where((F.col("component") != F.col("pick.component")) & alike(F.col("n"), F.col("pick.n")))
        .select(F.least("cid", "pick.cid").alias("a"), F.greatest("cid", "pick.cid").alias("b"))
        .distinct()
    )
    links = stored(links.unionByName(_tried(docs, classes, stored(tried, "near-pairs"))), "near-links")

    open_ = unresolved(stored(components(links), "near-found"))
    small = open_.where(F.col("size") <= few)
    other = small.select("key", F.col("cid").alias("b"), F.col("n").alias("m"), F.col("component").alias("other"))
    rest = (
        small.join(other, "key")
        .where((F.col("cid") < F.col("b")) & (F.col("component") != F.col("other")) & alike(F.col("n"), F.col("m")))
        .select(F.col("cid").alias("a"), "b")
        .distinct()
    )
    rest = stored(rest, "near-pairs")
    large = open_.where(F.col("size") > few)
    involved = rest.select(F.explode(F.array("a", "b")).alias("cid")).union(large.select("cid")).distinct()
    sets = _needed(docs, classes.select("set_id", "cid").join(involved, "cid", "left_semi"))
    dense = _in_blocks(large, sets, block)
    links = links.unionByName(_confirmed(sets, rest.unionByName(dense).distinct()))
    release(sets)

    found = stored(components(links), "near-found")
    placed = classes.join(found, F.col("cid") == F.col("id"), "left").select("set_id", "low", F.coalesce("component", "cid").alias("component"))
    lows = stored(placed.groupBy("component").agg(F.min("low").alias("component_id")), "near-lows")
    ids = placed.join(lows, "component").select("set_id", "component_id")
    return rows.join(ids, "set_id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Of every component the row with the smallest doc_id (null last), all columns as they are."""
    held = numbered(docs)
    found = near_duplicates(held.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")))
    ids = held.select("row", F.col("doc.doc_id").alias("doc_id"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    placed = found.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row")
    kept = placed.groupBy("component_id").agg(F.min(order).alias("least")).select("least.row")
    return held.join(kept, "row", "left_semi").select("doc.*")

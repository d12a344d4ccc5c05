"""Product quantisation whose Lloyd rounds run on cover trees.

Components become whole numbers, vectors are cut into ``PARTS`` equal parts, and each part
position has a codebook of up to ``ENTRIES`` entries. Every slice of the table has a cover tree per part
position: the points of a node lie within its radius of its centre, and the centres of a node's children
lie farther apart than half of it. Points are kept in tree order with cumulative sums, so the sum of any
subtree is a difference of two rows. The trees are built once and stored; a round sends the
codebooks to them. If the second nearest entry is farther from a node's centre than the nearest one
by more than twice the radius, the triangle inequality gives the whole subtree to the nearest; other
nodes pass the question to their children, and leaves compare each point exactly. Equal points
are one node of radius 0. Sums of a codebook are at most PARTS * ENTRIES rows for the driver.

* vector null, or with a null or non-finite component: left out
* ties: the lower index; the first codebooks come from the smallest ids, equal ids by their components
* null vec_id: takes part, last in that order; null label: a group of its own in label_error
* fewer vectors than entries: as many entries as vectors; no vectors or an empty table: no rows
* a number of components that PARTS does not divide, or that differs between rows: an error,
  and so are whole numbers beyond 2 ** 26, whose squares would not add up exactly
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import mapped, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of a slice; points of a leaf; distances computed at once.
SLICE, LEAF, AT_ONCE = 4096, 8, 1 << 14
#: Largest whole number of a component.
LIMIT = 1 << 26


class Tree(NamedTuple):
    """Points in tree order, their rows and cumulative sums; nodes in order of their levels.

    Node i holds the points ``low[i]:high[i]``, all within ``radius[i]`` of ``centre[i]``; its children are
    the nodes ``child[i]:child[i] + children[i]``.
    """

    rows: np.ndarray
    points: np.ndarray
    sums: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray
    children: np.ndarray


def _farthest(points: np.ndarray, group: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance of every point to its group's centre, and the largest one of each group."""
    squared = ((points - points[centre[group]]) ** 2).sum(axis=1)
    largest = np.zeros(len(centre), dtype=np.int64)
    np.maximum.at(largest, group, squared)
    return squared, largest


def cover_tree(points: np.ndarray) -> Tree:
    """Levels are built for all nodes at once: a node's first point not yet covered becomes the next child's centre."""
    n = len(points)
    group, centre = np.zeros(n, dtype=np.int64), np.zeros(1, dtype=np.int64)
    node_of = np.zeros(1, dtype=np.int64)  # node number of each group
    squared, largest = _farthest(points, group, centre)
    centres, radii, parents, levels = [centre], [largest], [np.array([-1])], [group]
    number = 1
    while True:
        sizes = np.bincount(group, minlength=len(centre))
        splits = (sizes > LEAF) & (largest > 0)
        if not splits.any():
            break
        reach = largest // 4  # half the radius, squared
        child = np.zeros(n, dtype=np.int64)  # the parent's centre covers first
        open_ = np.flatnonzero(splits[group] & (squared > reach[group]))
        found, owners, step = [centre], [np.arange(len(centre))], 0
        while len(open_):
            step += 1
            first = np.full(len(centre), n)
            np.minimum.at(first, group[open_], open_)
            away = ((points[open_] - points[first[group[open_]]]) ** 2).sum(axis=1)
            near = away <= reach[group[open_]]
            child[open_[near]] = step
            owner = np.flatnonzero(first < n)
            found.append(first[owner])
            owners.append(owner)
            open_ = open_[~near]
        kinds = np.concatenate([np.full(len(o), i) for i, o in enumerate(owners)])
        owners, found = np.concatenate(owners), np.concatenate(found)
        # children of a node follow each other
        order = np.lexsort((kinds, owners))
        owners, found, kinds = owners[order], found[order], kinds[order]
        code = owners * (step + 1) + kinds
        group = np.searchsorted(code, group * (step + 1) + child)
        centre = found
        squared, largest = _farthest(points, group, centre)
        fresh = splits[owners]
        numbers = node_of[owners]
        parents.append(numbers[fresh])
        numbers[fresh] = number + np.arange(int(fresh.sum()))
        number += int(fresh.sum())
        node_of = numbers
        centres.append(centre[fresh])
        radii.append(largest[fresh])
        levels.append(np.where(fresh[group], numbers[group], -1))
    rows = np.argsort(group, kind="stable")
    low, high = np.full(number, n), np.zeros(number, dtype=np.int64)
    for node in levels:
        at = node[rows]
        there = np.flatnonzero(at >= 0)
        np.minimum.at(low, at[there], there)
        np.maximum.at(high, at[there], there + 1)
    parent = np.concatenate(parents)
    children = np.bincount(parent[1:], minlength=number)
    child = np.zeros(number, dtype=np.int64)
    inner = np.flatnonzero(children)
    child[inner] = 1 + np.cumsum(children[inner]) - children[inner]
    ordered = points[rows]
    sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(ordered, axis=0)])
    centre = np.concatenate(centres)
    return Tree(rows, ordered, sums, points[centre], np.sqrt(np.concatenate(radii)), low, high, child, children)


def _distances(points: np.ndarray, entries: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    for at in range(0, len(points), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        squared = np.zeros((len(points[part]), len(entries)), dtype=np.int64)
        for k in range(points.shape[1]):
            squared += (points[part, k, None] - entries[None, :, k]) ** 2
        yield part, squared


def assigned(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Entry of every point in tree order, sums and counts of the entries, and how many points were compared."""
    to = np.zeros(len(tree.points), dtype=np.int64)
    sums, counts = np.zeros(entries.shape, dtype=np.int64), np.zeros(len(entries), dtype=np.int64)
    nodes, exact = np.zeros(1, dtype=np.int64), []
    while len(nodes):
        nearest, sure = np.zeros(len(nodes), dtype=np.int64), np.zeros(len(nodes), dtype=bool)
        for part, squared in _distances(tree.centre[nodes], entries):
            nearest[part] = squared.argmin(axis=1)
            if len(entries) > 1:
                two = np.sqrt(np.partition(squared, 1, axis=1)[:, :2])
                margin = two[:, 1] - two[:, 0]
                sure[part] = margin * (1 - 1e-9) > 2 * tree.radius[nodes[part]] + 1e-6
            else:
                sure[part] = True
        sure |= tree.radius[nodes] == 0
        whole, entry = nodes[sure], nearest[sure]
        low, high = tree.low[whole], tree.high[whole]
        np.add.at(sums, entry, tree.sums[high] - tree.sums[low])
        np.add.at(counts, entry, high - low)
        to[_ranges(low, high - low)] = np.repeat(entry, high - low)
        doubtful = nodes[~sure]
        leaves = tree.children[doubtful] == 0
        exact.append(_ranges(tree.low[doubtful[leaves]], (tree.high - tree.low)[doubtful[leaves]]))
        inner = doubtful[~leaves]
        nodes = _ranges(tree.child[inner], tree.children[inner])
    points = np.concatenate(exact)
    for part, squared in _distances(tree.points[points], entries):
        to[points[part]] = squared.argmin(axis=1)
    np.add.at(sums, to[points], tree.points[points])
    counts += np.bincount(to[points], minlength=len(entries))
    return to, sums, counts, len(points)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def whole_numbers(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, label and the components of usable vectors as whole numbers."""
    usable = F.coalesce(F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    numbers = F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.where(usable).select("vec_id", "label", numbers.alias("v"))


def _trees(numbers: DataFrame, parts: int) -> DataFrame:
    """A row per slice: its ids and labels, and its trees."""
    kinds = [numbers.schema[c].dataType.simpleString() for c in ("vec_id", "label")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                sizes = np.unique(part.column("v").value_lengths().to_numpy())
                if len(sizes) > 1 or sizes[0] % parts:
                    raise ValueError(f"vectors of {sizes.tolist()} components; one size that {parts} divides is needed")
                v = part.column("v").flatten().to_numpy().reshape(len(part), -1)
                if v.size and np.abs(v).max() > LIMIT:
                    raise ValueError(f"components beyond {LIMIT}")
                width = v.shape[1] // parts
                trees = [tuple(cover_tree(np.ascontiguousarray(v[:, p * width : (p + 1) * width]))) for p in range(parts)]
                offsets = pa.array([0, len(part)], type=pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, part.column(c)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([pickle.dumps(trees)])], ["vec_ids", "labels", "trees"])

    schema = f"vec_ids array<{kinds[0]}>, labels array<{kinds[1]}>, trees binary"
    return numbers.transform(mapped, build, schema)


def _totals(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """Sum and number of the points of each entry, with how many points were compared one by one."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, dtype=np.int64), np.zeros(books.shape[:2], dtype=np.int64)
        compared = np.zeros(len(books), dtype=np.int64)
        for batch in batches:
            for stored_trees in batch.column("trees"):
                for p, tree in enumerate(pickle.loads(stored_trees.as_py())):
                    _, s, c, n = assigned(Tree(*tree), books[p])
                    sums[p], counts[p], compared[p] = sums[p] + s, counts[p] + c, compared[p] + n
        part, entry = (x.ravel() for x in np.indices(counts.shape))
        columns = [part, entry, counts.ravel(), compared[part]]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c.astype(np.int64)) for c in columns], pa.array(list(sums.reshape(len(part), -1)), type=pa.list_(pa.int64()))],
            ["part", "entry", "n", "compared", "sums"],
        )

    width = books.shape[2]
    found = trees.select("trees").transform(mapped, assign, "part long, entry long, n long, compared long, sums array<long>")
    # slices add up within 64 bits; their totals need not
    totals = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.sum("compared").alias("compared"), *totals)


def lloyd(numbers: DataFrame, trees: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks as an array (part, entry, component) after ``rounds`` rounds."""
    first = numbers.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # entries rows
    width = len(first[0]["v"]) // parts if first else 0
    books = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    for _ in range(rounds if books.size else 0):
        books = books.copy()
        for row in _totals(trees, books).collect():  # parts * entries rows
            if row["n"]:
                books[row["part"], row["entry"]] = [int(row[f"s{k}"]) // row["n"] for k in range(books.shape[2])]
    return books


def encoded(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error (squared distance to the code's entries) of every vector."""
    fields = {f.name: f.dataType.elementType.simpleString() for f in trees.schema.fields[:2]}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                slice_trees = pickle.loads(batch.column("trees")[i].as_py())
                n = len(slice_trees[0][0])
                codes, error = np.zeros((n, len(books)), dtype=np.uint8), np.zeros(n, dtype=np.int64)
                for p, tree in enumerate(slice_trees):
                    tree = Tree(*tree)
                    to, _, _, _ = assigned(tree, books[p])
                    codes[tree.rows, p] = to
                    error[tree.rows] += ((tree.points - books[p][to]) ** 2).sum(axis=1)
                given = [batch.column(c)[i].values for c in ("vec_ids", "labels")]
                code = pa.array([row.tobytes().hex() for row in codes])
                yield pa.RecordBatch.from_arrays([*given, code, pa.array(error)], ["vec_id", "label", "code", "error"])

    schema = f"vec_id {fields['vec_ids']}, label {fields['labels']}, code string, error long"
    return trees.transform(mapped, encode, schema)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error and label_error (the errors of a label summed) of usable vectors, and the codebooks."""
    numbers = whole_numbers(vectors, column)
    trees = stored(_trees(numbers, PARTS), "cover-trees")
    books = lloyd(numbers, trees)
    rows = stored(encoded(trees, books), "codes")
    by_label = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    same = rows["label"].eqNullSafe(by_label["label"])
    return rows.join(by_label, same).select("vec_id", rows["label"], "code", "error", "label_error"), books

"""Repair of conversations at least cost, by ranks of paths under prefix doubling.

A repaired conversation is empty or has roles ``s?(ua)+`` by their initials. Its rows come in order of turn
(nulls first), then of role and of the SHA-256 of the text. Editing is a path through nodes (row, state of the
pattern): Keep, Rerole and Delete take a row, Insert takes none. Costs are found from the last
row backwards. Arcs that lie on a cheapest path stay; letters of the arcs that leave a node differ, so audits of
one letter rank the nodes, and the ranks of two audits of a length in a row rank those of twice the length.
Pointers that skip 1, 2, 4 ... arcs are doubled with them, and following them from the start collects the
least audit.

Rows are sorted by range into tasks, so a conversation of any length is dealt over several. What crosses
the edge of a task or of ``BLOCK`` rows is solved in pieces: each tells the cost from any state at its
start to any state at its end, a scan over the pieces gives the costs behind each, all
pieces are then solved side by side for the four states they can be entered in, and a second scan
picks the states. The scans see a row per piece. Only the digest of a repaired conversation runs through its texts
in order, as SHA-256 has to.

* null role or text: one space; null conv_id: a conversation of its own; null turns come first
* rows of one turn: by role, then by SHA-256 of the text; rows that repeat all of it are alike
* blank rows, rows whose role and text came before: deleted; only a row's first fault counts
* no rows: nothing to repair, empty audit; empty table: no conversations; further columns: left out
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from medallion.llm.store import mapped, stored

#: Rows that are solved at once.
BLOCK = 65536
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after s, after u, after a. The role that is due leads to the next state.
DUE = np.array([2, 2, 3, 2])
#: State that keeping a row leads to, by state and initial (s, u, a, other).
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
LETTERS = np.frombuffer(b" DIKR", dtype=np.uint8)
INITIALS = "sua"
BLANK, DUPLICATE, CUT = 1, 2, 3
NEVER = 1 << 40


class Solved(NamedTuple):
    """Costs of the nodes, and of the arcs that leave them the least letter and its target (itself at an end)."""

    first: np.ndarray
    costs: np.ndarray
    letter: np.ndarray
    target: np.ndarray


def _row_costs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost and target state of keeping each row in each state, and the cost of giving it the due role."""
    initial, fault = codes & 3, codes >> 2
    extra = np.where(fault == CUT, TRUNCATED, 0)
    stays = (fault != BLANK) & (fault != DUPLICATE)
    to = KEPT[:, initial].T
    keep = np.where(stays[:, None] & (to >= 0), extra[:, None], NEVER)
    return keep, to, np.where(stays, REROLE + extra, NEVER)


def _inserted(costs: np.ndarray) -> np.ndarray:
    """Costs of nodes of one row when inserts may come first."""
    out = costs.copy()
    out[:, 2] = np.minimum(costs[:, 2], INSERT + costs[:, 3])
    out[:, 3] = np.minimum(costs[:, 3], INSERT + costs[:, 2])
    out[:, :2] = np.minimum(costs[:, :2], INSERT + out[:, 2:3])
    return out


def solve(codes: np.ndarray, sizes: np.ndarray, behind: np.ndarray, is_last: np.ndarray) -> Solved:
    """Cheapest paths of pieces of ``sizes`` rows; ``behind`` are the costs after a piece that is not its conversation's last."""
    first = np.cumsum(sizes + 1) - sizes - 1
    costs = np.empty((len(codes) + len(sizes), 4), dtype=np.int64)
    ends = first + sizes
    costs[ends] = np.where(is_last[:, None], _inserted(np.tile([0, NEVER, NEVER, 0], (len(sizes), 1))), behind)
    piece = np.repeat(np.arange(len(sizes)), sizes)
    node_of_row = np.arange(len(codes)) + piece
    row_of_node = np.zeros(len(costs), dtype=np.int64)
    row_of_node[node_of_row] = np.arange(len(codes))
    keep, to, rerole = _row_costs(codes)
    longest = np.argsort(-sizes, kind="stable")
    active = np.searchsorted(-sizes[longest], -np.arange(int(sizes.max(initial=0))), side="left")
    for step, n in enumerate(active):
        at = ends[longest[:n]] - 1 - step
        row, after = row_of_node[at], costs[at + 1]
        best = np.minimum(after + DELETE, rerole[row, None] + after[:, DUE])
        best = np.minimum(best, keep[row] + np.take_along_axis(after, np.maximum(to[row], 0), axis=1))
        costs[at] = _inserted(best)
    # arcs that lie on cheapest paths; the least letter of each node
    letter = np.zeros((len(costs), 4), dtype=np.int64)
    state = np.tile(np.arange(4), (len(costs), 1))
    node = np.arange(len(costs))[:, None]
    target = node * 4 + state
    at = node_of_row
    after = costs[at + 1]
    choices = [
        (4, at, rerole[:, None] + after[:, DUE], (at[:, None] + 1) * 4 + DUE),
        (3, at, keep + np.take_along_axis(after, np.maximum(to, 0), axis=1), (at[:, None] + 1) * 4 + np.maximum(to, 0)),
    ]
    inserts = np.sort(np.concatenate([at, ends[is_last]]))
    choices.append((2, inserts, INSERT + costs[inserts][:, DUE], inserts[:, None] * 4 + DUE))
    choices.append((1, at, DELETE + after, (at[:, None] + 1) * 4 + np.arange(4)))
    for which, nodes, cost, goes in choices:
        tight = cost == costs[nodes]
        letter[nodes] = np.where(tight, which, letter[nodes])
        target[nodes] = np.where(tight, goes, target[nodes])
    return Solved(first, costs, letter.ravel(), target.ravel())


def ranked(letter: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of the nodes by their least audits, and pointers over 1, 2, 4 ... letters."""
    rank, pointers = letter, [target]
    while letter[pointers[-1]].any():
        skip = pointers[-1]
        _, rank = np.unique(rank * (rank.max() + 1) + rank[skip], return_inverse=True)
        pointers.append(skip[skip])
    return rank, pointers


def audits(solved: Solved, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The least audit from each of the nodes ``starts``, and the node it ends in."""
    rank, pointers = ranked(solved.letter, solved.target)
    # equal ranks have equal audits, so one node of each rank is followed
    _, chosen, of = np.unique(rank[starts], return_index=True, return_inverse=True)
    path = np.arange(len(chosen))
    node, step = starts[chosen], np.zeros(len(chosen), dtype=np.int64)
    begins = solved.letter[node] > 0
    path, node, step = path[begins], node[begins], step[begins]
    for k in range(len(pointers) - 1, -1, -1):
        onward = pointers[k][node]
        goes_on = solved.letter[onward] > 0
        path = np.concatenate([path, path[goes_on]])
        step = np.concatenate([step, step[goes_on] + (1 << k)])
        node = np.concatenate([node, onward[goes_on]])
    order = np.lexsort((step, path))
    text = LETTERS[solved.letter[node[order]]].tobytes().decode()
    cuts = np.concatenate([[0], np.cumsum(np.bincount(path, minlength=len(chosen)))]).tolist()
    found = [text[a:b] for a, b in zip(cuts, cuts[1:])]
    return [found[i] for i in of.tolist()], pointers[-1][starts]


def crossing(codes: np.ndarray) -> np.ndarray:
    """Least cost from any state before the rows to any state after them, as a 4 by 4 matrix."""
    keep, to, rerole = _row_costs(codes)
    n = len(codes)
    steps = np.full((n, 4, 4), NEVER, dtype=np.int64)
    for x in range(4):
        steps[:, x, x] = np.minimum(steps[:, x, x], DELETE)
        steps[:, x, DUE[x]] = np.minimum(steps[:, x, DUE[x]], rerole)
        there = np.flatnonzero(to[:, x] >= 0)
        steps[there, x, to[there, x]] = np.minimum(steps[there, x, to[there, x]], keep[there, x])
    # inserts before a row: the matrix of inserts times that of the row
    insert = np.full((4, 4), NEVER, dtype=np.int64)
    np.fill_diagonal(insert, 0)
    insert[[0, 1, 2, 3], DUE] = INSERT
    insert[[0, 1], 3] = 2 * INSERT
    steps = _times(np.broadcast_to(insert, steps.shape), steps)
    while len(steps) > 1:
        odd = steps[len(steps) - len(steps) % 2 :]
        even = steps[: len(steps) - len(steps) % 2]
        steps = np.concatenate([_times(even[0::2], even[1::2]), odd])
    return steps[0]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a[:, :, 0, None] + b[:, 0, None, :]
    for k in range(1, 4):
        out = np.minimum(out, a[:, :, k, None] + b[:, k, None, :])
    return np.minimum(out, NEVER)


def illegal_pairs(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many neighbours of a piece are not su, ua or au."""
    initial = codes & 3
    pair = initial[:-1] * 4 + initial[1:]
    piece = np.repeat(np.arange(len(sizes)), sizes)
    bad = (piece[1:] == piece[:-1]) & ~np.isin(pair, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
    return np.bincount(piece[1:][bad], minlength=len(sizes))


def _ordered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows, numbered, and what is to be known of each without its text."""
    given = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = stored(given.select(F.monotonically_increasing_id().alias("row"), "*"), "turns")
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    faces = rows.select(
        "conv_id",
        "turn",
        "role",
        "row",
        F.unhex(F.sha2("text", 256)).alias("sha"),
        F.when((F.col("role") == "") | (initial < 0), 3).otherwise(initial).alias("initial"),
        (trimmed == "").alias("blank"),
        F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("ended"),
    )
    firsts = faces.where("NOT blank").groupBy("conv_id", "role", "sha").agg(F.min(F.struct("turn", "row")).alias("at"))
    known = faces.join(firsts.select(F.col("at.row").alias("row"), F.lit(True).alias("first")), "row", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("ended"), CUT).otherwise(0)
    code = (F.col("initial") + 4 * fault).cast("int").alias("code")
    return rows, stored(known.select("conv_id", "turn", "role", "sha", "row", fault.alias("fault"), code), "turn-codes")


def _pieces(marked: DataFrame) -> DataFrame:
    """Consecutive rows of a conversation. Those that may go on elsewhere (``edge``) carry the costs of crossing them, the others their audit."""
    kind = marked.schema["conv_id"].dataType
    keys = ["conv_id", "turn", "role", "sha", "row"]
    tasks = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, start = TaskContext.get().partitionId() << 32, [], True

        def solved(rows: pa.RecordBatch, ends: np.ndarray, edges: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            sizes = ends - begins
            codes = rows.column("code").to_numpy().astype(np.int64)[: ends[-1]]
            whole = np.repeat(~edges, sizes)
            found = solve(codes[whole], sizes[~edges], np.zeros((int((~edges).sum()), 4), dtype=np.int64), np.ones(int((~edges).sum()), bool))
            texts = iter(audits(found, found.first * 4)[0] if len(found.first) else [])
            costs = iter(found.costs[found.first, 0].tolist())
            bad = illegal_pairs(codes, sizes)
            packed, ids = codes.astype(np.uint8).tobytes(), rows.column("row").to_numpy().tobytes()
            spans = list(zip(begins.tolist(), ends.tolist()))
            out = pa.RecordBatch.from_arrays(
                [
                    rows.column("conv_id").take(pa.array(begins)),
                    pa.array(number + np.arange(len(ends))),
                    pa.array(edges),
                    pa.array([packed[a:b] for a, b in spans], type=pa.binary()),
                    pa.array([ids[8 * a : 8 * b] for a, b in spans], type=pa.binary()),
                    pa.array(bad),
                    pa.array([None if e else next(texts) for e in edges], type=pa.string()),
                    pa.array([None if e else next(costs) for e in edges], type=pa.int64()),
                    pa.array([crossing(codes[a:b]).ravel().tolist() if e else None for e, (a, b) in zip(edges, spans)], type=pa.list_(pa.int64())),
                ],
                ["conv_id", "piece", "edge", "codes", "rows", "illegal", "audit", "cost", "crossing"],
            )
            number += len(ends)
            return out

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            """Solve what is held, but for the conversation at its end unless that is long or nothing comes after it."""
            nonlocal held, start
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = rows.column("conv_id").dictionary_encode(null_encoding="encode").indices.to_numpy()
            ends = np.append(np.flatnonzero(ids[1:] != ids[:-1]) + 1, len(ids))
            edges = np.zeros(len(ends), dtype=bool)
            edges[0], edges[-1] = start, True
            begin = int(ends[-2]) if len(ends) > 1 else 0
            if last or len(ids) - begin >= BLOCK:
                held = []
            else:
                ends, edges, held = ends[:-1], edges[:-1], [rows.slice(begin)]
            if len(ends):
                yield solved(rows, ends, edges)
                # what follows may go on with a conversation that was cut
                start = not held

        for batch in batches:
            if len(batch):
                held.append(batch)
                if sum(map(len, held)) >= BLOCK:
                    yield from cut(False)
        if held:
            yield from cut(True)

    columns = "piece long, edge boolean, codes binary, rows binary, illegal long, audit string, cost long, crossing array<long>"
    fields = [T.StructField("conv_id", kind), *T.StructType.fromDDL(columns).fields]
    ordered = marked.select(*keys, "code").repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    return stored(ordered.transform(mapped, piece, T.StructType(fields)), "pieces")


def _behind(edges: DataFrame) -> DataFrame:
    """Costs after each piece by state; null after the last one of a conversation."""
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, costs, end = object(), None, _inserted(np.array([[0, NEVER, NEVER, 0]]))[0]
        for batch in batches:
            out = []
            for conv, matrix in zip(batch.column("conv_id").to_pylist(), batch.column("crossing").to_pylist()):
                if conv != now:
                    now, costs = conv, None
                out.append(None if costs is None else costs.tolist())
                matrix = np.array(matrix, dtype=np.int64).reshape(4, 4)
                costs = (matrix + (end if costs is None else costs)).min(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(out, type=pa.list_(pa.int64()))], ["piece", "behind"])

    given = edges.select("conv_id", "piece", "crossing").repartition(tasks, "conv_id")
    return given.sortWithinPartitions("conv_id", F.desc("piece")).transform(mapped, scan, "piece long, behind array<long>")


def _entered(edges: DataFrame) -> DataFrame:
    """For each piece and each of the four states: its audit, the state it ends in, and the cost from there on."""
    behind = _behind(edges)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                codes = np.frombuffer(batch.column("codes")[i].as_py(), dtype=np.uint8).astype(np.int64)
                costs = batch.column("behind")[i].as_py()
                after = np.array([costs or [0] * 4], dtype=np.int64)
                found = solve(codes, np.array([len(codes)]), after, np.array([costs is None]))
                texts, ends = audits(found, np.arange(4))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(i, 1) for c in ("piece",)],
                        pa.array([texts]),
                        pa.array([(ends % 4).tolist()], type=pa.list_(pa.int64())),
                        pa.array([found.costs[0].tolist()], type=pa.list_(pa.int64())),
                    ],
                    ["piece", "audits", "states", "costs"],
                )

    both = edges.select("piece", "codes").join(behind, "piece")
    return both.transform(mapped, each, "piece long, audits array<string>, states array<long>, costs array<long>")


def _joined_up(edges: DataFrame) -> DataFrame:
    """Pieces with the state they are entered in, their audit, cost (at the first) and pairs with the row before that are illegal."""
    entered = stored(_entered(edges), "entered")
    kind = edges.schema["conv_id"].dataType
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, previous = object(), 0, None
        names = ["conv_id", "piece", "ends", "illegal", "audits", "states", "costs"]
        for batch in batches:
            out = []
            for conv, piece, ends, bad, texts, states, costs in zip(*(batch.column(n).to_pylist() for n in names)):
                cost = 0
                if conv != now:
                    now, state, previous, cost = conv, 0, None, costs[0]
                initials = np.frombuffer(ends, dtype=np.uint8)
                if previous is not None:
                    bad += int(illegal_pairs(np.array([previous, initials[0]], dtype=np.int64), np.array([2]))[0])
                out.append((conv, piece, state, bad, texts[state], cost))
                state, previous = states[state], initials[-1]
            columns = zip(*out) if out else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    ends = F.concat(F.substring("codes", 1, 1), F.substring("codes", -1, 1)).alias("ends")
    given = edges.select("conv_id", "piece", "illegal", ends).join(entered, "piece").repartition(tasks, "conv_id")
    fields = [T.StructField("conv_id", kind), *T.StructType.fromDDL("piece long, entry long, illegal long, audit string, cost long").fields]
    arrow = to_arrow_schema(T.StructType(fields))
    return given.sortWithinPartitions("conv_id", "piece").transform(mapped, scan, T.StructType(fields))


def _edits(pieces: DataFrame) -> DataFrame:
    """The rows of repaired conversations: place, number of the row they come from (null: inserted), new role (null: as it was)."""
    kind = pieces.schema["conv_id"].dataType

    def of_piece(audit: str, codes: bytes, rows: bytes, entry: int) -> tuple[np.ndarray, ...]:
        letters = np.frombuffer(audit.encode(), dtype=np.uint8)
        codes, numbers = np.frombuffer(codes, dtype=np.uint8), np.frombuffer(rows, dtype=np.int64)
        row = np.maximum(np.cumsum(letters != ord("I")) - 1, 0)
        places = np.flatnonzero(letters != ord("D"))
        letters, row = letters[places], row[places]
        # roles alternate from the first one on, but for a system row at the start
        system = entry == 0 and len(places) > 0 and letters[0] == ord("K") and codes[row[0]] & 3 == 0
        due = (np.arange(len(places)) - int(system) + (entry == 2)) % 2
        return places, numbers[row], due, letters == ord("I"), letters == ord("K")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roles = pa.array(["user", "assistant"])

        def joined(batch: pa.RecordBatch, pieces: list[int], found: list[tuple]) -> pa.RecordBatch:
            piece = pa.array(np.repeat(pieces, [len(f[0]) for f in found]))
            places, numbers, due, new, kept = (np.concatenate(x) for x in zip(*found))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id").take(piece),
                    batch.column("piece").take(piece),
                    pa.array(places),
                    pa.array(numbers, mask=new),
                    roles.take(pa.array(due, mask=kept)),
                ],
                ["conv_id", "piece", "place", "row", "new_role"],
            )

        for batch in batches:
            pieces, found, n = [], [], 0
            given = zip(*(batch.column(c).to_pylist() for c in ("audit", "codes", "rows", "entry")))
            for i, (audit, codes, rows, entry) in enumerate(given):
                pieces.append(i)
                found.append(of_piece(audit, codes, rows, entry))
                n += len(found[-1][0])
                if n >= BLOCK or i + 1 == len(batch):
                    yield joined(batch, pieces, found)
                    pieces, found, n = [], [], 0

    fields = [T.StructField("conv_id", kind), *T.StructType.fromDDL("piece long, place long, row long, new_role string").fields]
    return pieces.select("conv_id", "piece", "entry", "codes", "rows", "audit").transform(mapped, edit, T.StructType(fields))


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A report per conversation that has rows (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) and the
    repaired rows (conv_id, piece and place for their order, row, role, text)."""
    rows, marked = _ordered(turns)
    pieces = _pieces(marked)
    edges = pieces.where("edge")
    solved = pieces.where("NOT edge").withColumn("entry", F.lit(0).cast("long")).drop("edge", "crossing")
    picked = _joined_up(edges).join(edges.select("piece", "codes", "rows"), "piece")
    pieces = stored(solved.unionByName(picked), "solved")
    in_order = F.array_sort(F.collect_list(F.struct("piece", "audit")))
    paths = pieces.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(F.transform(in_order, lambda x: x["audit"]), "").alias("audit")
    )
    turn = F.col("turn")
    faults = {"blank": BLANK, "duplicate": DUPLICATE, "truncated": CUT}
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).alias("gaps"),
        *[F.count_if(F.col("fault") == n).alias(name) for name, n in faults.items()],
    )
    edits = stored(_edits(pieces), "edits")
    inserted = edits.where("row IS NULL").select("conv_id", "piece", "place", "row", F.col("new_role").alias("role"), F.lit("").alias("text"))
    others = edits.where("row IS NOT NULL").join(rows.select("row", "role", "text"), "row")
    others = others.select("conv_id", "piece", "place", "row", F.coalesce("new_role", "role").alias("role"), "text")
    return merged("conv_id", paths, counts), others.unionByName(inserted)


def merged(key: str, *tables: DataFrame) -> DataFrame:
    """Tables with a row per ``key`` side by side, null keys too."""
    every = tables[0]
    for more in tables[1:]:
        every = every.unionByName(more, allowMissingColumns=True)
    return every.groupBy(key).agg(*[F.max(c).alias(c) for c in every.columns if c != key])


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its rows as ``role:text``, joined by line ends."""
    kind = repaired.schema["conv_id"].dataType
    tasks = int(repaired.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, keys = None, None, None
        for batch in batches:
            done = []
            keys = batch.column("conv_id").slice(0, 0)
            for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if sha is None or conv != now:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(line.encode())
            yield _two(done, keys.type)
        if sha is not None:
            yield _two([(now, sha.hexdigest())], keys.type)

    fields = [T.StructField("conv_id", kind), T.StructField("repaired_sha256", T.StringType())]
    lines = repaired.select("conv_id", "piece", "place", F.concat_ws(":", "role", "text").alias("line"))
    ordered = lines.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "piece", "place")
    return ordered.select("conv_id", "line").transform(mapped, hashed, T.StructType(fields))


def _two(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], type=kind), pa.array([r[1] for r in rows], type=pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with faults by a hash of conversation and turn: of 20 rows one is lost, one emptied, one without
    sentence ends, one repeated and one given to the user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    marked = turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return marked.where("times > 0").withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("time", "times")

"""Dedup of long substrings on suffix arrays of shards, by induced sorting.

Every byte covered by a string of ``length`` bytes that also starts in a document with a smaller
doc_id is removed. The strings of a text are dealt by content: the key of a string is the
least hash of the runs of ``GRAM`` bytes in it, so equal strings have one key. Neighbouring strings
of one key make a segment. Keys that lie in one document alone go no further; the segments of
the others are sorted into shards by key. Alike segments are one; those of a shard whose key has another one
too make one text, whose suffix array comes by induced sorting and is cut into intervals of equal strings
by comparing neighbours. The smallest doc_id of an interval decides which of
its places are removed.

A key of more segments than a shard may hold is dealt over several shards; each tells
its intervals with their places, and the smallest doc_id is taken over the shards' intervals of equal
strings. Texts travel only as segments: slices of the table are files in the shared folder, which
tasks read again for what concerns them.

* null text: empty, nothing to remove; so are texts of fewer than ``length`` bytes
* null doc_id: counts as larger than all others, and not as smaller than another null
* rows that repeat a doc_id: remove nothing from each other; equal texts: the smallest id keeps its own
* strings that overlap themselves or others: each is judged on the input
* empty table: no rows; very long texts: a slice of their own; ids are whole numbers
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.files import NewFile, opened
from medallion.llm.store import binary, mapped, release, slices, stored
from medallion.llm.suffixes import differing, suffix_array
from medallion.llm.words import U64, mixed
from medallion.session import scratch_dir

LENGTH = 50
#: Bytes whose hash may become a key; strings of one segment.
GRAM, RUN = 16, 64
#: Bytes of texts in a slice file; bytes of segments sorted at once; segments of a key in one shard.
SLICE, SHARD, PIECE = 4 << 20, 3 << 20, 32768
#: Strings whose keys are found at once.
BLOCK = 1 << 14
_LAST = np.iinfo(np.int64).max

Segments = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each starts and the last ends."""
    column = binary(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def least_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """For every string of ``length`` bytes the least hash of its runs of ``GRAM`` bytes, in blocks that stay in a core's cache."""
    gram = min(GRAM, length)
    width = length - gram + 1
    strings = len(data) - length + 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data), "<u8", padded, strides=(1,))  # the eight bytes from every place on
    out = np.empty(strings, dtype=U64)
    for low in range(0, strings, BLOCK):
        high = min(low + BLOCK, strings)
        n = high - low + width - 1
        least = np.full(n, gram, dtype=U64)
        for i in range(low, low + gram - 7, 8):
            least = mixed(least ^ eight[i : i + n])
        for i in range(low + gram - gram % 8, low + gram):
            least = mixed(least ^ padded[i : i + n].astype(U64))
        step = 1
        while 2 * step <= width:
            least, step = np.minimum(least[:-step], least[step:]), 2 * step
        if width > step:
            least = np.minimum(least[: step - width], least[width - step :])
        out[low:high] = least
    return out


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> Segments:
    """Key, text number, first byte and number of strings of every segment, in order of the texts."""
    if len(data) < length:
        return np.empty(0, U64), *[np.empty(0, np.int64)] * 3
    least = least_hashes(data, length)
    begins, stops = offsets[:-1], np.maximum(offsets[1:] - (length - 1), offsets[:-1])
    new = np.empty(len(least), dtype=bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[begins[begins < stops]] = True
    for i in range(length - 1):  # strings that would end in the next text
        beyond = offsets[1:] - 1 - i
        new[beyond[(beyond >= begins) & (beyond < len(new))]] = False
    first = np.flatnonzero(new)
    if not len(first):
        return np.empty(0, U64), *[np.empty(0, np.int64)] * 3
    text = np.searchsorted(offsets, first, side="right") - 1
    counts = np.minimum(np.append(first[1:], len(least)), stops[text]) - first
    pieces = -(-counts // RUN)
    if pieces.max() > 1:
        whole = np.repeat(np.arange(len(first)), pieces)
        number = np.arange(len(whole)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, text, counts = first[whole] + RUN * number, text[whole], np.minimum(counts[whole] - RUN * number, RUN)
    return mixed(least[first] + U64(1)), text, first, counts


def cut_out(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    places = np.repeat((starts - offsets[:-1]).astype(np.int32), sizes) + np.arange(offsets[-1], dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[places])])


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    return keys.astype("<u8").tobytes() + counts.astype("<i4").tobytes()


def unpacked(pack: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(pack) // 12
    return np.frombuffer(pack, "<u8", n), np.frombuffer(pack, "<i4", n, 8 * n)


def _written(docs: DataFrame) -> tuple[str, DataFrame]:
    """Slice files with doc_id and text of consecutive rows, and the stored list of their numbers."""
    folder = scratch_dir(docs.sparkSession, "llm-slices")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            file = NewFile(folder, str(number))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for part in held:
                    out.write_batch(part)
            file.write(sink.getvalue())
            file.close()
            return pa.RecordBatch.from_arrays([pa.array([number])], ["slice"])

        for batch in batches:
            for part in slices([batch], "text"):
                columns = [part.column("doc_id").cast(pa.int64()), binary(part.column("text"))]
                held.append(pa.RecordBatch.from_arrays(columns, ["doc_id", "text"]))
                size += held[-1].column("text").nbytes
                if size >= SLICE:
                    yield flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield flush()

    listed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(mapped, write, "slice long")
    return folder, stored(listed, "slices")


def _read(folder: str, number: int) -> Iterator[pa.RecordBatch]:
    with opened(f"{folder}/{number}") as file, pa.ipc.open_stream(file) as reader:
        yield from reader


def _parts(folder: str, number: int, length: int) -> Iterator[tuple]:
    """For each batch of a slice: number of its first text, doc_ids, bytes, offsets, segments."""
    first = 0
    for batch in _read(folder, number):
        data, offsets = texts_of(batch.column("text"))
        ids = pc.fill_null(batch.column("doc_id"), _LAST).to_numpy()
        yield first, ids, data, offsets, segments(data, offsets, length)
        first += len(batch)


def _shared(folder: str, listed: DataFrame, length: int, tasks: int) -> DataFrame:
    """For each slice the keys that more than one document has, with the shards that each is dealt over."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys of a slice by bucket; a count below 0 tells that several documents of the slice have the key."""
        for batch in batches:
            for number in batch.column("slice").to_pylist():
                parts = [(found[0], ids[found[1]]) for _, ids, _, _, found in _parts(folder, number, length)]
                key, doc = (np.concatenate(x) for x in zip(*parts))
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
                after = np.append(first[1:], len(key)) if len(key) else first
                key, n = key[first], np.where(doc[first] != doc[after - 1], first - after, after - first)
                bucket = ((key >> U64(32)) * U64(tasks) >> U64(32)).astype(np.int32)
                cuts = np.searchsorted(bucket, np.arange(tasks + 1))
                there = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(there.astype(np.int32)),
                        pa.array(np.full(len(there), number)),
                        pa.array([packed(key[cuts[b] : cuts[b + 1]], n[cuts[b] : cuts[b + 1]]) for b in there], type=pa.binary()),
                    ],
                    ["bucket", "slice", "keys"],
                )

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, pack in zip(batch.column("slice").to_pylist(), batch.column("keys")):
                key, n = unpacked(pack.as_py())
                columns = [key.view(np.int64), np.full(len(key), number), n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "slice", "n"])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by key; a key's rows, one per slice at most, are judged together."""
        for part in whole_groups(batches, 1 << 16):
            key, number, n = (part.column(i).to_numpy() for i in range(3))
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            rows = np.diff(np.append(first, len(key)))
            wanted = (rows > 1) | (np.minimum.reduceat(n, first) < 0)
            pieces = -(-np.add.reduceat(np.abs(n).astype(np.int64), first) // PIECE)
            wanted, pieces = np.repeat(wanted, rows), np.repeat(pieces, rows)
            wanted = np.flatnonzero(wanted)
            wanted = wanted[np.argsort(number[wanted], kind="stable")]
            key, number, pieces = key[wanted].view(U64), number[wanted], pieces[wanted]
            each, starts = np.unique(number, return_index=True)
            ends = np.append(starts[1:], len(number))
            packs = [packed(key[a:b], pieces[a:b]) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(each), pa.array(packs, type=pa.binary())], ["slice", "keys"])

    return (
        listed.repartition(tasks, "slice")
        .transform(mapped, keys, "bucket int, slice long, keys binary")
        .repartitionById(tasks, "bucket")
        .transform(mapped, flat, "key long, slice long, n int")
        .sortWithinPartitions("key")
        .transform(mapped, several, "slice long, keys binary")
        .repartition(tasks, "slice")
        .groupBy("slice")
        .agg(F.collect_list("keys").alias("keys"))
    )


def whole_groups(batches: Iterator[pa.RecordBatch], rows: int, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """Runs of about ``rows`` rows (or ``size`` bytes) in which no value of the first column goes on in the next run."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        if (sum(b.nbytes for b in held) < size) if size else (sum(map(len, held)) < rows):
            continue
        joined = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        key = joined.column(0).to_numpy()
        cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        if cut:
            yield joined.slice(0, cut)
        held = [joined.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _segment_rows(folder: str, shared: DataFrame, length: int) -> DataFrame:
    """Segments of the shared keys; ``place`` is text number and first byte, a slice's number is inverted for a dealt key."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packs in zip(batch.column("slice").to_pylist(), batch.column("keys").to_pylist()):
                wanted, dealt = (np.concatenate(x) for x in zip(*map(unpacked, packs)))
                order = np.argsort(wanted)
                wanted, dealt = wanted[order], dealt[order]
                for first, ids, data, offsets, (key, text, at, n) in _parts(folder, number, length):
                    place = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                    kept = np.flatnonzero(wanted[place] == key)
                    key, text, at, n, place = (x[kept] for x in (key, text, at, n, place))
                    pieces = dealt[place].astype(U64)
                    mix = mixed(at.astype(U64) + mixed(U64(number) + (first + text).astype(U64)))
                    shard = np.where(pieces > 1, U64(1) + mix % pieces, U64(0)).astype(np.int32)
                    for low in range(0, len(kept), 8192):
                        part = slice(low, low + 8192)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(mixed(key[part] + mixed(shard[part].astype(U64))).view(np.int64)),
                                pa.array(ids[text[part]]),
                                pa.array(np.where(shard[part] > 0, ~number, number)),
                                pa.array((first + text[part]) << 32 | (at[part] - offsets[text[part]])),
                                cut_out(data, at[part], n[part] + length - 1),
                            ],
                            ["shard", "doc", "slice", "place", "bytes"],
                        )

    return shared.transform(mapped, cut, "shard long, doc long, slice long, place long, bytes binary")


def ranges_by_slice(number: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Slices, and for each of them its texts' numbers with the first byte removed and the first byte after it."""
    order = np.argsort(number, kind="stable")
    each, starts = np.unique(number[order], return_index=True)
    rows = np.stack([text, low, high], axis=1).astype("<i4")[order]
    packs = [rows[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(rows)))]
    return [pa.array(each), pa.array(packs, type=pa.binary())]


def _judged(rows: DataFrame, length: int, tasks: int) -> DataFrame:
    """Removed ranges by slice; of dealt keys the intervals, with all their places, instead."""
    place = np.dtype([("doc", "<i8"), ("slice", "<i8"), ("text", "<i4"), ("at", "<i4")])
    schema = pa.schema(
        [("slice", pa.int64()), ("ranges", pa.binary()), ("string", pa.binary()), ("first", pa.int64()), ("places", pa.binary())]
    )

    def closed(number: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
        columns = ranges_by_slice(number, text, low, high)
        nulls = [pa.nulls(len(columns[0]), schema.field(i).type) for i in (2, 3, 4)]
        return pa.RecordBatch.from_arrays([*columns, *nulls], schema=schema)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, 0, SHARD):
            doc, number, spot = (part.column(i).to_numpy() for i in range(1, 4))
            is_open = number < 0
            number, text, at = np.where(is_open, ~number, number), spot >> 32, spot & 0xFFFFFFFF
            found = part.column("bytes").dictionary_encode()
            of = found.indices.to_numpy()
            earliest = np.full(len(found.dictionary), _LAST)
            np.minimum.at(earliest, of, doc)
            # alike segments are one; a key's only one has nothing to be sorted with
            key, dealt = np.empty(len(earliest), dtype=np.int64), np.zeros(len(earliest), dtype=bool)
            key[of], dealt[of] = part.column(0).to_numpy(), is_open
            _, which, several = np.unique(key, return_inverse=True, return_counts=True)
            sorts = (several[which] > 1) | dealt
            lengths = pc.binary_length(found.dictionary).to_numpy()
            whole = np.flatnonzero(~sorts[of] & (doc > earliest[of]))
            yield closed(number[whole], text[whole], at[whole], at[whole] + lengths[of[whole]])
            rest = np.flatnonzero(sorts[of])
            if not len(rest):
                continue
            is_open, doc, number, text, at = (x[rest] for x in (is_open, doc, number, text, at))
            of, earliest = (np.cumsum(sorts) - 1)[of[rest]], earliest[sorts]
            data, offsets = texts_of(found.dictionary.filter(pa.array(sorts)))
            sizes = np.diff(offsets)
            # all segments in one text, each ended by a symbol below all bytes
            ends = offsets[1:] + np.arange(1, len(sizes) + 1)
            joined = np.zeros(len(data) + len(sizes), dtype=np.int16)
            joined[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data.astype(np.int16) + 1
            sa = suffix_array(joined, 257)
            segment = np.repeat(np.arange(len(sizes)), sizes + 1)
            is_string = (ends[segment] - 1 - np.arange(len(joined)) >= length)[sa]
            strings = sa[is_string]
            # what is shorter than a string stands between no two that are equal
            cuts = np.flatnonzero(differing(joined.astype(np.uint8), strings, length))
            counts = np.diff(np.append(cuts, len(strings)))
            first = np.minimum.reduceat(earliest[segment[strings]], cuts)
            # smallest doc_id and interval of every string, strings of a segment in a row
            order = np.argsort(strings)
            least, which = np.repeat(first, counts)[order], np.repeat(np.arange(len(cuts)), counts)[order]
            held = sizes - length + 1
            begin = np.cumsum(held) - held
            low, high = np.minimum.reduceat(least, begin), np.maximum.reduceat(least, begin)
            whole = np.flatnonzero(~is_open & (doc > high[of]))
            yield closed(number[whole], text[whole], at[whole], at[whole] + sizes[of[whole]])
            some = np.flatnonzero(is_open | ((doc > low[of]) & (doc <= high[of])))
            for part_low in range(0, len(some), 16384):
                some_part = some[part_low : part_low + 16384]
                n = held[of[some_part]]
                row = np.repeat(some_part, n)
                shift = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                string = begin[of[row]] + shift
                gone = np.flatnonzero(~is_open[row] & (least[string] < doc[row]))
                # neighbouring strings of a row make one range
                new = np.ones(len(gone), dtype=bool)
                new[1:] = np.diff(gone) != 1
                new[1:] |= row[gone[1:]] != row[gone[:-1]]
                starts = np.flatnonzero(new)
                stops = np.append(starts[1:], len(gone))[: len(starts)] - 1
                r = row[gone[starts]]
                yield closed(number[r], text[r], at[r] + shift[gone[starts]], at[r] + shift[gone[stops]] + length)
                opened_ones = np.flatnonzero(is_open[row])
                if len(opened_ones):
                    r = row[opened_ones]
                    places = np.empty(len(r), dtype=place)
                    places["doc"], places["slice"], places["text"] = doc[r], number[r], text[r]
                    places["at"] = at[r] + shift[opened_ones]
                    of_interval = which[string[opened_ones]]
                    by = np.argsort(of_interval, kind="stable")
                    places, of_interval = places[by], of_interval[by]
                    each, starts = np.unique(of_interval, return_index=True)
                    stops = np.append(starts[1:], len(places))
                    source = strings[cuts[each]]
                    values = cut_out(data, source - segment[source], np.full(len(each), length))
                    packs = pa.array([places[a:b].tobytes() for a, b in zip(starts, stops)], type=pa.binary())
                    nulls = [pa.nulls(len(each), schema.field(i).type) for i in range(2)]
                    yield pa.RecordBatch.from_arrays([*nulls, values, pa.array(first[each]), packs], schema=schema)

    columns = "slice long, ranges binary, string binary, first long, places binary"
    return (
        rows.repartition(tasks, "shard").sortWithinPartitions("shard").transform(mapped, judge, columns)
    )


def _of_dealt_keys(judged: DataFrame, length: int) -> DataFrame:
    """Removed ranges of the keys that several shards hold."""
    place = np.dtype([("doc", "<i8"), ("slice", "<i8"), ("text", "<i4"), ("at", "<i4")])

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packs = [np.frombuffer(p, dtype=place) for p in batch.column("places").to_pylist()]
            if packs:
                rows = np.concatenate(packs)
                rows = rows[rows["doc"] > np.repeat(batch.column("least").to_numpy(), [len(p) for p in packs])]
                columns = ranges_by_slice(rows["slice"], rows["text"], rows["at"], rows["at"] + length)
                yield pa.RecordBatch.from_arrays(columns, ["slice", "ranges"])

    dealt = judged.where("string IS NOT NULL")
    least = stored(dealt.groupBy("string").agg(F.min("first").alias("least")), "strings")
    both = dealt.select("string", "places").join(least, "string").select("least", "places")
    return both.transform(mapped, later, "slice long, ranges binary")


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes ``kept`` of every row of ``docs`` (doc_id, text)."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folder, listed = _written(docs)
    # stored, so that the shuffles of the keys are gone before that of the segments
    shared = stored(_shared(folder, listed, length, tasks), "shared-keys", cleaned=True)
    judged = stored(_judged(_segment_rows(folder, shared.repartition(tasks, "slice"), length), length, tasks), "judged", cleaned=True)
    release(shared)
    ranges = judged.where("string IS NULL").select("slice", "ranges").unionByName(_of_dealt_keys(judged, length))
    ranges = ranges.unionByName(listed.select("slice", F.lit(b"").alias("ranges")))

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packs in zip(batch.column("slice").to_pylist(), batch.column("ranges").to_pylist()):
                text, low, high = np.frombuffer(b"".join(packs), "<i4").reshape(-1, 3).T.astype(np.int64)
                first = 0
                for part in _read(folder, number):
                    here = (text >= first) & (text < first + len(part))
                    yield without(part, low[here], high[here], text[here] - first)
                    first += len(part)

    grouped = ranges.repartition(tasks, "slice").groupBy("slice").agg(F.collect_list("ranges").alias("ranges"))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    kind = docs.schema["doc_id"].dataType
    return grouped.transform(mapped, cleaned, out).withColumn("doc_id", F.col("doc_id").cast(kind))


def without(part: pa.RecordBatch, low: np.ndarray, high: np.ndarray, text: np.ndarray) -> pa.RecordBatch:
    """The texts of ``part`` without the bytes ``low`` to ``high`` of the numbered texts."""
    data, offsets = texts_of(part.column("text"))
    step = np.bincount(offsets[text] + low, minlength=len(data) + 1) - np.bincount(offsets[text] + high, minlength=len(data) + 1)
    gone = np.cumsum(step[: len(data)]) > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] |= gone[edges]
    upto = np.concatenate([[0], np.cumsum(gone)])[offsets]
    spans = np.concatenate([[0], np.cumsum(begins)])[offsets]
    left = pa.py_buffer((offsets - upto).astype(np.int64))
    kept = pa.Array.from_buffers(pa.large_binary(), len(part), [None, left, pa.py_buffer(data[~gone])])
    counts = [np.diff(offsets), np.diff(upto), np.diff(spans)]
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), *[pa.array(c.astype(np.int64)) for c in counts], kept.cast(pa.binary())],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
    )

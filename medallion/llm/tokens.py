"""Token ids in binary files: each document compressed by itself with one shared dictionary.

A file, all numbers little-endian:

    magic "TIDZ0001" | SHA-256 of the dictionary (32 bytes) | zstd frame per document ...
    | index: per document offset u64, compressed bytes u32, ids u32 | documents u64 | magic

A frame holds the ids as unsigned 32-bit integers, their bytes in planes (all lowest bytes first),
which compresses better; the dictionary is trained on arrays so serialised. A reader checks magic and
dictionary hash, seeks to the index at the end, and can decode any single document.

Files are in ascending order of doc_id, within and across them.

* null text: empty, so one end id; null doc_id: before all others
* equal doc_id: in the order of xxhash64 of their texts, then of the texts (a text is no range key)
* no documents: no files; very long texts are one frame each, encoded word by word
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medallion.llm.files import NewFile, opened
from medallion.llm.store import mapped, remembered, sampled, slices, stored
from medallion.llm.warc import train
from medallion.session import scratch_dir

MAGIC = b"TIDZ0001"
#: Of a document in the index: offset, compressed bytes, ids.
ENTRY, ENTRY_BYTES = "<QII", 16
END_ID = 1

#: Documented bounds: documents that train the dictionary, bytes of text of each, bytes of the dictionary, of a file.
SAMPLE, SAMPLE_TEXT, DICTIONARY_BYTES, FILE_BYTES = 2000, 4096, 1 << 16, 64 << 20
#: Words whose ids a worker remembers, in each of two memories.
REMEMBERED = 200_000

#: Letters that are one character each in lower case and in normal form: those of ASCII and Latin-1.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_ALL_LETTERS = "".join(chr(c) for c in range(0x100) if re.match(f"[{_LETTERS}]", chr(c)))
_WORD, _ENDED = re.compile(f"[{_LETTERS}]+"), re.compile(f"[{_LETTERS}0-9]")
_TAIL = ".,;:!?"
#: Marks of ASCII that may end a word of such letters alone: the splitter takes a run of them as one piece.
_MARKS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())
_MARKED = f"^[{_LETTERS}]+[!-/:-@\\[-`{{-~]*$"
#: Characters that a byte-level vocabulary writes for bytes: printable ones stand for themselves, the others
#: for the characters from 256 on, in order.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
_BYTES = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(_OTHERS)}


class WordIds(dict):
    """Ids of a word as bytes (u32), each encoded once.

    The vocabulary's normaliser and splitter never look past white space, nor past punctuation that ends a word
    after a Latin letter or digit, so a text's ids are those of its words one after another. A full memory becomes
    the older one, where words that come again are found: only those that do not come for long are let go.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = self.tokenizer.model.tokenize
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        return self._kept(word, self._encoded(word) if ids is None else ids)

    def _kept(self, word: str, ids: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _encoded(self, word: str) -> bytes:
        if _WORD.fullmatch(word):
            return self._of_letters([word.lower()])[0]
        body = word.rstrip(_TAIL)
        if len(body) < len(word) and body and _ENDED.fullmatch(body[-1]):
            return self[body] + self[word[len(body) :]]
        return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters in lower case: there is nothing to normalise or to split, the model does alone."""
        pieces, out = self.pieces, []
        for word in words:
            ids = self.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    ids = _packed([t.id for t in pieces(word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES))])
                self._kept(word, ids)
            out.append(ids)
        return out

    def encode(self, text: bytes) -> bytes:
        (ids,) = self.encode_all(pa.array([text.decode()]))
        return ids.tobytes()

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text. Different words are looked up once: those of letters and marks by their letters in lower case."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        words = split.flatten().dictionary_encode()
        known, used = words.dictionary, words.indices.to_numpy()
        plain = pc.match_substring_regex(known, _MARKED)
        rest, marked = known.filter(pc.invert(plain)), known.filter(plain)
        letters = pc.utf8_lower(pc.ascii_rtrim(marked, characters=_MARKS)).dictionary_encode()
        marks = pc.utf8_ltrim(marked, characters=_ALL_LETTERS).dictionary_encode()
        lists = [column.to_numpy(zero_copy_only=False).tolist() for column in (letters.dictionary, marks.dictionary, rest)]
        units = [b"", *self._of_letters(lists[0]), *(self[word] if word else b"" for part in lists[1:] for word in part)]
        starts = 1 + np.cumsum([0, *map(len, lists)])
        # a word is two units: its letters and its marks, or itself and none
        plain, pairs = plain.to_numpy(zero_copy_only=False), np.zeros((len(known), 2), dtype=np.int64)
        pairs[plain, 0], pairs[plain, 1] = starts[0] + letters.indices.to_numpy(), starts[1] + marks.indices.to_numpy()
        pairs[~plain, 0] = starts[2] + np.arange(len(rest))
        sizes = np.fromiter(map(len, units), np.int64, len(units)) // 4
        ids = _gathered(np.frombuffer(b"".join(units), dtype="<u4"), sizes, pairs.ravel())
        sizes = sizes[pairs].sum(axis=1)
        ids, ends = _gathered(ids, sizes, used), np.append(0, np.cumsum(sizes[used]))
        bounds = ends[split.offsets.to_numpy()].tolist()
        return [ids[low:high] for low, high in zip(bounds, bounds[1:])]


def _gathered(values: np.ndarray, sizes: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The ``picked`` runs of ``values``, which are of ``sizes`` and lie one after another."""
    starts, taken = np.cumsum(sizes) - sizes, sizes[picked]
    ends = np.cumsum(taken)
    return values[np.repeat(starts[picked] - ends + taken, taken) + np.arange(ends[-1] if len(ends) else 0)]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def word_ids(path: str) -> WordIds:
    """One memory per worker."""
    return remembered("words", path, lambda: WordIds(path))


def planes(ids: bytes) -> bytes:
    return np.frombuffer(ids, dtype=np.uint8).reshape(-1, 4).T.tobytes()


def unplaned(data: bytes) -> bytes:
    return np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T.tobytes()


class TokenFile:
    """A file of token ids, open for reading: ``len``, and the ids of document i as bytes or array."""

    def __init__(self, file, dictionary: bytes):
        self.file = file
        head = file.read(40)
        if head[:8] != MAGIC:
            raise ValueError("not a file of token ids")
        if head[8:] != hashlib.sha256(dictionary).digest():
            raise ValueError("written with another dictionary")
        file.seek(file.size() - 16)
        tail = file.read(16)
        (count,) = struct.unpack("<Q", tail[:8])
        if tail[8:] != MAGIC or 56 + count * ENTRY_BYTES > file.size():
            raise ValueError("file cut short")
        file.seek(file.size() - 16 - count * ENTRY_BYTES)
        self.index = np.frombuffer(file.read(count * ENTRY_BYTES), dtype=[("offset", "<u8"), ("bytes", "<u4"), ("ids", "<u4")])
        self.decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def __len__(self) -> int:
        return len(self.index)

    def raw(self, i: int) -> bytes:
        at = self.index[i]
        self.file.seek(int(at["offset"]))
        ids = unplaned(self.decoder.decompress(self.file.read(int(at["bytes"]))))
        if len(ids) != 4 * at["ids"]:
            raise ValueError(f"document {i}: {len(ids) // 4} ids, the index has {at['ids']}")
        return ids

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self.raw(i), dtype="<u4")


def dictionary_of(docs: DataFrame, vocabulary: str, sample: int = SAMPLE) -> bytes:
    """Trained on the serialised ids of the first ``SAMPLE_TEXT`` characters of at most ``sample`` documents or so, picked by hash."""
    picked = sampled(docs.where("text IS NOT NULL").select("doc_id", F.substring("text", 1, SAMPLE_TEXT).alias("text")), "doc_id", sample)
    texts = sorted(r["text"] for r in picked.select("text").collect())
    known = word_ids(vocabulary)
    return train([planes(ids.tobytes()) for ids in known.encode_all(pa.array(texts, type=pa.string()))], DICTIONARY_BYTES)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, file_bytes: int = FILE_BYTES) -> tuple[DataFrame, str]:
    """Writes the ids of ``docs`` (doc_id, text) below ``folder``, an end id after each document.

    Returns the list of files in order (part, number, path, doc_ids, ids) and the dictionary's path.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dictionary = dictionary_of(docs, vocabulary)
    kept = NewFile(folder, "dictionary.zdict")
    kept.write(dictionary)
    path = kept.close()
    end = np.array([END_ID], dtype="<u4").tobytes()
    kind = docs.schema["doc_id"].dataType

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))
        known, part, number = word_ids(vocabulary), TaskContext.get().partitionId(), 0
        file, doc_ids, index, total = None, [], [], 0

        def closed() -> pa.RecordBatch:
            for entry in index:
                file.write(struct.pack(ENTRY, *entry))
            file.write(struct.pack("<Q", len(index)) + MAGIC)
            ids = pa.array([doc_ids], type=pa.list_(id_type))
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([number]), pa.array([file.close()]), ids, pa.array([total])], ["part", "number", "path", "doc_ids", "ids"]
            )

        for batch in slices(batches, "text"):
            id_type = batch.column("doc_id").type
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), known.encode_all(batch.column("text"))):
                if file is None:
                    file = NewFile(folder, f"tokens-{part:06d}-{number:04d}.tidz")
                    doc_ids, index, total = [], [], 0
                    file.write(MAGIC + hashlib.sha256(dictionary).digest())
                ids = found.tobytes() + end
                frame = coder.compress(planes(ids))
                index.append((file.written, len(frame), len(ids) // 4))
                file.write(frame)
                doc_ids.append(doc_id)
                total += len(ids) // 4
                if file.written >= file_bytes:
                    yield closed()
                    file, number = None, number + 1
        if file is not None:
            yield closed()

    ordered = docs.select("doc_id", "text").withColumn("hash", F.xxhash64("text"))
    # range keys are sampled to the driver, so no text is one
    ordered = ordered.repartitionByRange(tasks, "doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").drop("hash")
    schema = f"part long, number long, path string, doc_ids array<{kind.simpleString()}>, ids long"
    return stored(ordered.transform(mapped, write, schema, "words"), "tokens-list"), path


def read_tokens(files: DataFrame, dictionary_path: str) -> DataFrame:
    """A row per document of the listed files: doc_id, start (ids of all documents before it), n_tokens and the ids as bytes."""
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    parts = files.groupBy("part").agg(F.sum("ids").alias("ids"))  # a row per writing task
    bases = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    within = F.sum("ids").over(Window.partitionBy("part").orderBy("number")) - F.col("ids")
    placed = files.withColumn("inside", within).join(bases, "part").select("path", "doc_ids", (F.col("base") + F.col("inside")).alias("start"))
    with opened(dictionary_path) as file:
        dictionary = file.read()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, doc_ids, start in zip(batch.column("path").to_pylist(), batch.column("doc_ids"), batch.column("start").to_pylist()):
                with opened(path) as file:
                    tokens = TokenFile(file, dictionary)
                    if len(tokens) != len(doc_ids):
                        raise ValueError(f"{path}: {len(tokens)} documents, {len(doc_ids)} listed")
                    counts = tokens.index["ids"].astype(np.int64)
                    starts = start + np.cumsum(counts) - counts
                    for low in range(0, len(tokens), 500):
                        at = range(low, min(low + 500, len(tokens)))
                        yield pa.RecordBatch.from_arrays(
                            [doc_ids.values[low : at.stop], pa.array(starts[low : at.stop]), pa.array(counts[low : at.stop]), pa.array([tokens.raw(i) for i in at], type=pa.binary())],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )

    schema = f"doc_id {kind}, start long, n_tokens long, ids binary"
    return placed.repartition(tasks).transform(mapped, read, schema)


def tokenised(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Written, read back and digested: doc_id, start, n_tokens and ids_crc32."""
    files, dictionary = write_tokens(docs, scratch_dir(docs.sparkSession, "llm-tokens"), vocabulary)
    return read_tokens(files, dictionary).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

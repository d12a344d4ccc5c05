"""WARC archives in Zstandard: a dictionary in a leading skippable frame, one frame per record.

Written archives hold a ``response`` for each different payload (that of the smallest id) and a
``revisit`` without payload for each further page. The reader loads the dictionary from the
skippable frame, raw or itself compressed, decodes one frame at a time, and checks of each record
the version line, the mandatory headers, that the block is as long as ``Content-Length`` says,
the closing empty lines, and the digests of block and payload. A fault raises ``ArchiveError``
with file and offset, or is returned as a row.

* null html: an empty payload; null url: a record without target; null id: of a group, the response
  only if no page of it has an id
* rows that repeat an id and payload: all are responses, or all are revisits
* no pages: no archives; very long payloads are one frame each
* line ends in a url are percent-encoded
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.files import NewFile, opened
from medallion.llm.store import binary, mapped, sampled, stored
from medallion.session import scratch_dir

#: Fixed values of the formats.
DICTIONARY_MAGIC, FRAME_MAGIC = b"\x5d\x2a\x4d\x18", b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

#: Documented bounds: pages that train the dictionary, bytes of each, bytes of the dictionary, bytes of an archive.
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES, ARCHIVE_BYTES = 1000, 1 << 16, 1 << 16, 64 << 20
#: Bytes that the reader takes from a file at once.
READ = 1 << 20


class ArchiveError(ValueError):
    pass


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary trained on the samples; where they are too few to train, their bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def record(kind: str, page_id, url: str | None, date: str, payload: bytes, digest: str, refers_to=None) -> bytes:
    """A record as it stands in the archive before compression."""
    block = HTTP + payload if kind == "response" else HTTP
    head = [
        VERSION.decode(),
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{digest_of(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Headers (lower-case names), type, ids and payload of one record, checked."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/1."):
        raise ArchiveError("no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise ArchiveError(f"header without a colon: {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    missing = [name for name in MANDATORY if name not in headers]
    if missing:
        raise ArchiveError(f"without {', '.join(missing)}")
    if not headers["content-length"].isdecimal():
        raise ArchiveError("Content-Length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"block of {len(rest) - 4} bytes, Content-Length {length}")
    block = rest[:length]
    if headers.get("warc-block-digest", f"sha1:{digest_of(block)}") != f"sha1:{digest_of(block)}":
        raise ArchiveError("block digest differs")
    payload = block.partition(b"\r\n\r\n")[2] if headers["warc-type"] == "response" else None
    named = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if payload is not None and named not in ("", digest_of(payload)):
        raise ArchiveError("payload digest differs")
    return {"headers": headers, "type": headers["warc-type"], "payload": payload, "digest": named}


def _id(urn: str | None) -> str | None:
    return (urn or "").removeprefix("<urn:page:").removesuffix(">") or None


def frames(file) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every record frame of an archive, each decoded by itself with the dictionary.

    A dictionary frame further on starts an archive that was joined to the one before it, and counts from there.
    """
    decoder, data, at = zstandard.ZstdDecompressor(), file.read(READ), 0
    while data:
        while len(data) < 8 and (more := file.read(READ)):
            data += more
        if data[:4] == DICTIONARY_MAGIC:
            size = int.from_bytes(data[4:8], "little")
            while len(data) < 8 + size and (more := file.read(READ)):
                data += more
            held = data[8 : 8 + size]
            if len(data) < 8 + size:
                raise ArchiveError("dictionary cut short")
            if held[:4] == FRAME_MAGIC:
                held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
            decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
            at, data = at + 8 + size, data[8 + size :] or file.read(READ)
            continue
        frame, parts, start = decoder.decompressobj(), [], at
        while not frame.eof:
            if not data and not (data := file.read(READ)):
                raise ArchiveError(f"frame at {start} cut short")
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as error:
                raise ArchiveError(f"frame at {start}: {error}") from error
            at += len(data) - len(frame.unused_data)
            data = frame.unused_data
        yield start, b"".join(parts)
        data = data or file.read(READ)


def records(uri: str) -> Iterator[tuple[int, dict]]:
    with opened(uri) as file:
        for at, data in frames(file):
            try:
                yield at, parsed(data)
            except ArchiveError as error:
                raise ArchiveError(f"{uri}, record at {at}: {error}") from error


def dictionary_of(pages: DataFrame, sample: int = SAMPLE) -> bytes:
    """Trained on ``sample`` payloads or so, picked by hash, of at most ``SAMPLE_BYTES`` each."""
    html = F.substring(F.col("html").cast("binary"), 1, SAMPLE_BYTES).alias("html")
    picked = sampled(pages.where("html IS NOT NULL").select("page_id", html), "page_id", sample)
    return train(sorted(bytes(r["html"]) for r in picked.select("html").collect()))


def write_archives(pages: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) below ``folder``; returns the list of archives: path, records, bytes."""
    page = pages.select("page_id", "url", "html", F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("sha"))
    firsts = stored(page.groupBy("sha").agg(F.min("page_id").alias("first")), "warc-firsts")
    rows = page.join(firsts, "sha").select("page_id", "url", "html", "first")
    head = dictionary_of(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = zstandard.ZstdCompressionDict(head)
        coder = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        part, number, file, count = TaskContext.get().partitionId(), 0, None, 0
        done = []
        for batch in batches:
            payloads = binary(batch.column("html")).to_pylist()
            for page_id, url, first, payload in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "first")), payloads):
                if file is None:
                    file, count = NewFile(folder, f"pages-{part:06d}-{number:04d}.warc.zst"), 0
                    file.write(DICTIONARY_MAGIC + struct.pack("<I", len(head)) + head)
                again = first is not None and first != page_id
                kind = "revisit" if again else "response"
                file.write(coder.compress(record(kind, page_id, url, date, payload, digest_of(payload), first)))
                count += 1
                if file.written >= archive_bytes:
                    done.append((file.close(), count, file.written))
                    file, number = None, number + 1
        if file is not None:
            done.append((file.close(), count, file.written))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*done) if done else [[]] * 3, kinds)], names)

    names, kinds = ["path", "records", "bytes"], [pa.string(), pa.int64(), pa.int64()]
    return stored(rows.transform(mapped, write, "path string, records long, bytes long"), "warc-list")


def read_archives(archives: DataFrame, id_type: str = "long", faults: bool = False) -> DataFrame:
    """A row per record of the listed archives: page_id, record_type, refers_to, url, payload (null in a revisit) and
    digest. An archive that has a fault or not as many records as listed fails the job, or with ``faults`` ends with a
    row of type ``fault``, whose url says where."""
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([(c, pa.string()) for c in ("id", "record_type", "refers", "url")] + [("payload", pa.binary()), ("payload_digest", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                rows, size, count = [], 0, 0
                try:
                    for _, x in records(path):
                        h, count = x["headers"], count + 1
                        rows.append((_id(h["warc-record-id"]), x["type"], _id(h.get("warc-refers-to")), h.get("warc-target-uri"), x["payload"], x["digest"]))
                        size += len(x["payload"] or b"")
                        if size > READ << 2 or len(rows) >= 5000:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if count != expected:
                        raise ArchiveError(f"{path}: {count} records, {expected} listed")
                except ArchiveError as error:
                    if not faults:
                        raise
                    rows.append((None, "fault", None, str(error), None, None))
                if rows:
                    yield batch_of(rows)

    found = archives.select("path", "records").repartition(tasks).transform(
        mapped,
        read, "id string, record_type string, refers string, url string, payload binary, payload_digest string"
    )
    return found.select(
        F.col("id").cast(id_type).alias("page_id"), "record_type", F.col("refers").cast(id_type).alias("refers_to"), "url", "payload", "payload_digest"
    )


def archived(pages: DataFrame) -> DataFrame:
    """Writes all pages, reads them back, and returns per record page_id, record_type, refers_to, payload_digest and
    payload_bytes; those of a revisit are its response's."""
    listed = write_archives(pages.select("page_id", "url", "html"), scratch_dir(pages.sparkSession, "llm-warc"))
    found = read_archives(listed, pages.schema["page_id"].dataType.simpleString())
    narrow = stored(
        found.select("page_id", "record_type", "refers_to", "payload_digest", F.octet_length("payload").cast("long").alias("own_bytes")), "warc-records"
    )
    lengths = narrow.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("of")).agg(F.max("own_bytes").alias("full"))
    lengths = stored(lengths, "warc-lengths")
    return narrow.join(lengths, F.col("payload_digest") == F.col("of"), "left").select(
        "page_id",
        F.coalesce("own_bytes", "full").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )

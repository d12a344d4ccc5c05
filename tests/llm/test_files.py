from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from conftest import rows_of
from pyspark.sql import functions as F

from medallion.llm import tokens, warc
from medallion.llm.files import NewFile, opened
from medallion.llm.queries import vocabulary_path

import brute


@pytest.fixture(scope="module")
def pages():
    out = [(i, f"http://h{i % 7}.org/{i}", f"<html><p>page {i % 40} text</p></html>" * (1 + i % 5)) for i in range(300)]
    return out + [(300, None, None), (301, "http://x/", ""), (302, "http://y/\r\nEvil: 1", "ünï\r\n\r\nWARC/1.1"), (303, "u", "x" * 3_000_000)]


def test_archives_round_trip(spark, pages):
    table = spark.createDataFrame([(i, u, h, 1) for i, u, h in pages], "page_id long, url string, html string, first int").repartition(3)
    found = warc.archived(table).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows_of(found) == brute.warc([(i, h) for i, _, h in pages])
    assert warc.archived(table.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(1, "u", "same"), (1, "u", "same"), (None, "u", "same"), (None, "u", "own"), (2, "u", "same")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = rows_of(warc.archived(table).select("page_id", "record_type", "refers_to"))
    assert got == sorted([(1, "response", None)] * 2 + [(2, "revisit", 1), (None, "revisit", 1), (None, "response", None)], key=repr)


def test_contents_and_small_archives(spark, pages, folder):
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    listed = warc.write_archives(table, folder, archive_bytes=20_000)
    assert listed.count() > 2 and listed.agg(F.sum("records")).first()[0] == len(pages)
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(listed).where("record_type = 'response'").collect()}
    assert all((html or "") == got[i] for i, _, html in pages if i in got) and len(got) == len({h or "" for _, _, h in pages})


def archive(folder: str, name: str, *frames: bytes, dictionary: bytes | None = b"WARC/1.1\r\nWARC-Type: response" * 4) -> str:
    file = NewFile(folder, name)
    if dictionary is not None:
        file.write(warc.DICTIONARY_MAGIC + struct.pack("<I", len(dictionary)) + dictionary)
    known = None
    if dictionary is not None:
        raw = zstandard.ZstdDecompressor().decompress(dictionary) if dictionary[:4] == warc.FRAME_MAGIC else dictionary
        known = zstandard.ZstdCompressionDict(raw)
    for data in frames:
        file.write(zstandard.ZstdCompressor(dict_data=known).compress(data))
    return file.close()


GOOD = warc.record("response", 1, "http://a/", "2000-01-01T00:00:00Z", b"hello", warc.digest_of(b"hello"))


def test_reader_takes_raw_compressed_and_no_dictionary(folder):
    packed = zstandard.ZstdCompressor().compress(b"WARC/1.1\r\n" * 30)
    for n, dictionary in enumerate((b"WARC/1.1\r\n" * 30, packed, None)):
        uri = archive(folder, f"{n}.warc.zst", GOOD, GOOD, dictionary=dictionary)
        assert [x["payload"] for _, x in warc.records(uri)] == [b"hello"] * 2


def test_reader_takes_archives_joined_end_to_end(folder):
    other = warc.record("response", 2, "http://b/", "2000-01-01T00:00:00Z", b"bye" * 50, warc.digest_of(b"bye" * 50))
    heads = (b"WARC/1.1\r\n" * 30, zstandard.ZstdCompressor().compress(b"Content-Length: " * 20), None, b"http://" * 40)
    parts = [archive(folder, f"part{n}.warc.zst", GOOD, other, dictionary=head) for n, head in enumerate(heads)]
    for order in ((0, 1), (1, 0, 3), (2, 0), (0, 2), (3, 3)):
        whole = f"{folder}/joined{''.join(map(str, order))}.warc.zst"
        with open(whole, "wb") as out:
            for n in order:
                out.write(open(parts[n].removeprefix("file:"), "rb").read())
        found = list(warc.records(whole))
        assert [x["payload"] for _, x in found] == [b"hello", b"bye" * 50] * len(order)
        assert [at for at, _ in found] == sorted({at for at, _ in found})
    with open(f"{folder}/cut.warc.zst", "wb") as out:
        out.write(open(parts[2].removeprefix("file:"), "rb").read() + warc.DICTIONARY_MAGIC + b"\x40\0\0\0abc")
    with pytest.raises(warc.ArchiveError, match="dictionary cut short"):
        list(warc.records(f"{folder}/cut.warc.zst"))


@pytest.mark.parametrize(
    "bad, told",
    [
        (GOOD.replace(b"WARC/1.1", b"WRAC/1.1"), "no WARC header"),
        (GOOD.replace(b"WARC-Date: 2000-01-01T00:00:00Z\r\n", b""), "without warc-date"),
        (GOOD[:-4], "Content-Length"),
        (GOOD + GOOD, "Content-Length"),
        (GOOD.replace(b"hello", b"hullo"), "block digest"),
        (GOOD.replace(b"Content-Length: ", b"Content-Length: x"), "no number"),
        (GOOD.replace(b"WARC-Type: ", b"WARC-Type "), "without a colon"),
    ],
)
def test_reader_refuses(spark, folder, bad, told):
    uri = archive(folder, "bad.warc.zst", GOOD, bad)
    with pytest.raises(warc.ArchiveError, match=told):
        list(warc.records(uri))
    listed = spark.createDataFrame([(uri, 2)], "path string, records long")
    got = warc.read_archives(listed, faults=True).select("record_type", "url").collect()
    assert sorted(r[0] for r in got) == ["fault", "response"] and any(told in (r[1] or "") for r in got)


def test_reader_refuses_cut_files_and_other_counts(spark, folder):
    uri = archive(folder, "whole.warc.zst", GOOD)
    with opened(uri) as file:
        data = file.read()
    for n, cut in enumerate((data[:-3], data[:20])):
        file = NewFile(folder, f"cut{n}")
        file.write(cut)
        with pytest.raises(warc.ArchiveError, match="cut short"):
            list(warc.records(file.close()))
    listed = spark.createDataFrame([(uri, 2)], "path string, records long")
    assert {r["record_type"] for r in warc.read_archives(listed, faults=True).collect()} == {"fault", "response"}


TEXTS = [
    (1, None), (2, ""), (3, "It's, they'LL. don't! <|endoftext|> <|ENDOFTEXT|>a, x<|startoftext|>."), (4, "Ünë ﬁ Å A\u030a ΑΣ ΑΣ, İ"),
    (5, "a\x0bb\x0cc\rd\te\u00a0f\u2003g\x1cx"), (6, "12,345.67 %$# ... ,,, ?! 文字。漢"), (7, "word " * 5000), (7, "again"), (None, "no id"), (8, "x" * 5000),
]


def test_token_files_round_trip(spark):
    docs = [*TEXTS, *((100 + i, f"Some words, number {i}; and-more: \"quoted\" (text)!" * (i % 7)) for i in range(200))]
    table = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, start int").repartition(4)
    found = tokens.tokenised(table, vocabulary_path()).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert rows_of(found) == brute.tokens(docs, vocabulary_path())
    assert tokens.tokenised(table.limit(0), vocabulary_path()).count() == 0


def test_single_documents_and_checks(spark, folder):
    table = spark.createDataFrame([(i, f"text number {i} " * 20) for i in range(50)], "doc_id long, text string")
    files, dictionary = tokens.write_tokens(table, folder, vocabulary_path(), file_bytes=2000)
    listed = files.orderBy("part", "number").collect()
    assert len(listed) > 2 and [i for r in listed for i in r["doc_ids"]] == list(range(50))
    with opened(dictionary) as file:
        known = file.read()
    whole = {r["doc_id"]: np.frombuffer(r["ids"], "<u4") for r in tokens.read_tokens(files, dictionary).collect()}
    with opened(listed[1]["path"]) as file:
        held = tokens.TokenFile(file, known)
        for i, doc_id in enumerate(listed[1]["doc_ids"]):
            assert (held.ids(i) == whole[doc_id]).all()
        file.seek(0)
        with pytest.raises(ValueError, match="another dictionary"):
            tokens.TokenFile(file, b"other")
        file.seek(0)
        data = file.read()
    for n, (cut, told) in enumerate(((data[:-1], "cut short"), (b"x" + data[1:], "not a file"))):
        broken = NewFile(folder, f"broken{n}")
        broken.write(cut)
        with opened(broken.close()) as file, pytest.raises(ValueError, match=told):
            tokens.TokenFile(file, known)


def test_words_that_come_again_are_encoded_once(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 8)
    known, whole = tokens.WordIds(vocabulary_path()), tokens.WordIds(vocabulary_path())
    asked, pieces = [], known.pieces
    known.pieces = lambda text: asked.append(text) or pieces(text)
    text = " ".join(f"the The {a}{b}b." for a in "abcdefgh" for b in "cdefghij") + " \u00c9t\u00e9, caf\u00e9 d'or 12 $$$ l'\u00e9t\u00e9."
    ids = known.encode(text.encode())
    assert asked.count("the") == 1 and len(known) <= 8
    assert ids == np.array(whole.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_words_of_a_slice_are_looked_up_once_without_their_marks(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 2)
    known, whole = tokens.WordIds(vocabulary_path()), tokens.WordIds(vocabulary_path())
    asked, pieces = [], known.pieces
    known.pieces = lambda text: asked.append(text) or pieces(text)
    texts = [" ".join(f"{w}{m}" for m in ("", "***", "$$$", ",", "'", "?!", "#.") for w in ("one", "Two", "three", "Four", "ONE")), None, "", " \t", "four\ntwo <| x<|endoftext|> l'été"]
    found = known.encode_all(pa.array(texts).slice(0))
    assert [asked.count(w) for w in ("one", "two", "three", "four")] == [1] * 4
    for text, ids in zip(texts, found):
        assert ids.tolist() == whole.tokenizer.encode(text or "", add_special_tokens=False).ids

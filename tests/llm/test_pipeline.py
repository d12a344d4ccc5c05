"""The stages and the registered queries against brute force over whole small tables."""

from __future__ import annotations

import pytest
from conftest import rows_of

import corpus_pipeline
from medallion.llm import mixing, queries

import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_queries_against_brute_force(spark, documents):
    docs, found = texts_of(documents), queries.queries()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows_of(found["op1_near_dedup"](spark, SF)) == brute.near(docs)
    assert rows_of(found["op3_token_files"](spark, SF)) == brute.tokens(docs, queries.vocabulary_path())
    assert rows_of(found["op9_decontaminate"](spark, SF)) == brute.contaminated(docs, items)
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert rows_of(found["op2_warc"](spark, SF)) == brute.warc(pages)


def test_language_on_held_out_documents(spark, documents):
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = [r for r in queries.queries()["op5_language"](spark, SF).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.95 * len(rows)


def test_passages_cover_every_repeated_span(spark, documents):
    found, words = {}, {i: brute.lettered(t) for i, t in texts_of(documents)}
    for r in queries.queries()["op4_passages"](spark, SF).collect():
        found.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
        found.setdefault(r["of_doc_id"], []).append((r["of_start"], r["of_end"]))
    holders: dict[tuple, set] = {}
    for i, w in words.items():
        for j in range(len(w) - 49):
            holders.setdefault(tuple(w[j : j + 50]), set()).add(i)
    for i, w in words.items():
        for j in range(len(w) - 49):
            if len(holders[tuple(w[j : j + 50])]) > 1:
                assert any(a <= j + 3 and j + 47 <= b for a, b in found.get(i, [])), (i, j)


def test_stages(spark, documents):
    given, kept = documents, texts_of(documents)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES:
        out = queries.stored(stage(spark, given, SF), "test-stage")
        if name != "token files":
            assert out.columns == documents.columns
        if name == "language ID":
            assert out.count() >= 0.99 * given.count()
        if name == "near-dedup":
            assert sorted(i for i, _ in texts_of(out)) == sorted(i for i, _, _, keep in brute.near(kept) if keep)
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert sorted(i for i, _ in texts_of(out)) == sorted(i for i, *_, hit in brute.contaminated(kept, items) if not hit)
        if name == "mixing":
            taken = {r["doc_id"]: r["taken"] for r in mixing.mix(given).collect()}
            words: dict[int, int] = {}
            for i, text in texts_of(out):
                words[i] = words.get(i, 0) + len(brute.spaced(text))
            assert words == {i: n for i, n in taken.items() if n}
        if name == "token files":
            assert rows_of(out) == brute.tokens(kept, queries.vocabulary_path())
            break
        given, kept = out, texts_of(out)


def test_pipeline_over_strange_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row string"
    rows = [(1, None, None, None, None, 1.0, "r"), (2, "", "en", "s", 0, None, "r"), (None, "some words here", None, None, 3, 1.0, None)]
    rows += [(3, "words and words again here", "en", "s", 1, 1.0, "r")] * 2 + [(4, "other words of another kind", "en", "t", 1, 1.0, "r")]
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            table = queries.stored(stage(spark, table, SF), "test-stage")
        table.collect()

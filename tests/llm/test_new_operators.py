from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from medallion.llm import conversations, covertree, queries, substrings, suffixes

import brute


# ---- suffix arrays -----------------------------------------------------------


@pytest.mark.parametrize("few, short", [(1024, 1 << 17), (1024, 0), (4, 0), (0, 0)])
def test_suffix_arrays_and_permuted_prefixes(monkeypatch, few, short):
    monkeypatch.setattr(suffixes, "FEW_SYMBOLS", few)
    monkeypatch.setattr(suffixes, "SHORT", short)
    rng = random.Random(1)
    for case in range(400):
        size, symbols = rng.randrange(0, 60), rng.choice([1, 2, 3, 5, 20])
        text = [rng.randrange(symbols) for _ in range(size)]
        text = text[: max(1, size // 4)] * 4 if case % 3 == 0 else text
        found = suffixes.suffix_array(np.array(text, dtype=np.int16), symbols)
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert found.tolist() == order
        shared = suffixes.permuted_prefixes(np.array(text, dtype=np.int16), found)
        for before, at in zip(order, order[1:]):
            pairs = list(zip(text[before:], text[at:]))
            assert shared[at] == next((i for i, (a, b) in enumerate(pairs) if a != b), len(pairs))


def test_long_repetitive_text_recurses():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 200, 40_000)
    text = np.concatenate([part, part[::-1], part, rng.integers(0, 3, 20_000), part]).astype(np.int16)
    found = suffixes.suffix_array(text, 200)
    rank = np.empty(len(text) + 1, dtype=np.int64)
    rank[found], rank[len(text)] = np.arange(len(text)), -1
    left, right = found[:-1], found[1:]
    assert sorted(found.tolist()) == list(range(len(text)))
    assert ((text[left] < text[right]) | ((text[left] == text[right]) & (rank[left + 1] < rank[right + 1]))).all()


# ---- long substrings ---------------------------------------------------------

TEXTS = "doc_id long, text string, slice int, bytes string, key long"


def removed(docs):
    found = substrings.deduplicated(docs)
    return rows_of(found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words, passage = ["ab", "the", "xy", "\u00e9", "q"], " ".join(f"w{rng.randrange(500)}" for _ in range(30))
    out = [(1, None), (2, ""), (3, "a" * 500), (3, "a" * 500), (4, "a" * 120 + "b"), (None, "a" * 60), (None, "zz" * 80), (5, "zz" * 80)]
    out += [(10 + i % 50, " ".join(rng.choice(words) for _ in range(rng.randrange(80)))) for i in range(60)]
    for i in range(40):
        out.append((100 + i, "".join(rng.choice("abcdef") for _ in range(rng.randrange(60))) + passage + "".join(rng.choice("abcdef") for _ in range(60))))
    return out + [(200, passage * 40), (201, "x" + passage * 40)]


@pytest.mark.parametrize("piece, shard, of_slice", [(32768, 3 << 20, 4 << 20), (8, 3000, 2000)])
def test_removed_substrings(spark, texts, monkeypatch, piece, shard, of_slice):
    for name, value in (("PIECE", piece), ("SHARD", shard), ("SLICE", of_slice)):
        monkeypatch.setattr(substrings, name, value)
    docs = spark.createDataFrame([(*row, 1, "s", 7) for row in texts], TEXTS).repartition(5)
    assert removed(docs) == brute.substrings(texts)
    assert removed(docs.limit(0)) == []


def test_keys_are_gone_when_segments_are_judged(spark, texts, tmp_path, monkeypatch):
    monkeypatch.setattr("medallion.llm.store.scratch_dir", lambda _, label: f"{tmp_path}/{label}")
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {x for x in folder.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    before = shuffles()
    docs = spark.createDataFrame([(*row, 1, "s", 7) for row in texts], TEXTS)
    substrings.deduplicated(docs)
    assert {p.name for p in tmp_path.iterdir()} == {"llm-slices", "llm-judged", "llm-strings"}
    assert not [x for x in shuffles() - before if x.endswith(".data")]


def test_segments_hold_every_string_once():
    rng = random.Random(5)
    parts = ["".join(rng.choice("ab c") for _ in range(n)).encode() for n in (0, 49, 50, 51, 400, 3)] + [b"z" * 300]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, parts)])
    for length in (50, 20, 9):
        key, text, at, n = substrings.segments(data, offsets, length)
        strings = {(t, a + i): k for k, t, a, m in zip(key, text, at, n) for i in range(m)}
        assert len(strings) == n.sum() == sum(max(0, len(p) - length + 1) for p in parts) and n.max() <= substrings.RUN
        of: dict = {}
        for (t, a), k in strings.items():
            assert of.setdefault(bytes(data[a : a + length]), k) == k and offsets[t] <= a and a + length <= offsets[t + 1]


def test_keys_of_strings_are_found_in_small_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    data, offsets = rng.integers(97, 100, 1 << 20).astype(np.uint8), np.arange(0, (1 << 20) + 1, 1 << 10)
    tracemalloc.start()
    whole = substrings.segments(data, offsets, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * len(data)
    monkeypatch.setattr(substrings, "BLOCK", 1000)
    assert all((a == b).all() for a, b in zip(whole, substrings.segments(data, offsets, 50)))


@pytest.mark.parametrize("size", [1, 5, 8, 9, 16, 50])
def test_neighbours_that_differ(size):
    rng = np.random.default_rng(size)
    s = rng.integers(0, 2, 400).astype(np.uint8)
    s[200:330] = s[20:150]
    order = sorted(range(len(s) - size + 1), key=lambda i: bytes(s[i:]))
    texts = [bytes(s[i : i + size]) for i in order]
    found = suffixes.differing(s, np.array(order), size)
    assert found.tolist() == [True] + [a != b for a, b in zip(texts, texts[1:])]
    assert not len(suffixes.differing(s, np.empty(0, np.int64), size))


# ---- vector codes ------------------------------------------------------------


def codes(vectors):
    found, books = covertree.compressed(vectors)
    return sorted(((r.vec_id, r.code, r.error, r.label_error, covertree.digest(books)) for r in found.collect()), key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(1)
    out = [(i, [rng.choice([0.0, 0.1, 0.5, -0.3, 1.0]) for _ in range(32)], rng.choice([None, 1, 2])) for i in range(300)]
    out += [(1000 + i, [0.25] * 32, 3) for i in range(200)]
    out += [(2000, None, 1), (2001, [float("nan")] * 32, 1), (2002, [0.5] * 31 + [None], 1), (2003, [float("inf")] + [0.0] * 31, 1)]
    return out + [(5, [9.0] * 32, 7), (5, [9.0] * 32, 7)]


@pytest.mark.parametrize("leaf, of_slice", [(8, 4096), (1, 50)])
def test_codes_are_those_of_plain_lloyd(spark, vectors, monkeypatch, leaf, of_slice):
    monkeypatch.setattr(covertree, "LEAF", leaf)
    monkeypatch.setattr(covertree, "SLICE", of_slice)
    rows = spark.createDataFrame([(*r, "x", 1) for r in vectors], "vec_id long, embedding array<double>, label int, code string, v int").repartition(4)
    assert codes(rows) == brute.quantised(vectors)
    assert codes(rows.limit(0)) == [] and codes(rows.where("vec_id = 2000")) == []
    assert codes(rows.where("vec_id < 3")) == brute.quantised(vectors[:3])


def test_odd_vectors(spark):
    with pytest.raises(Exception, match="one size that 16 divides"):
        codes(spark.createDataFrame([(1, [0.5] * 15, 1)], "vec_id long, embedding array<double>, label int"))
    nameless = spark.createDataFrame([(None, [0.5] * 16, 1), (1, [0.25] * 16, None)], "vec_id long, embedding array<double>, label int")
    assert [r[1:4] for r in codes(nameless)] == [("00" * 16, 0, 0), ("01" * 16, 0, 0)]


def test_subtrees_go_whole_to_their_nearest_entry():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.integers(-20, 20, (300, 4)) + c for c in (0, 500, 2000)]).astype(np.int64)
    tree = covertree.cover_tree(points)
    assert sorted(tree.rows.tolist()) == list(range(900)) and (tree.points == points[tree.rows]).all()
    for i in range(len(tree.low)):
        inside = tree.points[tree.low[i] : tree.high[i]]
        assert np.sqrt(((inside - tree.centre[i]) ** 2).sum(axis=1)).max() <= tree.radius[i]
        kids = range(tree.child[i], tree.child[i] + tree.children[i])
        assert not kids or sum(tree.high[k] - tree.low[k] for k in kids) == tree.high[i] - tree.low[i]
    entries = np.array([[0] * 4, [500] * 4, [2000] * 4, [2000] * 4], dtype=np.int64)
    to, sums, counts, compared = covertree.assigned(tree, entries)
    plain = ((tree.points[:, None] - entries) ** 2).sum(axis=2).argmin(axis=1)
    assert (to == plain).all() and counts.tolist() == [300, 300, 300, 0] and compared < 900
    assert (sums[:3] == [tree.points[plain == k].sum(axis=0) for k in range(3)]).all()


# ---- conversations -----------------------------------------------------------


def repaired(spark, turns, folder):
    turns.write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    return rows_of(queries.op11_conversations(spark, folder))


@pytest.fixture(scope="module")
def turns():
    rng, out = random.Random(1), []
    texts = ["Hi.", "ok", "", " \t", None, "a b!", "x? ", "\u00fcnd.", "."]
    for c in range(300):
        for t in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "Uu"])
            out.append((c or None, rng.choice([t, t, t, t + 5, None, -t]), role, rng.choice(texts)))
    for t in range(2000):
        out.append((7777, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"w{t}.", f"w{t}", "same.", ""])))
    return out


@pytest.mark.parametrize("block", [65536, 64])
def test_conversations_are_repaired_at_least_cost(spark, turns, folder, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = spark.createDataFrame([(*r, 1, "x") for r in turns], "conv_id long, turn long, role string, text string, row long, audit string")
    assert repaired(spark, rows.repartition(5), folder) == brute.conversations(turns)


def test_no_conversations(spark, folder):
    assert repaired(spark, spark.createDataFrame([], "conv_id long, turn long, role string, text string"), folder) == []


def test_repaired_rows_follow_the_pattern(spark, turns):
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    report, found = conversations.repair(rows)
    roles: dict = {}
    for r in sorted(found.collect(), key=lambda r: (r["piece"], r["place"])):
        roles.setdefault(r["conv_id"], []).append(r["role"][:1])
    assert all("".join(x).removeprefix("s") == "ua" * (len("".join(x).removeprefix("s")) // 2) for x in roles.values())
    kept = {r["conv_id"]: len(r["audit"].replace("D", "")) for r in report.collect()}
    assert {c: n for c, n in kept.items() if n} == {c: len(x) for c, x in roles.items()}


# ---- whole small tables ------------------------------------------------------

SF = "/root/testdata/sf0.001"


def test_queries_against_brute_force(spark):
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(queries.op12_substrings(spark, SF)) == brute.substrings(documents)
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert rows_of(queries.op11_conversations(spark, SF)) == brute.conversations([tuple(r) for r in rows])
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    assert rows_of(queries.op13_vector_codes(spark, SF)) == brute.quantised([tuple(r) for r in rows])

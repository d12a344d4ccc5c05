from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from medallion.llm import decontaminate, exact, language, lines, mixing, near, passages, reputation
from medallion.llm.store import CLEANED, stored
from medallion.llm.words import LETTERED, SPACED, grams, words_of

import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, score double"


def prose(seed: int, n: int, size: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    base, long = prose(1, 120), prose(2, 30_000, 20_000)
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  two"), (5, "One  two"), (6, "ünë ß 文字 ok")]
    out += [(10 + i, edited(base, i, 0.02)) for i in range(30)] + [(50, base), (51, base.upper()), (None, base)]
    out += [(60, long), (61, edited(long, 3, 0.01)), (62, prose(5, 300)), (63, prose(6, 5)), (64, prose(6, 4))]
    return out + [(70 + i, f"{prose(9, 60)} {prose(100 + i, 25)}") for i in range(20)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None, None if n % 3 else f"s{n % 5}", None, 7, "k", 0.5) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_are_those_of_the_pattern(texts):
    column = pa.array([t for _, t in texts])
    for flags, split in ((SPACED, brute.spaced), (LETTERED, brute.lettered)):
        found = words_of(column, flags)
        words = [w for _, t in texts for w in split(t)]
        assert np.diff(found.bounds).tolist() == [len(split(t)) for _, t in texts]
        by_word: dict[str, int] = {}
        for word, value in zip(words, found.hashes.tolist()):
            assert by_word.setdefault(word, value) == value
        assert len(set(by_word.values())) == len(by_word)
    assert len(grams(found.hashes[:3], 5)) == 0


def test_words_longer_than_a_step_and_slices():
    column = pa.array(["x" * 3_000_000 + " y", "Y", None, "y"]).slice(1)
    found = words_of(pa.array(["x" * 3_000_000 + " y"]), SPACED)
    assert len(found.hashes) == 2 and found.hashes[1] == words_of(column, SPACED).hashes[0]
    assert np.diff(words_of(column, SPACED).bounds).tolist() == [1, 0, 1]


def test_near_duplicates(docs, texts, nothing):
    assert rows_of(near.near_duplicates(docs)) == brute.near(texts)
    assert rows_of(near.near_duplicates(docs, few=2, block=4)) == brute.near(texts)
    assert near.near_duplicates(nothing).count() == 0


def test_chunk_keys_find_all_pairs_within_reach():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**32, (1, near.CHUNKS * near.WIDTH), dtype=np.uint64)
    for reach in (1, near.CHUNKS * (near.ERRORS + 1) - 1):
        for _ in range(200):
            other = one.copy()
            other[0, rng.choice(other.shape[1], reach, replace=False)] += np.uint64(1)
            assert set(near.keys_of(one)[0].tolist()) & set(near.keys_of(other)[0].tolist())


def test_blocks_return_all_links_between_components():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**31, 60)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.93], rng.integers(0, 2**31, 4)])) for _ in range(40)]
    parts, sides = rng.integers(0, 4, 40), rng.integers(0, 2, 40)
    share = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    want = {(i, j) for i in range(40) for j in range(i) if parts[i] != parts[j] and sides[i] != sides[j] and share(sets[i], sets[j]) >= 0.75}
    assert want and {(max(p), min(p)) for p in near.linked(sets, parts, sides)} == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(7, 7)]
    found = dict(rows_of(near.components(spark.createDataFrame(edges, "a long, b long"))))
    assert {found[i] for i in range(1, 41)} == {1} and {found[i] for i in range(100, 130)} == {100}


def test_near_dedup_keeps_one_of_each_group(docs, texts):
    kept = [(r["doc_id"], r["text"], r["row"], r["key"]) for r in near.deduplicated(docs).collect()]
    groups = {c for _, n, c, _ in brute.near(texts) if n}
    assert sorted(i for i, t, *_ in kept if brute.spaced(t)) == sorted(groups)
    assert sum(not brute.spaced(t) for _, t, *_ in kept) == 3 and {k[2:] for k in kept} == {(7, "k")}


@pytest.mark.parametrize("options", [{}, {"capacity": 2, "max_depth": 6}, {"key_bits": 3, "capacity": 2, "max_depth": 6}])
def test_exact_dedup(docs, texts, nothing, options):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(exact.exact_dedup(docs, **options).select(*columns)) == brute.exact(texts)
    assert exact.exact_dedup(nothing, **options).count() == 0


def test_directory_splits_only_overfull_buckets():
    cells = np.array([9, 0, 0, 0, 1, 1, 1, 1])
    buckets, depths = exact.directory(cells, 4)
    assert buckets.tolist() == [0, 1, 2, 2, 4, 4, 4, 4] and depths.tolist() == [3, 3, 2, 2, 1, 1, 1, 1]
    assert exact.directory(np.zeros(8, int), 4)[0].tolist() == [0]


def test_colliding_keys_make_chains(docs):
    index = exact.build_index(docs, exact.keyed(docs, 1), key_bits=1)
    assert index.groupBy("key").agg(F.max("link").alias("m"), F.count("*").alias("n")).where("m + 1 <> n").count() == 0
    assert index.agg(F.max("link")).first()[0] > 5


def test_contamination(spark, docs, texts, nothing):
    base, extra = prose(1, 120).split(), prose(9, 60)
    items = [(1, " ".join(base[20:45])), (2, " ".join(base[:10])), (3, "one TWO"), (4, None), (5, "!?"), (6, extra), (6, extra), (None, "文字")]
    items += [(7, " ".join(base[50:59])), (8, "never there at all")]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, fp long")
    found = decontaminate.contamination(docs, table).select(
        "doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.concat_ws(",", "items"), 256).alias("sha"), F.col("n_hit") > 0
    )
    assert rows_of(found) == brute.contaminated(texts, items)
    assert decontaminate.contamination(nothing, table).count() == 0
    assert decontaminate.contamination(docs, table.limit(0)).where("n_hit > 0").count() == 0
    clean = decontaminate.uncontaminated(docs, table)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not hit for *_, hit in brute.contaminated(texts, items))


def test_winnowing_covers_every_span():
    hashes = np.random.default_rng(3).integers(0, 50, 500, dtype=np.uint64)
    chosen = decontaminate.winnowed(hashes, np.full(500, 500), 10, 5)
    assert all(chosen[i : i + 6].any() for i in range(491)) and not decontaminate.winnowed(hashes[:9], np.full(9, 9), 10, 5).any()


def brute_targets(sizes, weights, limit=3):
    low, high = 0.0, float(sum(sizes)) * 10 + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(limit * s, w * mid) for s, w in zip(sizes, weights)) < sum(sizes) else (low, mid)
    return [min(limit * s, w * high) for s, w in zip(sizes, weights)]


def test_targets_and_quotas():
    sizes = [100, 5, 0, 900, 40, 2000]
    assert mixing.targets(sizes) == pytest.approx(brute_targets(sizes, [1, 2, 3, 1, 2, 3]))
    goals, most = [5.0, 3.0, 1.0, 0.0], [100, 3, 100, 100]
    for seats in range(40):
        held = [0] * 4
        for _ in range(seats):
            free = [i for i in range(4) if goals[i] and held[i] < most[i]]
            held[max(free, key=lambda i: (goals[i] / (2 * held[i] + 1), -i))] += 1
        assert mixing.sainte_lague(goals, seats, most) == held


def test_permutation():
    for n in (1, 2, 3, 10, 1000):
        got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 77))
        assert sorted(got.tolist()) == list(range(n))


def test_mix(spark, docs, texts, nothing):
    found = mixing.mix(docs)
    rows = found.collect()
    assert rows_of(found) == rows_of(mixing.mix(docs.repartition(5)))
    assert sorted(r["size"] for r in rows) == sorted(len(brute.spaced(t)) for _, t in texts)
    assert all(r["taken"] <= 3 * r["size"] and sum(r["shard_words"]) == r["taken"] for r in rows)
    by_source: dict[int, list] = {}
    for r in rows:
        by_source.setdefault(r["source_size"], []).append(r)
    for size, own in by_source.items():
        assert sum(r["size"] for r in own) == size
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(2, 0.03 * own[0]["target"])
    assert sum({r["source_size"]: r["target"] for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))
    mixed = mixing.mixed_documents(docs)
    assert mixed.schema == docs.schema
    assert sum(len(brute.spaced(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in rows)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def taken_by_hand(rows, block, shards=16, seed=1):
    """(doc_id, words taken): every seat of a shard is dealt the next block of the source's permutation."""
    by_source: dict = {}
    for doc_id, source, text, slot in rows:
        by_source.setdefault(source, []).append((slot, doc_id, len(brute.spaced(text))))
    planned, _ = mixing.plan([(name, sum(n for *_, n in own)) for name, own in by_source.items()], block_words=block)
    taken = {}
    for source in planned:
        words = [d for _, d, n in sorted(by_source[source["source"]]) for _ in range(n)]
        cut = [words[i : i + block] for i in range(0, len(words), block)]
        n = len(cut)
        place = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, source["key"] * 1000003 + seed))
        deal = [cut[i] for i in np.argsort(place)]
        taken.update(dict.fromkeys((d for _, d, _ in by_source[source["source"]]), 0))
        for seat in range(sum(source["quotas"])):
            for d in deal[seat % n]:
                taken[d] += 1
    return sorted(taken.items())


def test_mix_with_a_source_of_ten_words(spark):
    rows = [(i, "abc"[i % 3], prose(i, 40 + i % 90)) for i in range(300)]
    rows += [(900, "tiny", prose(1, 10)), (901, None, prose(2, 100)), (902, "void", ""), (903, "void", None)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    slots = dict(table.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {mixing.SLOTS})").collect())
    for block in (mixing.BLOCK_WORDS, 7):
        found = mixing.mix(table, block_words=block).collect()
        want = taken_by_hand([(d, s, t, slots[d]) for d, s, t in rows], block)
        assert sorted((r["doc_id"], r["taken"]) for r in found) == want
        targets = {r["source_size"]: r["target"] for r in found}
        for size, target in targets.items():
            got = sum(r["taken"] for r in found if r["source_size"] == size)
            assert abs(got - target) <= max(block, 0.01 * target), (size, target, got)
    assert next(r["taken"] for r in found if r["doc_id"] == 900) % 10 == 0
    texts = {d: t or "" for d, _, t in rows}
    pieces = [(r["doc_id"], x) for r in mixing.mixed_documents(table).collect() for x in r["text"].split("\n")]
    assert all(x in texts[d] for d, x in pieces)
    short = [x for d, x in pieces if len(x.split(" ")) < min(mixing.BLOCK_WORDS, len(texts[d].split(" "))) // 4]
    assert len(short) < 0.2 * len(pieces)


def test_line_runs(spark, nothing):
    rng = random.Random(4)
    rows = [(i, "\n".join(f"line {rng.randrange(12)}" for _ in range(rng.randrange(30)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n\n"), (53, "a\r\nb"), (54, "a\r\nb"), (54, "a\r\nb"), (55, "x\n" * 500)]
    table = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, row string").coalesce(1)
    for m in (1, 2, 3, 5):
        cleaned, runs = lines.line_dedup(table, m)
        got = cleaned.select("doc.doc_id", "doc.text", "n_lines", "n_deleted").collect()
        assert sorted(((r[0], r[1]) for r in got), key=repr) == brute.line_runs(rows, m)
        assert sum(r["n_deleted"] for r in got) == runs.agg(F.sum("lines")).first()[0]
    assert lines.line_dedup(nothing)[0].count() == 0


def test_chains_pay_for_gaps():
    a, b = [0, 10, 20, 30, 500], [100, 110, 50, 130, 900]
    found = passages.chains(a, b)
    assert found == [[0, 1, 3]]
    assert passages.chains([0, 0, 5], [3, 9, 20]) == [[1, 2]] or passages.chains([0, 0, 5], [3, 9, 20]) == [[0, 2]]


def test_passages_far_apart_are_chains_of_their_own():
    near_, far = list(range(0, 200, 10)), list(range(900, 1100, 10))
    found = passages.chains(near_ + far, [x + 5 for x in near_] + [x - 100 for x in far])
    assert [len(x) for x in found] == [20, 20]


def test_alignment_counts_agreeing_words():
    x = np.arange(100, dtype=np.uint32)
    y = np.concatenate([np.arange(900, 907), x[:40], [1000, 1001], x[41:], [7]]).astype(np.uint32)
    start, end, of_start, of_end, same = passages.aligned(x, y, [10, 60], [17, 68])
    assert (start, of_start) == (0, 7) and same == 99 and end == 100
    assert passages.common([1, 2, 3, 4], [2, 9, 4]) == brute.common([1, 2, 3, 4], [2, 9, 4]) == 2


def test_passages(docs, texts, nothing):
    rows = passages.repeated_passages(docs).collect()
    assert all(r["doc_id"] > r["of_doc_id"] and min(r["end"] - r["start"], r["of_end"] - r["of_start"]) >= passages.MIN_WORDS for r in rows)
    words = {i: brute.lettered(t) for i, t in texts}
    for r in rows:
        x, y = words[r["doc_id"]][r["start"] : r["end"]], words[r["of_doc_id"]][r["of_start"] : r["of_end"]]
        if len(x) < 500:
            assert r["same"] <= brute.common(x, y) and r["same"] >= 0.8 * max(len(x), len(y))
    found = {r["doc_id"] for r in rows} | {r["of_doc_id"] for r in rows}
    assert found >= {*range(10, 40), 50, 60, 61, *range(70, 90)}
    assert not found & {1, 2, 3, 4, 5, 6, 62, 63, 64}
    assert passages.repeated_passages(nothing).count() == 0


def test_short_fuzzy_passages_are_found(spark):
    rng, rows, kinds = random.Random(8), [], {}
    for size, share in ((50, 0.05), (50, 0.10), (50, 0.15), (60, 0.10), (60, 0.15)):
        for i in range(60):
            text = prose(len(rows) + 1000, size, 10**6)
            other = " ".join(f"y{rng.randrange(10**6)}" if 0 < j < size - 1 and rng.random() < share else w for j, w in enumerate(text.split(" ")))
            if brute.common(text.split(" "), other.split(" ")) >= 0.82 * size:
                at = len(rows)
                kinds.setdefault((size, share), []).append((at + 1, at))
                rows += [(at, f"{prose(at + 3000, 40, 10**6)} {text} {prose(at + 4000, 40, 10**6)}"), (at + 1, f"{prose(at + 5000, 30, 10**6)} {other}")]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    pairs = {(r["doc_id"], r["of_doc_id"]) for r in found}
    for kind, wanted in kinds.items():
        assert len(pairs.intersection(wanted)) >= 0.97 * len(wanted), (kind, len(pairs.intersection(wanted)), len(wanted))


def test_passages_at_every_place_of_the_smallest_text(spark):
    part = prose(1, 60, 10**6)
    rows = [(1, f"{part} {prose(102, 80, 10**6)} {part}"), (2, f"{prose(3, 30, 10**6)} {part}"), (3, f"{part} {prose(4, 30, 10**6)}")]
    spans: dict[int, set] = {}
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        spans.setdefault(r["doc_id"], set()).add((r["start"], r["end"]))
        spans.setdefault(r["of_doc_id"], set()).add((r["of_start"], r["of_end"]))
    assert spans[1] == {(0, 60), (140, 200)} and spans[2] == {(30, 90)} and spans[3] == {(0, 60)}


def test_spans_name_both_sides_once(spark):
    part, whole = prose(1, 60, 10**6), prose(2, 70, 10**6)
    rows = [(1, f"{part} {prose(102, 80, 10**6)}"), (2, f"{prose(3, 30, 10**6)} {part}"), (3, f"{part} {prose(4, 30, 10**6)}"),
            (4, whole), (5, whole), (6, whole), (7, prose(5, 90, 10**6)), (None, part)]
    got = passages.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id IS NOT NULL").collect()
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in got) == [(1, 0, 60), (2, 30, 90), (3, 0, 60), (4, 0, 70), (5, 0, 70), (6, 0, 70)]
    assert {r["doc_id"]: (r["of_doc_id"], r["n_links"]) for r in got if r["doc_id"] > 3} == {4: (5, 2), 5: (4, 1), 6: (4, 1)}


def test_near_copies_are_chained_with_few_others(spark):
    rng, base = random.Random(4), prose(1, 200, 10**6).split(" ")
    rows = [(i, " ".join(f"y{rng.randrange(30)}" if rng.random() < 0.04 else w for w in base)) for i in range(150)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"] for r in got} | {r["of_doc_id"] for r in got} == set(range(150))
    assert len(got) <= 4 * len(rows)


def test_passages_are_never_listed_by_pair_and_leave_no_matches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("medallion.llm.store.scratch_dir", lambda _, label: f"{tmp_path}/{label}")
    part = prose(1, 60, 10**6)
    rows = [(1, f"{part} {prose(2, 80, 10**6)} {part}"), (2, f"{prose(3, 30, 10**6)} {part}"), (None, f"{part} {prose(4, 30, 10**6)}")]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = got._jdf.queryExecution().toString()
    assert "Generate" not in plan and "collect_list" not in plan
    assert {(r["doc_id"], r["start"], r["end"], r["of_doc_id"]) for r in got.collect()} == {(2, 30, 90, 1)}
    assert {p.name for p in tmp_path.iterdir()} == {"llm-passage-texts", "llm-passage-classes", "llm-passages"}


def test_passages_of_texts_that_repeat_a_pair_of_words_are_few(spark):
    rows = [(i, f"{prose(i, 20, 10**6)} {'left right ' * (100 + i)}{prose(100 + i, 20, 10**6)}") for i in range(1, 13)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    covered: dict[int, set] = {}
    for r in got:
        covered.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
        covered.setdefault(r["of_doc_id"], set()).update(range(r["of_start"], r["of_end"]))
    assert len(got) <= 8 * len(rows)
    assert all(covered[i].issuperset(range(20, 20 + 200)) for i in range(1, 13))


def test_passages_whose_pieces_smaller_texts_have(spark):
    for copies in (1, 3, 40):  # so many smaller texts have each piece: few and many partners of a seed
        shared = prose(7, 80, 10**6).split(" ")
        pieces = [" ".join(shared[a:b]) for a, b in ((0, 44), (20, 64), (36, 80))]
        rows = [(i, f"{prose(i + 10, 50, 10**6)} {pieces[i % 3]} {prose(i + 500, 50, 10**6)}") for i in range(3 * copies)]
        rows += [(900 + i, f"{prose(i + 2000, 30, 10**6)} {' '.join(shared)} {prose(i + 3000, 30, 10**6)}") for i in range(2)]
        got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
        spans = [(r["doc_id"], r["start"], r["end"], r["of_doc_id"], r["of_start"], r["of_end"]) for r in got]
        assert any(r[0] == 901 and r[3] == 900 and r[1] <= 30 and r[2] >= 110 for r in spans), (copies, spans)


def test_passages_of_frequent_lines_are_covered(spark):
    rng, lines_ = random.Random(11), [prose(20 + i, 14 + i % 9, 10**6).split(" ") for i in range(12)]
    words = {i: [w for _ in range(8) for w in rng.choice(lines_)] + [f"u{i}x{j}" for j in range(5)] for i in range(120)}
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in words.items()], "doc_id long, text string").repartition(3)
    found: dict[int, set] = {i: set() for i in words}
    for r in passages.repeated_passages(table).collect():
        found[r["doc_id"]].update(range(r["start"], r["end"]))
        found[r["of_doc_id"]].update(range(r["of_start"], r["of_end"]))
    holders: dict[tuple, set] = {}
    size = passages.MIN_WORDS
    for i, w in words.items():
        for j in range(len(w) - size + 1):
            holders.setdefault(tuple(w[j : j + size]), set()).add(i)
    for i, w in words.items():
        for j in range(len(w) - size + 1):
            if len(holders[tuple(w[j : j + size])]) > 1:
                assert found[i].issuperset(range(j, j + size)), (i, j)


def test_fuzzy_passages_of_phrases_that_many_texts_have(spark):
    phrases = [prose(40 + i, 9, 10**6) for i in range(6)]
    rows = [(i, f"{prose(i + 100, 60, 10**6)} {phrases[i % 6]} {prose(i + 900, 60, 10**6)}") for i in range(6 * 20)]
    rows += [(900 + i, f"{prose(i + 5000, 30, 10**6)} {' '.join(f'{x} v{i}x{j}' for j, x in enumerate(phrases))} end") for i in range(2)]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert [(r["doc_id"], r["of_doc_id"], r["start"], r["end"]) for r in got] == [(901, 900, 30, 89)]


def test_grams_of_few_places_are_matched_with_each_other():
    def found(texts: list[int]) -> set:
        places = np.zeros(len(texts), dtype=passages._places(1))
        places["text"], places["at"][:, 0] = texts, np.arange(len(texts))
        held: list[np.ndarray] = []
        batches = list(passages._matched(places, np.ones(len(texts), np.int32), held, True, False))
        packs = b"".join(r["pack"] for b in passages._packed(held, "text", 4) for r in b.to_pylist())
        assert len(np.frombuffer(packs, dtype=passages._places(1))) == (len(texts) if len(texts) > passages.FEW else 0)
        return {(r["text"], r["at"], r["other"], r["place"]) for b in batches for r in b.to_pylist()}

    assert found([7, 7, 7]) == found([]) == set()
    assert found([1, 1, 2, 3]) == {(2, 2, 1, 0), (2, 2, 1, 1), (3, 3, 1, 0), (3, 3, 1, 1), (3, 3, 2, 2)}
    many = found([1, 1, *range(2, 40)])
    assert many == {(i, i, 1, 0) for i in range(2, 40)} | {(1, 0, 39, 39), (1, 1, 39, 39)}


def test_matches_in_a_row_are_one_run():
    columns = np.array([[5, 1, 10, 30, 1, 0], [5, 1, 11, 31, 7, 0], [5, 1, 18, 38, 1, 0], [5, 1, 40, 60, 1, 0], [5, 1, 41, 70, 1, 1], [5, 2, 3, 3, 1, 0]]).T
    key, other, at, place, run = (x.astype(np.int64) for x in columns[:5])
    got = [tuple(map(int, r)) for r in zip(*passages.runs_of(key, other, at, place, run, columns[5] == 1))]
    assert got == [(5, 1, 10, 30, 9, 0), (5, 1, 40, 60, 1, 1), (5, 1, 41, 70, 1, 0), (5, 2, 3, 3, 1, 0)]


def test_covering_passages_cover_what_all_cover():
    rng = random.Random(6)
    for _ in range(300):
        found = [(a, a + rng.randrange(1, 20), b, b + rng.randrange(1, 20), 1) for a, b in ((rng.randrange(60), rng.randrange(60)) for _ in range(rng.randrange(12)))]
        kept = passages.covering(found)
        words = lambda rows, k: {w for x in rows for w in range(x[k], x[k + 1])}
        assert set(kept) <= set(found) and all(words(kept, k) == words(found, k) for k in (0, 2))
        assert sum(x[1] - x[0] for x in passages.covering([(x[0], x[1], 0, 20, 1) for x in found])) <= 2 * len(words(found, 0)) + 20


def test_stored_tables_may_free_their_shuffles(spark, tmp_path):
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {x for x in folder.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    before, rows = shuffles(), spark.range(1000).repartition(4, "id")
    assert sorted(r["id"] for r in stored(rows, "freed", cleaned=True).collect()) == list(range(1000))
    assert not shuffles() - before
    assert spark.conf.get(CLEANED, None) != "true"


def test_reputation_rules_and_levels(spark):
    urls = [None, "no scheme", "HTTP://A.Example.COM", "https://example.com/en/x?y=/z", "http://www.example.com/en/?q",
            "http://x.net/es/1", "http://bad.org/1", "ftp://x.net:80/es/", "a://b://c/d#e"]
    rows = [(i, u, 1.0) for i, u in enumerate(urls)] + [(100 + i, f"http://bad.org/{i}", 1.0) for i in range(50)]
    rows += [(200 + i, f"http://good{i % 9}.org/{i}", 1.0) for i in range(190)] + [(None, "http://bad.org/", 1.0), (1, "no scheme", 1.0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rate double")
    outcomes = [(100 + i, 1) for i in range(50)] + [(200 + i, 0) for i in range(190)] + [(6, None), (None, 1), (100, 0)]
    table = spark.createDataFrame(outcomes, "page_id long, bad int")
    got = {r["page_id"]: tuple(r)[1:] for r in reputation.filter_urls(pages, table).collect()}
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("a.example.com", "", None, "allow")
    assert got[3] == ("example.com", "/en/x", "example.com/en/", "block")
    assert got[4] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[5] == ("x.net", "/es/1", "net/es/", "block") and got[7] == ("x.net:80", "/es/", None, "allow")
    assert got[6][3] == got[120][3] == got[None][3] == "block" and got[200][3] == "allow"
    assert got[8][:2] == ("b:", "//c/d")
    assert {r["verdict"] for r in reputation.filter_urls(pages.where("page_id > 99"), table.limit(0)).collect()} == {"allow"}
    assert reputation.filter_urls(pages.limit(0), table).count() == 0
    plan = reputation.filter_urls(pages, table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_registries_ports_and_addresses(spark):
    hosts = ["a.b.example.co.uk", "example.co.uk", "co.uk", "x.y.ck", "www.ck", "z.www.ck", "10.0.0.1", "[::1]",
             "city.kobe.jp", "a.c.kobe.jp", "uk", "", "plain", "x.unknown"]
    rules = spark.createDataFrame([(r,) for r in ["co.uk", " UK ", "*.ck", "!www.ck", "jp", "*.kobe.jp", "!city.kobe.jp", "", None]], "rule string")
    sites = spark.createDataFrame([(h,) for h in hosts], "site string")
    got = {r["site"]: (r["domain"], r["suffix"]) for r in reputation.levels(sites, rules).collect()}
    assert got == {
        "a.b.example.co.uk": ("example.co.uk", "co.uk"), "example.co.uk": ("example.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"),
        "x.y.ck": ("x.y.ck", "y.ck"), "www.ck": ("www.ck", "ck"), "z.www.ck": ("www.ck", "ck"),
        "10.0.0.1": ("10.0.0.1", "[]"), "[::1]": ("[::1]", "[]"), "city.kobe.jp": ("city.kobe.jp", "kobe.jp"),
        "a.c.kobe.jp": ("a.c.kobe.jp", "c.kobe.jp"), "uk": ("uk", "uk"), "": ("", ""), "plain": ("plain", "plain"),
        "x.unknown": ("x.unknown", "unknown"),
    }
    pattern = {r["site"]: (r["domain"], r["suffix"]) for r in reputation.levels(sites).collect()}
    assert pattern["a.b.example.co.uk"] == ("example.co.uk", "co.uk") and pattern["10.0.0.1"] == ("10.0.0.1", "[]")
    named = ["x.net:80", "me@x.net", "u:p@x.net:8080", "x.net.", "[::1]:443", "10.0.0.1:80", "x.net", ":80", ""]
    found = spark.createDataFrame([(h,) for h in named], "host string").select("host", reputation.site_of(F.col("host")).alias("s"))
    assert {r["host"]: r["s"] for r in found.collect()} == dict(
        zip(named, ["x.net", "x.net", "x.net", "x.net", "[::1]", "10.0.0.1", "x.net", "", ""])
    )
    urls = [(i, f"http://bad.net:{8000 + i}/{i}") for i in range(40)] + [(99, "http://bad.net/")]
    urls += [(200 + i, f"http://fine{i % 7}.net/{i}") for i in range(200)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    outcomes = spark.createDataFrame([(i, 1) for i in range(40)] + [(200 + i, 0) for i in range(200)], "page_id long, bad int")
    for table in (None, rules):
        judged = {r["page_id"]: r["verdict"] for r in reputation.filter_urls(pages, outcomes, suffixes=table).collect()}
        assert judged[99] == judged[0] == "block" and judged[200] == "allow"


@pytest.fixture(scope="module")
def spoken(spark):
    syllables = {"aa": ["lo", "mi", "ra", "ne"], "bb": ["kst", "ur", "ög", "ent"], "cc": ["що", "ти", "ва", "ко"]}
    rng = random.Random(8)
    word = lambda lang: "".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4)))
    rows = [(i, " ".join(word(lang) for _ in range(rng.randrange(3, 80))), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 %% 3!", "cc"), (903, "lomi rane" * 3, None), (None, "kstur entög kstur", None)]
    return spark.createDataFrame([(i, t, x, 1.0, True) for i, t, x in rows], "doc_id long, text string, lang string, score double, rejected boolean")


def test_language(spark, spoken):
    known = language.train(spoken.where("doc_id % 4 <> 2"))
    assert known.languages == ["aa", "bb", "cc"]
    rows = language.measured(spoken.drop("score", "rejected"), known, ["doc_id", "lang"]).collect()
    told = {r["doc_id"]: r for r in rows}
    assert all(r["lang_pred"] == r["lang"] and 0.5 <= r["score"] <= 1 and not r["rejected"] for i, r in told.items() if i is not None and i < 900)
    assert all(told[i]["lang_pred"] == "und" and told[i]["score"] == 0 and told[i]["rejected"] for i in (900, 901, 902))
    assert told[903]["lang_pred"] == "aa" and told[None]["lang_pred"] == "bb"
    kept = language.recognised(spoken, known)
    assert kept.columns == spoken.columns and kept.count() == len(rows) - 3
    strange = spark.createDataFrame([(1, "zqxj wvyp hgfd " * 30)], "doc_id long, text string")
    assert language.measured(strange, known, ["doc_id"]).first()["rejected"]
    empty = language.train(spoken.where("false"))
    assert {r["lang_pred"] for r in language.measured(spoken.select("doc_id", "text"), empty, ["doc_id"]).collect()} == {"und"}
    assert language.measured(spoken.select("doc_id", "text").limit(0), known, ["doc_id"]).count() == 0


def test_language_is_calibrated_on_all_texts(spark):
    rng = random.Random(3)
    letters = {"aa": "abcdef", "bb": "cdefgh"}
    rows = [(i, lang, "".join(rng.choice(letters[lang]) for _ in range(rng.randrange(4, 30)))) for i in range(5000) for lang in [rng.choice("ab") * 2]]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    known = language.train(docs)
    own: dict[str, list] = {"aa": [], "bb": []}
    for r in language.measured(docs, known, ["lang"]).collect():
        own[r["lang"]].append(r["entropies"][known.languages.index(r["lang"])])
    for i, lang in enumerate(known.languages):
        assert known.deviations[i] == pytest.approx(np.std(own[lang]), rel=1e-9)
        assert known.means[i] in own[lang] and known.means[i] == pytest.approx(np.median(own[lang]), abs=1e-3)


def test_probabilities_sum_to_one():
    codes, _ = language.gram_codes(pa.array(["abra cadabra abracadabra", "barca"]))
    grams, n = np.unique(codes, return_counts=True)
    model = language.fitted(grams, n, 6)
    symbols = np.unique(grams & np.uint64(0xFFFF))
    for context in np.unique(grams >> np.uint64(16))[:10]:
        p = np.exp2(language.log_probability(model, (context << np.uint64(16)) | symbols)).sum()
        assert p == pytest.approx(1, abs=0.06) and p <= 1.0001
    few = language.log_probability(model, np.array([0x0078_0079_007A_0071], dtype=np.uint64))
    assert np.isfinite(few).all()


def test_memory_of_scored_grams_changes_nothing():
    codes, _ = language.gram_codes(pa.array([prose(1, 500)]))
    model = language.fitted(*np.unique(codes, return_counts=True), 12)
    scorer = language.Scorer([model, model])
    texts = pa.array([prose(i, 300) for i in range(5)] + ["", None])
    first = scorer.entropies(texts)[1]
    assert np.allclose(first, scorer.entropies(texts)[1]) and np.allclose(first, language.Scorer([model, model]).entropies(texts)[1])

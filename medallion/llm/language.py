"""Language ID by interpolated Kneser-Ney models of characters.

For each language the grams of four characters are counted over all its labelled texts. From the
counts come orders four to one: discounted counts at the top, discounted continuation counts (in how
many different grams of the next order a gram is the end) below, interpolated down to a uniform
base. A model is sorted arrays of gram codes with log2 probabilities, and of contexts with log2
back-off weights. A text gets the language of the lowest cross-entropy per character.

Characters: letters in lower case with their marks; each run of anything else is one blank. A code
is four numbers of 16 bits, so it is the gram itself; letters beyond the basic plane are hashed into
the range of surrogates.

Calibration, on all labelled texts: a temperature for the score, and for each
language a limit of cross-entropy, wider for shorter texts, above which a text is rejected: far outside
what the language's own texts have, and half way at least from there to that of random letters.

* null text, or one without a letter: ``und``, score 0, rejected
* null lang: not learned from; no labelled text at all: every text is ``und``
* equal cross-entropy: the language that sorts first
* very long texts are scored whole
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.store import binary, mapped, remembered, slices, stored
from medallion.llm.words import U64, mixed

BLANK, START = 32, 0
#: Documented bounds: grams in all models together (languages share them evenly; of each the most frequent are kept, by
#: powers of two of their count), languages.
MAX_GRAMS, MAX_LANGUAGES = 2_000_000, 256
#: Slots of a worker's memory of scored grams, as a power of two.
SLOT_BITS = 18

_tables: list[np.ndarray] = []


def _alphabet() -> np.ndarray:
    """Code of every character of the basic plane, and of each beyond it by its number modulo 2048."""
    if not _tables:
        table = np.full(sys.maxunicode + 1, BLANK, dtype=np.uint16)
        for i in range(len(table)):
            if unicodedata.category(chr(i))[0] in "LM":
                low = chr(i).lower()
                table[i] = ord(low[0]) if ord(low[0]) < 0x10000 else 0xD800 + ord(low[0]) % 2048
        _tables.append(table)
    return _tables[0]


def gram_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all grams of four, and the bounds of each text's; none for a text without a letter."""
    texts = binary(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    firsts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = firsts[offsets - offsets[0]]
    lengths = np.diff(bounds)
    n = len(lengths)
    chars = np.full(len(points) + 3 * n, BLANK, dtype=np.uint16)
    begin = bounds[:-1] + 3 * np.arange(n)
    chars[np.arange(len(points)) + np.repeat(3 * np.arange(n) + 2, lengths)] = _alphabet()[points]
    chars[begin] = chars[begin + 1] = START
    kept = np.ones(len(chars), dtype=bool)
    kept[1:] = (chars[1:] != BLANK) | (chars[:-1] != BLANK)
    held = np.concatenate([[0], np.cumsum(kept)])
    begin = held[np.concatenate([begin, [len(chars)]])]
    chars = chars[kept].astype(U64)
    if len(chars) < 4:
        return np.empty(0, U64), np.zeros(n + 1, dtype=np.int64)
    codes = (chars[:-3] << U64(48)) | (chars[1:-2] << U64(32)) | (chars[2:-1] << U64(16)) | chars[3:]
    counts = np.maximum(0, np.diff(begin) - 3)
    starts = np.concatenate([[0], np.cumsum(counts)])
    return codes[np.arange(starts[-1]) + np.repeat(begin[:-1] - starts[:-1], counts)], starts


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram and its count over all texts of ``docs`` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def summed(parts):
            codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            return codes, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

        def flushed():
            for lang, parts in held.items():
                codes, n = summed(parts)
                names = pa.array([lang]).take(pa.array(np.zeros(len(codes), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([names, pa.array(codes.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for part in slices(batches, "text"):
            langs = part.column("lang").dictionary_encode()
            index = langs.indices.to_numpy()
            codes, starts = gram_codes(part.column("text"))
            of = np.repeat(index, np.diff(starts))
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                parts = held.setdefault(lang, [])
                parts.append(np.unique(codes[of == i], return_counts=True))
                if len(parts) >= 8:
                    held[lang] = [summed(parts)]
            if sum(len(c) for parts in held.values() for c, _ in parts) > 4_000_000:
                yield from flushed()
        yield from flushed()

    partial = docs.select("lang", "text").transform(mapped, count, "lang string, gram long, n long")
    return stored(partial.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts")


class Model(NamedTuple):
    """Per order 1 to 4 sorted grams with log2 probability, sorted contexts with log2 weight; and the log2 base."""

    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    base: float


def _low(order: int) -> np.uint64:
    return U64((1 << 16 * order) - 1)


def fitted(codes: np.ndarray, n: np.ndarray, symbols: int) -> Model:
    order = np.argsort(codes)
    levels = [(codes[order], n[order])]
    for k in (3, 2, 1):
        levels.insert(0, np.unique(levels[0][0] & _low(k), return_counts=True))
    model = Model([], [], [], [], -np.log2(symbols + 1))
    lower = np.full(len(levels[0][0]), 1 / (symbols + 1))
    for k, (grams, counts) in enumerate(levels, 1):
        contexts, at = np.unique(grams >> U64(16), return_inverse=True)
        total, types = np.bincount(at, counts), np.bincount(at)
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = once / (once + 2 * twice) if 0 < once and 0 < twice else 0.75
        if k > 1:
            lower = np.exp2(model.logs[-1].astype(float))[np.searchsorted(model.grams[-1], grams & _low(k - 1))]
        weight = discount * types / total
        p = np.maximum(counts - discount, 0) / total[at] + weight[at] * lower
        for kept, value in zip(model, (grams, np.log2(p).astype(np.float32), contexts, np.log2(weight).astype(np.float32))):
            kept.append(value)
    return model


def log_probability(model: Model, codes: np.ndarray) -> np.ndarray:
    out, todo, grams = np.zeros(len(codes)), np.arange(len(codes)), codes
    for k in (4, 3, 2, 1):
        grams = grams & _low(k)
        at = np.minimum(np.searchsorted(model.grams[k - 1], grams), len(model.grams[k - 1]) - 1)
        known = model.grams[k - 1][at] == grams
        out[todo[known]] += model.logs[k - 1][at[known]]
        todo, grams = todo[~known], grams[~known]
        context = grams >> U64(16)
        at = np.minimum(np.searchsorted(model.contexts[k - 1], context), len(model.contexts[k - 1]) - 1)
        known = model.contexts[k - 1][at] == context
        out[todo[known]] += model.weights[k - 1][at[known]]
    out[todo] += model.base
    return out


class Scorer:
    """Models of all languages, and a memory of grams already scored."""

    def __init__(self, models: list[Model]):
        self.models = models
        self.keys = np.zeros(1 << SLOT_BITS, dtype=U64)
        self.rows = np.zeros((len(models), 1 << SLOT_BITS), dtype=np.float32)

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per text its number of grams, and cross-entropy per character of each language (bits)."""
        codes, starts = gram_codes(texts)
        counts = np.diff(starts)
        out = np.zeros((len(texts), len(self.models)))
        some = counts > 0
        if not some.any() or not self.models:
            return counts, out
        slot = (mixed(codes) >> U64(64 - SLOT_BITS)).astype(np.int32)
        missing = np.flatnonzero(self.keys[slot] != codes)
        if len(missing):
            fresh = np.unique(codes[missing])
            logs = np.stack([log_probability(m, fresh) for m in self.models]).astype(np.float32)
            at = (mixed(fresh) >> U64(64 - SLOT_BITS)).astype(np.int32)
            self.keys[at] = fresh
            place = np.searchsorted(fresh, codes[missing])
            for l, row in enumerate(self.rows):
                values = row[slot]
                values[missing] = logs[l][place]
                out[some, l] = np.add.reduceat(values, starts[:-1][some], dtype=np.float64)
                row[at] = logs[l]
            # of fresh grams that share a slot the last one stays, in keys as in rows
        else:
            for l, row in enumerate(self.rows):
                out[some, l] = np.add.reduceat(row[slot], starts[:-1][some], dtype=np.float64)
        return counts, -out / np.maximum(1, counts)[:, None]


class LanguageModels(NamedTuple):
    """Languages, their models, and what calibration found: temperature, mean and deviation of each one's entropy."""

    languages: list[str]
    models: list[Model]
    temperature: float
    means: np.ndarray
    deviations: np.ndarray

    def judged(self, counts: np.ndarray, entropies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score and whether it is rejected."""
        best = entropies.argmin(axis=1)
        least = entropies[np.arange(len(best)), best]
        odds = np.exp2(-self.temperature * counts[:, None] * (entropies - least[:, None]))
        uniform = np.array([-m.base for m in self.models])
        limits = np.maximum(self.means + 8 * self.deviations, (self.means + uniform) / 2)
        limit = limits[best] + 12 / np.sqrt(np.maximum(1, counts))
        return best, 1 / odds.sum(axis=1), least > limit


def train(docs: DataFrame, max_grams: int = MAX_GRAMS) -> LanguageModels:
    """Models of all languages in ``docs`` (doc_id, lang, text); rows without a language are left out."""
    docs = docs.select("doc_id", "lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    counted = gram_counts(docs)
    level = F.floor(F.log2("n")).cast("int")
    sizes: dict[str, dict[int, int]] = {}
    for r in counted.groupBy("lang", level.alias("level")).count().limit(64 * MAX_LANGUAGES + 1).collect():
        sizes.setdefault(r["lang"], {})[r["level"]] = r["count"]
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages, least = sorted(sizes), {}
    for lang in languages:
        room, least[lang] = max_grams // len(languages), 0
        for at in sorted(sizes[lang], reverse=True):
            room -= sizes[lang][at]
            if room < 0:
                least[lang] = at + 1
                break
    few = [lang for lang in languages if least[lang]]
    kept = counted
    if few:
        bound = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(least[lang])) for lang in few], F.lit(0))
        kept = counted.where(level >= bound)
    rows = kept.toArrow()  # max_grams rows at most
    lang, codes, n = rows["lang"].to_numpy(), rows["gram"].to_numpy().view(U64), rows["n"].to_numpy()
    symbols = len(np.unique(codes & _low(1)))
    models = [fitted(codes[lang == x], n[lang == x], symbols) for x in languages]
    blank = LanguageModels(languages, models, 1.0, np.zeros(len(models)), np.zeros(len(models)))
    if not models:
        return blank
    return calibrated(docs, blank)


def calibrated(docs: DataFrame, known: LanguageModels) -> LanguageModels:
    """``known`` with temperature, means and deviations taken from all of ``docs`` (lang, text)."""
    languages, grid = known.languages, 2.0 ** np.arange(-10, 1)

    def lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            truth = np.searchsorted(languages, batch.column("lang").to_pylist()).astype(np.int64)
            counts = batch.column("grams").to_numpy()
            entropies = batch.column("entropies").flatten().to_numpy().reshape(len(batch), len(languages))
            own = entropies[np.arange(len(truth)), truth]
            losses = [_loss(t, counts, entropies, truth) for t in grid]
            yield pa.RecordBatch.from_arrays([pa.array(truth), pa.array(own), *map(pa.array, losses)], ["at", "own", *names])

    names = [f"loss{i}" for i in range(len(grid))]
    scored = measured(docs, known, ["lang"]).where("grams > 0").select("lang", "grams", "entropies")
    lost_ = scored.transform(mapped, lost, ", ".join(["at long, own double", *[f"{n} double" for n in names]]), "language")
    # the median is a sketch of all texts; decimals add up alike in any order
    sums = [F.sum(F.col(n).cast("decimal(26,12)")).alias(n) for n in names]
    found = lost_.groupBy("at").agg(
        F.percentile_approx("own", 0.5, 100_000).alias("mean"), F.stddev_pop("own").alias("deviation"), *sums
    ).collect()  # a row per language
    means, deviations = np.array([-m.base for m in known.models]), np.zeros(len(known.models))
    for r in found:
        means[r["at"]], deviations[r["at"]] = r["mean"], r["deviation"]
    total = [sum(r[n] for r in found) for n in names]
    return known._replace(temperature=float(grid[total.index(min(total))]), means=means, deviations=deviations)


def _loss(temperature: float, counts: np.ndarray, entropies: np.ndarray, truth: np.ndarray) -> np.ndarray:
    bits = -temperature * counts[:, None] * (entropies - entropies.min(axis=1, keepdims=True))
    return np.log2(np.exp2(bits).sum(axis=1)) - bits[np.arange(len(truth)), truth]


def scorer_of(known: LanguageModels) -> Scorer:
    """One memory per worker and broadcast."""
    return remembered("language", id(known), lambda: (Scorer(known.models), known))[0]


def measured(docs: DataFrame, known: LanguageModels, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, the number of grams, and lang_pred, score, rejected and entropies."""
    sent = docs.sparkSession.sparkContext.broadcast(known)  # max_grams entries of at most 16 bytes an order

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        scorer, names = scorer_of(models), pa.array([*models.languages, "und"])
        for part in slices(batches, "text"):
            counts, entropies = scorer.entropies(part.column("text"))
            if models.languages:
                best, sure, rejected = models.judged(counts, entropies)
            else:
                best, sure, rejected = np.zeros(len(part), int), np.zeros(len(part)), np.ones(len(part), bool)
            none = (counts == 0) | ~np.array([any(map(str.isalpha, t)) if t else False for t in part.column("text").to_pylist()])
            none |= not models.languages
            best, sure, rejected = np.where(none, len(names) - 1, best), np.where(none, 0.0, sure), rejected | none
            lists = pa.ListArray.from_arrays(
                np.arange(len(part) + 1, dtype=np.int32) * len(models.languages), pa.array(entropies.ravel(), type=pa.float64())
            )
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in keep], pa.array(counts), names.take(pa.array(best)), pa.array(sure), pa.array(rejected), lists],
                [*keep, "grams", "lang_pred", "score", "rejected", "entropies"],
            )

    found = T.StructType.fromDDL("grams long, lang_pred string, score double, rejected boolean, entropies array<double>")
    given = docs.select(*[c for c in keep if c != "text"], "text")
    return given.transform(mapped, score, T.StructType([docs.schema[c] for c in keep] + found.fields), "language")


def recognised(docs: DataFrame, known: LanguageModels) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, all columns as they are."""
    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), "text")
    return measured(given, known, ["doc"]).where("NOT rejected").select("doc.*")

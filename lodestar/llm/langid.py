"""Language ID of mixed-language text: script ranges, then Viterbi over words.

Learn: hashed letter trigrams per language, counted in Spark tasks over a
bounded sample per language; only the (language, bucket) sums reach the driver.
Predict, per whole text: letters are grouped into words; a word's script
leaves the languages written in it as candidates; its trigrams score them; the
best label sequence under a switching penalty cuts the text into spans of one
language.  The answer is the language of most letters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import crc_remainder, hash60, ship, source_name

HOLD_OUT = (5, 0)  # crc32(doc_id) mod 5 = 0 is never learned from
PER_LANGUAGE = 1500  # bound of the learning sample, documents per language (expected number)
BUCKETS = 1 << 16
SWITCH = 6.0  # cost of a change of language, in nats
_FLOOR = -8.0  # least score of a word for a candidate language
_OUT = -40.0  # score of a language not written in the word's script
_CHARS = 2_000_000  # letters scored at once: bounds memory
_HELD = 128  # languages whose sums a task holds at once


def _chars(languages: int) -> int:
    """Letters scored at once: fewer of them for many languages."""
    return max(1, min(_CHARS, 16 * _CHARS // max(1, languages)))

# First and last code point of the blocks of each script (Unicode).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x139F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: is it a letter (or a mark inside a word); number of its script (0: other)."""
    size = 0x110000
    letter = np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(size)), bool, size)
    script = np.zeros(size, np.uint8)
    for i, ranges in enumerate(SCRIPTS.values(), 1):
        for lo, hi in ranges:
            script[lo:hi + 1] = i
    return letter, script


@lru_cache(1)
def _alpha() -> np.ndarray:
    size = 0x110000
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(size)), bool, size)


def _codes(text: str) -> np.ndarray:
    """Lower-cased code points, one per code point of ``text``."""
    low = text.lower()
    if len(low) != len(text):  # a few capitals lower to two code points
        low = "".join(c.lower()[0] for c in text)
    return np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")


def _words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of letters and marks that hold a letter), and the letter mask."""
    letter = _tables()[0][codes]
    edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(starts):
        real = np.add.reduceat(_alpha()[codes], starts) > 0
        starts, ends = starts[real], ends[real]
    return starts, ends, letter


def _grams(codes: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around every position; other characters count as word ends."""
    c = np.zeros(len(codes) + 2, np.uint32)
    c[1:-1] = np.where(letter, codes, 0)
    h = c[:-2] * np.uint32(0x9E3779B1) ^ (c[1:-1] * np.uint32(0x85EBCA77)) ^ (c[2:] * np.uint32(0xC2B2AE3D))
    h ^= h >> np.uint32(15)
    return (h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # (buckets, languages) float32
    written: np.ndarray  # (scripts + 1, languages) bool


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Trigram and script sums per language of one task (keys below BUCKETS: trigrams)."""
    sums: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pd.DataFrame]:
        for lang, acc in sums.items():
            keys = np.flatnonzero(acc)
            yield pd.DataFrame({"lang": lang, "key": keys, "n": acc[keys]})
        sums.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            if lang not in sums and len(sums) >= _HELD:
                yield from flush()
            acc = sums.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS) + 1, np.int64))
            codes = _codes(text)
            for at in range(0, len(codes), _CHARS):
                part = codes[at:at + _CHARS]
                letter = _tables()[0][part]
                acc[:BUCKETS] += np.bincount(_grams(part, letter)[letter], minlength=BUCKETS)
                acc[BUCKETS:] += np.bincount(_tables()[1][part][letter], minlength=len(SCRIPTS) + 1)
    yield from flush()


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learn every lang value, from the documents outside the held-out part that have a text and a lang."""
    ship(docs.sparkSession)
    mod, out = HOLD_OUT
    rows = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
            .filter("text is not null and lang is not null").filter(crc_remainder("doc_id", mod) != out))
    sizes = rows.groupBy("lang").count().orderBy("lang").collect()  # one row per language
    if not sizes:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    limit = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, per_language / r["count"]) * 2.0**60)])
    sample = rows.filter(hash60(F.col("doc_id")) < F.try_element_at(limit, F.col("lang"))).select("lang", "text")
    sums = sample.mapInPandas(_count, "lang string, key int, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    table = sums.toPandas()  # at most (buckets + scripts) x languages sums
    langs = tuple(sorted(table["lang"].unique()))
    counts = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(langs)))
    counts[table["key"], table["lang"].map({x: i for i, x in enumerate(langs)})] = table["n"]
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    logp = np.log((grams + 0.3) / (grams.sum(axis=0) + 0.3 * BUCKETS))
    logp -= logp.max(axis=1, keepdims=True)
    logp[grams.sum(axis=1) == 0] = 0
    written = scripts >= 0.01 * scripts.sum(axis=0)
    return LanguageModel(langs, logp.astype(np.float32), written)


def _emissions(model: LanguageModel, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends, scores (words x languages), and whether any learned language uses the script."""
    codes = _codes(text)
    starts, ends, letter = _words(codes)
    scores = np.zeros((len(starts), len(model.languages)), np.float32)
    grams = _grams(codes, letter)
    step = _chars(len(model.languages))
    # whole words, some of them at a time; a word beyond the bound is a step of its own
    cuts = np.unique(np.searchsorted(ends, np.arange(0, len(codes) + step, step)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, hi = starts[a], ends[b - 1]
        inside = np.column_stack((starts[a:b], ends[a:b])).ravel() - lo
        values = np.concatenate((model.weights[grams[lo:hi]], np.zeros((1, len(model.languages)), np.float32)))
        scores[a:b] = np.add.reduceat(values, inside, axis=0)[::2]
    allowed = model.written[_tables()[1][codes[starts]]]
    known = allowed.any(axis=1)
    scores[~allowed & known[:, None]] = _OUT
    scores[~known] = 0
    top = scores.max(axis=1, keepdims=True)
    scores -= top + np.log(np.exp(scores - top).sum(axis=1, keepdims=True))
    return starts, ends, np.where(scores > _OUT / 2, np.maximum(scores, _FLOOR), _OUT).astype(np.float32), known


def viterbi(scores: list[np.ndarray], penalty: float = SWITCH) -> list[np.ndarray]:
    """Best label of every word of several texts at once (texts step together, longest first)."""
    if not scores:
        return []
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    flat = np.concatenate([scores[i] for i in order])
    best, steps = np.zeros((len(order), flat.shape[1])), []
    for t in range(lengths[0] if len(lengths) else 0):
        active = int(np.searchsorted(-lengths, -t, "left"))  # texts longer than t
        prev = best[:active]
        top = prev.argmax(axis=1).astype(np.int32)
        jump = prev[np.arange(active), top] - penalty
        stay = prev >= jump[:, None]
        steps.append((top, stay))
        best[:active] = np.where(stay, prev, jump[:, None]) + flat[first[:active] + t]
    labels = np.zeros(len(flat), np.int32)
    now = best.argmax(axis=1)
    for t in range(len(steps) - 1, -1, -1):
        top, stay = steps[t]
        n = len(top)
        labels[first[:n] + t] = now[:n]
        now[:n] = np.where(stay[np.arange(n), now[:n]], now[:n], top)
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(order)
    for k, i in enumerate(order):
        out[i] = labels[first[k]:first[k] + lengths[k]]
    return out


def _label(model: LanguageModel, texts: list[str | None]) -> Iterator[tuple[str, float, list[dict]]]:
    return (found[:3] for found in _judge(model, texts))


def _judge(model: LanguageModel, texts: list[str | None]) -> Iterator[tuple[str, float, list[dict], float | None]]:
    """Language, score and spans; share of the letters whose script a learned language uses (None: no letters)."""
    if not model.languages:  # nothing was learned
        yield from (("und", 0.0, [], 0.0 if len(_words(_codes(t or ""))[0]) else None) for t in texts)
        return
    parts = [_emissions(model, t or "") for t in texts]
    for (starts, ends, scores, known), label in zip(parts, viterbi([p[2] for p in parts])):
        if not len(starts):
            yield "und", 0.0, [], None
            continue
        letters = np.where(known, ends - starts, 0)
        share = np.bincount(label, letters, len(model.languages))
        best = int(share.argmax())
        cut = np.flatnonzero(np.diff(label, prepend=-1.0))
        last = np.append(cut[1:], len(label)) - 1
        spans = [{"start": int(starts[a]), "end": int(ends[b]), "lang": model.languages[label[a]]} for a, b in zip(cut, last)]
        yield model.languages[best], float(share[best] / (ends - starts).sum()), spans, float(letters.sum() / (ends - starts).sum())


def language_column(text: Column, model: LanguageModel) -> Column:
    """struct(lang, score, spans, known) of a text column; spans are code-point ranges."""

    @F.pandas_udf("lang string, score double, spans array<struct<start:int,end:int,lang:string>>, known double")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            group, size = [], 0
            for text in batch:
                group.append(text)
                size += len(text or "")
                if size >= _chars(len(model.languages)):
                    rows += _judge(model, group)
                    group, size = [], 0
            rows += _judge(model, group)
            yield pd.DataFrame(rows, columns=["lang", "score", "spans", "known"])

    return identify(text)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans for every row of ``docs``.

    lang_pred is the learned language that labels most letters, score its
    share of all letters.  Null texts and texts without a letter: ``und``,
    score 0.  Letters of scripts that no learned language uses count for none.
    Ties go to the first language in alphabetical order.  A null doc_id counts
    as the empty id for ``held_out``; repeated rows get equal answers; other
    columns are ignored.  A text of any length is labelled whole: it is scored
    some words at a time, and the path keeps a few bytes per word and
    language.  An empty table gives an empty result, one without lang ``und``.
    """
    model = fit(docs, doc_id, text, lang, per_language)
    mod, out = HOLD_OUT
    return docs.select(F.col(doc_id).alias("doc_id"), language_column(F.col(text), model).alias("l")).select(
        "doc_id", (crc_remainder("doc_id", mod) == out).alias("held_out"),
        F.col("l.lang").alias("lang_pred"), "l.score", "l.spans")


def monolingual(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                least: float = 0.5, per_language: int = PER_LANGUAGE, unlearned: bool = False) -> DataFrame:
    """Rows of ``docs`` in which one learned language labels at least ``least`` of the letters.

    With ``unlearned``, letters that the model can't judge (of scripts that no
    learned language uses; all, if nothing was learned) speak against no row:
    the share is that of the other letters, and rows of such letters only stay.
    Null texts, and texts without a letter, go; repeated rows stay or go
    together; columns keep names and values; an empty table gives an empty one."""
    model = fit(docs, doc_id, text, lang, per_language)
    found = source_name(docs, "lang")
    lang, score, known = (F.col(f"{found}.{c}") for c in ("lang", "score", "known"))
    keep = known.isNotNull() & (score >= least * known) if unlearned else (lang != "und") & (score >= least)
    return docs.withColumn(found, language_column(F.col(text), model)).filter(keep).drop(found)

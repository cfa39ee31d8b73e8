"""Registered queries that SQL can't express, held against plain programs that see one text at a time."""

import hashlib
import math
import re
import unicodedata
import zlib

import pytest

from conftest import SMALL
from lodestar.llm import langid, packing, quality, queries


@pytest.fixture
def fitted(monkeypatch):
    """Models that a query learns while it runs, in order."""
    models = []
    for module in (quality, langid):
        def record(*args, _fit=module.fit, **kwargs):
            models.append(_fit(*args, **kwargs))
            return models[-1]

        monkeypatch.setattr(module, "fit", record)
    return models


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def statistics(text):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0d]+", data)
    if not words:
        return [0.0] * 20
    count = lambda pattern, where=data: len(re.findall(pattern, where))
    n, size = len(words), sum(len(w) for w in words)
    symbols = rb"[#$%&*+/<=>@\[\\\]^_`{|}~!]"
    lines = [x for x in data.split(b"\n") if x.strip()]
    joined = b" ".join(words) + b" "
    per = lambda hits: hits / n
    return [
        n, size / n, count(rb"[A-Z]") / max(1, count(rb"[A-Za-z]")),
        per(sum(len(w) > 1 and count(rb"[A-Z]", w) > 0 and count(rb"[a-z]", w) == 0 for w in words)),
        count(rb"[0-9]") / size, count(symbols) / size, per(sum(count(symbols, w) > 0 for w in words)),
        per(count(rb"!", joined)), per(count(rb"\|", joined)), per(count(rb"\. ", joined)),
        per(sum(words[i] == words[i + 1] for i in range(n - 1))), len(set(words)) / n, max(words.count(w) for w in set(words)) / n,
        len(lines), 1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), max(len(w) for w in words),
        count(rb"[^\x21-\x7e\x20\x09-\x0d]") / size, per(sum(len(w) <= 2 for w in words)), per(count(rb"[<{=]", joined))]


def test_op5_scores_every_text_by_its_rules(spark, documents, fitted):
    got = queries.op5_quality_rules(spark, SMALL).collect()
    model, = fitted
    assert sorted(r.doc_id for r in got) == sorted(documents) and model.rules
    for r in got:
        stats = statistics(documents[r.doc_id].text)
        total = model.intercept + sum(w for w, rule in model.rules if all(
            (stats[f] <= limit) if at_most else (stats[f] > limit) for f, at_most, limit in rule))
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
        assert r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def words_of(text):
    """(lower-cased code points or 0 at every position, words as lists of positions)."""
    low = [c.lower()[0] for c in text] if len(text.lower()) != len(text) else list(text.lower())
    kinds = [unicodedata.category(c)[0] for c in low]
    found, run = [], []
    for i, kind in enumerate([*kinds, "Z"]):
        if kind in "LM":
            run.append(i)
        elif run:
            if any(kinds[j] == "L" for j in run):
                found.append(run)
            run = []
    return [ord(c) if k in "LM" else 0 for c, k in zip(low, kinds)], [ord(c) for c in low], found


def bucket(a, b, c):
    h = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & 0xFFFFFFFF
    h ^= h >> 15
    return (h * 0x27D4EB2F & 0xFFFFFFFF) >> 16


def script_of(code):
    return next((i for i, ranges in enumerate(langid.SCRIPTS.values(), 1) if any(a <= code <= b for a, b in ranges)), 0)


def judged(model, text):
    """Language and its share of the letters, by the textbook recursion over all pairs of languages."""
    letters, codes, found = words_of(text)
    if not found:
        return "und", 0.0
    some, padded = range(len(model.languages)), [0, *letters, 0]
    rows, known = [], []
    for run in found:
        allowed = [bool(model.written[script_of(codes[run[0]])][k]) for k in some]
        known.append(any(allowed))
        s = [sum(float(model.weights[bucket(*padded[i:i + 3])][k]) for i in run) if allowed[k] else langid._OUT for k in some] if any(allowed) else [0.0] * len(allowed)
        top = max(s)
        norm = top + math.log(sum(math.exp(x - top) for x in s))
        rows.append([max(x - norm, langid._FLOOR) if x - norm > langid._OUT / 2 else langid._OUT for x in s])
    best, back = rows[0], []
    for row in rows[1:]:
        moves = [max(((best[j] - (langid.SWITCH if j != k else 0), j == k, -j) for j in some)) for k in some]
        back.append([-m[2] for m in moves])
        best = [m[0] + x for m, x in zip(moves, row)]
    at = max(some, key=lambda k: (best[k], -k))
    labels = [at]
    for step in reversed(back):
        at = step[at]
        labels.append(at)
    share = [0] * len(model.languages)
    for label, run, seen in zip(reversed(labels), found, known):
        share[label] += len(run) if seen else 0
    lead = max(some, key=lambda k: (share[k], -k))
    return model.languages[lead], share[lead] / sum(map(len, found))


def test_op10_labels_every_text_by_the_best_path(spark, documents, fitted):
    got = queries.op10_language_id(spark, SMALL).collect()
    model, = fitted
    assert sorted(r.doc_id for r in got) == sorted(documents) and len(model.languages) > 1
    for r in got:
        lang, score = judged(model, documents[r.doc_id].text or "")
        assert (r.doc_id, r.lang_pred) == (r.doc_id, lang) and r.score == pytest.approx(score, abs=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_op6_puts_every_piece_into_a_tightest_compatible_bin(spark, documents):
    got = queries.op6_best_fit_packing(spark, SMALL).collect()
    covered = {}
    for r in got:
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
    for i, doc in documents.items():
        at = 0
        for start, length in sorted(covered[i]):
            assert start == at
            at += length
        assert at == len(re.findall(r"[^\x20\x09-\x0d]+", doc.text or ""))
    assert len({r.bin_id for r in got if r.length == packing.CAPACITY}) == sum(r.length == packing.CAPACITY for r in got)

    def order(r):
        text = "\x01".join("\x02" if x is None else str(x) for x in (r.doc_id, r.cluster, r.source))
        return -r.length, int(hashlib.md5(text.encode()).hexdigest()[:15], 16), r.piece

    bins = {}  # all pieces are of one group here: fewer than packing.GROUP
    for r in sorted((r for r in got if 0 < r.length < packing.CAPACITY), key=order):
        marks = {("source", r.source)} | ({("cluster", r.cluster)} if r.cluster is not None else set())
        fits = [left for left, held in bins.values() if left >= r.length and not marks & held]
        assert packing.CAPACITY - r.bin_offset == min(fits, default=packing.CAPACITY)
        left, held = bins.get(r.bin_id, (packing.CAPACITY, set()))
        assert left == packing.CAPACITY - r.bin_offset and not marks & held
        bins[r.bin_id] = (left - r.length, held | marks)

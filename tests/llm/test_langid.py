import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs_of  # noqa: F401
from lodestar.llm import langid

SOUNDS = {"xa": ["tha", "ing", "wh", "er", "and"], "xb": ["eau", "ou", "tre", "ment", "é"], "xc": ["sch", "ung", "ü", "keit", "ver"]}


def words(lang, n, rng):
    if lang == "ru":
        return ["".join(rng.choice("абвгдежз") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    return ["".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def made_up(n=240, seed=3):
    rng = random.Random(seed)
    langs = [*SOUNDS, "ru"]
    return [(i, " ".join(words(langs[i % 4], rng.randint(5, 60), rng)).capitalize() + ".", langs[i % 4], "s") for i in range(n)]


def brute_viterbi(scores, penalty):
    """Best label sequence by the textbook recursion over all pairs of labels."""
    n, k = scores.shape
    best, back = scores[0].astype(float), []
    best = np.zeros(k) + scores[0]
    for t in range(1, n):
        move = best[:, None] - penalty * (1 - np.eye(k))
        back.append(move.argmax(axis=0))
        best = move.max(axis=0) + scores[t]
    return best.max()


def path_score(scores, labels, penalty):
    return scores[np.arange(len(labels)), labels].sum() - penalty * (np.diff(labels.astype(int)) != 0).sum()


def test_viterbi_finds_a_best_path():
    rng = np.random.default_rng(1)
    texts = [np.log(rng.dirichlet(np.ones(3), n)).astype(np.float32) for n in (1, 7, 40, 3, 0, 40, 12)]
    got = langid.viterbi(texts, 2.0)
    for s, labels in zip(texts, got):
        assert len(labels) == len(s)
        if len(s):
            assert path_score(s, labels, 2.0) == pytest.approx(brute_viterbi(s, 2.0), abs=1e-4)
    assert langid.viterbi([]) == []


@pytest.fixture(scope="module")
def model(spark, docs_of):
    return langid.fit(docs_of(made_up()))


def test_spans_of_mixed_text(model):
    rng = random.Random(8)
    parts = [("xa", 30), ("ru", 12), ("xb", 25), ("xc", 18)]
    pieces = [" ".join(words(lang, n, rng)) for lang, n in parts]
    text = "; ".join(pieces) + " 日本 123"
    (lang, score, spans), = langid._label(model, [text])
    assert [s["lang"] for s in spans][:4] == [p[0] for p in parts] and lang == "xa" or lang in SOUNDS
    at = 0
    for (want, _), piece, span in zip(parts, pieces, spans):
        assert span["lang"] == want and abs(span["start"] - at) <= 12
        at += len(piece) + 2
    letters = sum(c.isalpha() for c in text)
    assert 0 < score < 1 and score <= max(map(len, pieces)) / letters


def test_scripts_narrow_the_candidates(model):
    assert model.languages == ("ru", "xa", "xb", "xc")
    starts, ends, scores, known = langid._emissions(model, "абв thaing 日本")
    assert scores[0].argmax() == 0 and (scores[0][1:] <= langid._OUT).all()
    assert scores[1][0] <= langid._OUT and known.tolist() == [True, True, False]


EDGES = [(900, None, "xa", None), (901, "", "xa", None), (902, "12 34 !?", "xa", None), (903, "日本語", None, None), (904, " ".join(words("xb", 60_000, random.Random(2))), None, None),
         (None, "thaing whering and", None, None), (905, "eau ou treou", None, None), (905, "eau ou treou", None, None), (906, "İstanbul ́ ß", None, None), (907, "́ ̂", None, None), (908, "x" * 50_000, None, None)]


def test_documents(spark, docs_of):
    docs = made_up() + EDGES
    df = docs_of(docs).withColumn("l", F.lit(1)).withColumn("score", F.lit("x")).withColumn("key", F.lit(0))
    got = langid.identify(df).collect()
    assert len(got) == len(docs)
    want = {i: lang for i, _, lang, _ in docs[:240]}
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert len(held) > 30 and all(r.lang_pred == want[r.doc_id] for r in held)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        assert (r.lang_pred == "und") == (r.doc_id in (900, 901, 902, 907))
    assert by[904][0].lang_pred == "xb" and by[None][0].lang_pred == "xa" and by[903][0].score == 0 and len(by[905]) == 2
    kept = langid.monolingual(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.lang_pred != "und" and r.score >= 0.5)


def test_answers_do_not_depend_on_grouping(model, monkeypatch):
    texts = [t for _, t, *_ in made_up(60) + EDGES]
    whole = list(langid._label(model, texts))
    monkeypatch.setattr(langid, "_CHARS", 50)
    assert list(langid._label(model, texts)) == whole
    assert [x for t in texts for x in langid._label(model, [t])] == whole


def test_held_out_labels_are_not_learned_from(spark, docs_of, model):
    other = [(i, t, "xa" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, "zz") for i, t, lang, _ in made_up()]
    again = langid.fit(docs_of(other))
    assert again.languages == model.languages and (again.weights == model.weights).all()


def test_tables_without_lessons(spark, docs_of):
    assert langid.identify(docs_of([])).collect() == []
    assert {r.lang_pred for r in langid.identify(docs_of([(1, "some text", None, None), (2, None, None, None)])).collect()} == {"und"}


def test_every_language_is_learned(spark, docs_of):
    """More languages than one byte can number; each has letters of its own."""
    names = [f"l{i:03}" for i in range(300)]
    docs = [(i, " ".join([chr(0x4E00 + i % 300) * 3] * 5), names[i % 300], "s") for i in range(3000)]
    model = langid.fit(docs_of(docs))
    assert model.languages == tuple(names)
    assert [x[0] for x in langid._label(model, [d[1] for d in docs[:300]])] == names


def test_pipeline_keeps_what_it_cannot_judge(spark, docs_of):
    import corpus_pipeline

    kept = lambda rows: {r.doc_id for r in corpus_pipeline.language_stage(spark, docs_of(rows), "").collect()}
    unlabelled = [(1, "some text", None, None), (2, None, None, None), (3, "12 !", None, None), (4, "日本語", None, None)]
    assert kept(unlabelled) == {1, 4}
    cut = [d for d in made_up() if d[2] != "ru"]
    ids = kept(cut + [(900, "日本語", None, None), (901, "абв гдеж", None, None), (902, "12", None, None), (903, "thaing 日本語日本語日本語", None, None)])
    assert {900, 901, 903} <= ids and 902 not in ids

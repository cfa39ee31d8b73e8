import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestar.llm import tokenfile

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = "byte_bpe_50k.json"
TEXTS = [
    None, "", " ", "\n", "a", "a  b", "x\n\ny", "\nq", " z", "tab\there", "end ", "nb\xa0sp", "Foo, bar. Baz!!, 12,5.   q", "x\x01y", "\x01",
    "<|endoftext|> hi", "café, naïve. 日本語 text.", "don't stop, it's.", "a,b ,c .d", ".", ", ,", "A.\nB, C.\nD", "a \nb", "a\n b", "a\r\nb", "\x1c \x85x",
    "\U0001F600 \U0001F600, ok", "long " * 30_000, "word" * 5000, "1 22, 333. 4,4",
]


class Stream(io.BytesIO):
    """A file as pyarrow gives it."""

    def size(self):
        return len(self.getbuffer())

    def read_at(self, n, at):
        return self.getvalue()[at:at + n]

    def close(self):
        pass


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(BPE))


@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**32 - 1)), min_size=1, max_size=300), st.integers(1, 100))
@settings(max_examples=200, deadline=None)
def test_blocks_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    assert (tokenfile.decode_block(tokenfile.encode_block(ids, percentile)) == ids).all()


def test_outliers_are_exceptions():
    ids = np.full(1000, 1000, np.uint32) + np.arange(1000, dtype=np.uint32) % 16
    ids[[3, 700]] = 4_000_000_000
    data = tokenfile.encode_block(ids)
    n, least, exceptions, width = tokenfile._HEAD.unpack_from(data)
    assert (n, least, exceptions, width) == (1000, 1000, 2, 4)
    assert len(data) == tokenfile._HEAD.size + 500 + 2 * 6
    assert (tokenfile.decode_block(data) == ids).all()


def test_files_are_read_whole_by_document_and_by_range():
    rng = np.random.default_rng(1)
    docs = [(i, rng.integers(0, 50_000, n).astype(np.uint32)) for i, n in enumerate([0, 1, 5, tokenfile.BLOCK, 3 * tokenfile.BLOCK + 7, 0, 2])] + [(None, np.array([7], np.uint32))]
    stream = Stream()
    w = tokenfile.Writer(stream)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    r = tokenfile.Reader(stream)
    for (d, ids), (doc, at, parts) in zip(docs, r.documents(), strict=True):
        got = list(parts)
        assert doc == d and (np.concatenate(got) if got else np.zeros(0)).tolist() == ids.tolist()
        assert r.tokens(at, len(ids)).tolist() == ids.tolist()
    with pytest.raises(ValueError):
        tokenfile.Reader(Stream(b"x" * 100))


@pytest.mark.parametrize("file", [BPE, "word_bpe_49k.json"])
def test_encoder_equals_the_library(file):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(file)
    e, t = tokenfile.Encoder(path), Tokenizer.from_file(path)
    for texts in (TEXTS, TEXTS[::-1], TEXTS * 2, [], [None], [""], ["a b"]):
        ids, offsets = e.encode(pa.array(texts, pa.string()))
        want = [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
        assert [ids[i:j].tolist() for i, j in zip(offsets, offsets[1:])] == want


@given(st.lists(st.text(alphabet="ab \n,.'1é\t\xa0!", max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_encoder_on_odd_white_space(texts):
    global _E, _T
    if "_E" not in globals():
        _E, _T = tokenfile.Encoder(public_tokenizers.path(BPE)), tokenizer()
    ids, offsets = _E.encode(pa.array(texts, pa.string()))
    assert [ids[i:j].tolist() for i, j in zip(offsets, offsets[1:])] == [x.ids for x in _T.encode_batch(texts, add_special_tokens=False)]


def test_cache_limit_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokenfile, "_CACHED_WORDS", 4)
    test_encoder_equals_the_library(BPE)


def test_tables(spark):
    rows = [(9, "b, a."), (3, "x"), (3, "y z"), (None, "null id"), (5, None), (-4, "first"), (7, "w " * 20_000)] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("row", F.lit(1)).withColumn("last", F.lit("x"))
    manifest = tokenfile.write_tokens(df, public_tokenizers.path(BPE))
    got = sorted(tokenfile.read_tokens(spark, manifest, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(d for d, _ in rows if d is not None) + [None]
    t, start = tokenizer(), 0
    for r in got:
        ids = np.array(r.ids, "<u4")
        assert r.start == start and r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids.tobytes()) and ids[-1] == 0
        start += len(ids)
    want = sorted((str(d), t.encode(x or "", add_special_tokens=False).ids + [0]) for d, x in rows)
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == want


def test_empty_table(spark):
    manifest = tokenfile.write_tokens(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path(BPE))
    assert tokenfile.read_tokens(spark, manifest).collect() == []

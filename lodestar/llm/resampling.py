"""Importance resampling towards a target corpus: hashed n-gram weights, Gumbel top-k.

Features are hashed word n-grams.  Their counts in the corpus and in the target
texts are arrays with one cell per bucket; the smoothed log ratio of the two is
the bucket's gain, and a document's weight is the mean gain of its features,
looked up in that array.  Adding Gumbel noise drawn from the document's id and
taking the highest scores draws without replacement by weight.

The cutoff of the draw is found without sorting the scores: a quantile sketch
names a bracket of scores around it, one exact count of the rows above and
inside confirms the bracket or widens it, and only the bracket is sorted.

Words are found on the UTF-8 bytes of a piece of the column at once, and CRC-32
is linear, so the code of an n-gram comes from the codes of its words.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import materialize, ship
from lodestar.llm.textbytes import row_ranges, utf8
from lodestar.operators.ordering import dense_row_ids

BUCKETS = 10_000
NGRAM = 2  # longest run of words that is a feature
LEAST_WORDS, PERCENT = 20, 25  # who may be drawn, and how many of them
PIECE = 1 << 20  # bytes of text worked on at once
ACCURACY = 1000  # of the quantile sketch: relative rank error 1 / ACCURACY
_LAST = (1 << 63) - 1  # a null id sorts behind all others
_LONG = 64  # words up to so many bytes are coded by tables


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of one byte; and the effect of 0.._LONG zero bytes on each byte of a code."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    shift = [np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
    for _ in range(_LONG):
        shift.append(one[shift[-1] & 255] ^ (shift[-1] >> 8))
    return one, np.stack(shift)


_ONE, _SHIFT = _tables()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def _joined(left: np.ndarray, right: np.ndarray, size: np.ndarray, texts: list[bytes | None]) -> np.ndarray:
    """Codes of left + " " + right; ``size``: bytes of right.  ``texts``: right words where they are longer than _LONG."""
    state = left ^ np.uint32(0xFFFFFFFF)
    spaced = _ONE[(state ^ 0x20) & 255] ^ (state >> 8) ^ np.uint32(0xFFFFFFFF)
    n = np.minimum(size, _LONG)
    out = right.copy()
    for j in range(4):
        out ^= _SHIFT[n, j, (spaced >> (8 * j)) & 255]
    for i in np.flatnonzero(size > _LONG):
        out[i] = zlib.crc32(texts[i], int(spaced[i]))
    return out


def _codes(piece: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of texts that lie in ``piece`` from begins to ends (rising).

    Gives the begin of every word and, for n = 1, 2, ..: (code, text) of every n-gram."""
    word = _WORD[piece]
    before, after = np.roll(word, 1), np.roll(word, -1)
    full = begins < ends
    before[begins[full]] = False
    after[ends[full] - 1] = False
    at, to = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    text = np.searchsorted(ends, at, side="right")
    size = to - at
    lower = _LOWER[piece]
    order = np.argsort(-size, kind="stable")
    starts, sizes = at[order], -size[order]
    state = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for k in range(min(_LONG, int(-sizes[0]) if len(sizes) else 0)):
        n = np.searchsorted(sizes, -k, side="left")  # words of more than k bytes
        state[:n] = _ONE[(state[:n] ^ lower[starts[:n] + k]) & 255] ^ (state[:n] >> 8)
    words = np.empty_like(state)
    words[order] = state ^ np.uint32(0xFFFFFFFF)
    texts = {i: lower[at[i]:to[i]].tobytes() for i in np.flatnonzero(size > _LONG).tolist()}
    for i, t in texts.items():
        words[i] = zlib.crc32(t)
    out, run = [(words, text)], words
    for n in range(1, NGRAM):
        i = np.flatnonzero(text[n:] == text[:max(0, len(text) - n)])
        run = run.copy()
        run[i] = _joined(run[i], words[i + n], size[i + n], [texts.get(w) for w in (i + n).tolist()] if texts else [])
        out.append((run[i], text[i]))
    return at, out


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, number of rows, words per row, [(bucket, row) of the n-grams for every n]) of pieces of a column.

    A text longer than a piece comes in several, cut between words; n-grams
    across a cut are counted once."""
    data, offsets = utf8(column)
    for i, j in row_ranges(offsets, PIECE):
        at, end, carried = int(offsets[i]), int(offsets[j]), 0
        stop = at
        while True:
            least, stop = stop + PIECE, end
            while least < end and j == i + 1:  # a cut after the next gap between words
                gaps = np.flatnonzero(~_WORD[data[least:min(end, least + PIECE)]])
                if len(gaps):
                    stop = least + int(gaps[0]) + 1
                    break
                least += PIECE
            bounds = offsets[i:j + 1] - at if j > i + 1 else np.array([0, stop - at])
            begins, grams = _codes(data[at:stop], bounds[:-1], bounds[1:])
            if carried:  # what lies in the words of the piece before is counted there
                grams = [(c[max(0, carried - n):], t[max(0, carried - n):]) for n, (c, t) in enumerate(grams)]
            yield i, j - i, np.bincount(grams[0][1], minlength=j - i), [((c % np.uint32(BUCKETS)).astype(np.int64), t) for c, t in grams]
            if stop == end:
                break
            carried = min(NGRAM - 1, len(begins))
            at = at + int(begins[-carried]) if carried else stop


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features per bucket of a whole task: one row per bucket that has any."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for *_, grams in features(batch.column(0)):
            for bucket, _ in grams:
                total += np.bincount(bucket, minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all texts per bucket (BUCKETS numbers reach the driver, whatever the corpus)."""
    ship(texts.sparkSession)
    sums = texts.select(F.col(text).cast("string")).mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of the target's share of a bucket to the corpus's."""
    s, t = corpus.astype(float), target.astype(float)
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def noise(key: int | None, seed: int) -> int:
    """Gumbel noise of an id, in thousandths."""
    name = "" if key is None else key
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gain: np.ndarray, seed: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, count, total = (np.zeros(n, np.int64) for _ in range(3))
            for first, rows, here, grams in features(batch.column(1)):
                at = slice(first, first + rows)
                words[at] += here
                for bucket, row in grams:
                    count[at] += np.bincount(row, minlength=rows)
                    sums = np.concatenate(([0], np.cumsum(gain[bucket])))
                    total[at] += np.diff(sums[np.searchsorted(row, np.arange(rows + 1))])
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            drawn = np.fromiter((noise(i, seed) for i in batch.column(0).to_pylist()), np.int64, n)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (words, count, weight, weight + drawn))],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    return score


def cutoff(rows: DataFrame, k: int, accuracy: int = ACCURACY) -> tuple[int, int]:
    """The k-th of ``rows`` (score, tie) by falling score and rising tie: its score and tie (1 <= k <= rows).

    The sketch's bracket is only a guess: the counts that confirm it are exact."""
    n = rows.count()
    place, around = 1 - (k - 0.5) / n, 2 / accuracy
    while True:
        whole = around >= 1
        ends = [max(0.0, place - around), min(1.0, place + around)]
        low, high = rows.agg(F.min("score"), F.max("score")).first() if whole else rows.agg(F.percentile_approx("score", ends, accuracy)).first()[0]
        above, inside = rows.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < k <= above + inside:
            break
        around *= 8
    bracket = rows.filter(F.col("score").between(low, high)).select((-F.col("score")).alias("fall"), "tie")
    at = dense_row_ids(bracket, "fall", "tie", id_col="at").filter(F.col("at") == k - above).first()
    return -at["fall"], at["tie"]


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = 7) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``.

    ``rank`` is 1, 2, 3... for the drawn rows - ``percent`` of those with at
    least ``least_words`` words, by falling score, ties to the smaller id - and
    null for the others.

    A null or empty text, or one without words, has no features and weight 0.
    A text of any length is scored whole.  A null id takes the noise of the
    empty id and comes last among ties; rows with one id share their noise, and
    rows equal in score and id are drawn one by one until the number is
    reached (rows of one id and score are interchangeable).  Empty ``docs``
    give an empty result, an empty ``target`` gives smoothed counts of zero.
    Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ship(spark)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    gain = gains(bucket_counts(slim), bucket_counts(target, target_text))
    scored = materialize(slim.mapInArrow(_score(gain, seed), "doc_id long, n_words long, n_features long, weight long, score long"), "resample-scores")
    scored = scored.withColumn("tie", F.coalesce("doc_id", F.lit(_LAST)))
    may = scored.filter(F.col("n_words") >= least_words)
    k = may.count() * percent // 100
    if not k:
        return scored.drop("tie").withColumn("rank", F.lit(None).cast("long"))
    score, tie = cutoff(may, k)
    inside = (F.col("n_words") >= least_words) & ((F.col("score") > score) | ((F.col("score") == score) & (F.col("tie") <= tie)))
    drawn = dense_row_ids(scored.filter(inside).withColumn("fall", -F.col("score")), "fall", "tie", id_col="rank").drop("fall")
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))  # rows equal to the last one beyond k
    rest = scored.filter(~inside).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("tie")

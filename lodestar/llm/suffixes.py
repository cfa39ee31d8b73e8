"""Suffix-array deduplication: bytes covered by a string that an earlier document holds too.

A document loses every byte that lies in a string of ``span`` bytes which also
starts in a document with a smaller id.  Strings of ``span`` bytes are called
windows here.

Sparse suffixes.  In every window the ``seed`` bytes with the least hash, its
anchor, are found; equal windows have their anchor at the same offset, and
about one position in thirteen is an anchor.  Only suffixes that begin at an
anchor are sorted, each as long as its windows reach to the right, with the
bytes that they reach to the left beside it.  Anchors whose seed occurs in one
document only are left out before: their hashes are compared first, in runs of
four bytes a piece.

Sort.  Every task sorts its suffixes into runs; of equal ones, the smallest
document speaks for all (the others hold nothing that it does not hold, so
their windows are marked at once).  Runs are cut at sampled splitters, front
coded (length of the prefix shared with the suffix before, and the rest) and
exchanged; a loser tree merges them, comparing two suffixes only behind the
prefix that both are known to share with the last one taken.

Windows.  The merged order puts suffixes with one seed side by side and names
their common prefixes; sorting their left sides names the common left parts.
Two windows are equal if both reach as far as the window does: numbers of
classes, no string is compared again.  Anchors whose seed occurs very often
are sorted window by window instead (dense suffixes), so that no group grows
with the corpus.  What a part finds leaves it as one row per bucket of
documents; a document's spans from all parts become one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm.common import STAGED, materialize, settings, ship
from lodestar.llm.textbytes import row_ranges, utf8
from lodestar.llm.vectors import groups
from lodestar.operators.joins import bounded_broadcast, fits_rows

SPAN = 50  # bytes of a string that must not come again
PIECE = 1 << 18  # bytes of text worked on at once
HASHED, SORTED = 1 << 18, 1 << 17  # anchors per run of hashes, suffixes per sorted run
PASSED = 1 << 13  # codes per row that only passes through
SHARES = 8  # of a bucket that are sorted one after another
HOT = 4096  # occurrences of a seed beyond which its windows are sorted one by one
PART_BYTES = 8 << 20  # expected bytes of suffixes per merge task
SAMPLED = 64  # sampled suffixes per merge task, which place the splitters
_LAST = (1 << 63) - 1  # stands for a null id: no document is behind it
_MUL = 0x9E3779B97F4A7C15
_BYTE = np.frombuffer(hashlib.shake_128(b"byte codes").digest(2048), "<u8")


def seed_length(span: int) -> int:
    return max(1, span // 2 - 1)


# --- anchors -----------------------------------------------------------------------------------------------------


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at every position (rolling polynomial, mixed)."""
    block, length, whole, covered = _BYTE[data], 1, None, 0
    left = size
    while True:
        if left & 1:
            if whole is None:
                whole, covered = block, length
            else:
                n = len(data) - covered - length + 1
                whole = block[:n] * np.uint64(pow(_MUL, covered, 1 << 64)) + whole[length:length + n]
                covered += length
        left >>= 1
        if not left:
            break
        n = len(data) - 2 * length + 1
        block = block[:n] * np.uint64(pow(_MUL, length, 1 << 64)) + block[length:length + n]
        length *= 2
    whole = whole ^ (whole >> np.uint64(29))
    whole *= np.uint64(0xBF58476D1CE4E5B9)
    return whole ^ (whole >> np.uint64(32))


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values: offset of its least one, the leftmost of equals."""
    least, offset, size = values, np.zeros(len(values), np.uint8), 1
    while size < width:
        step = min(size, width - size)
        n = len(least) - step
        later = least[step:] < least[:n]
        offset = np.where(later, offset[step:] + np.uint8(step), offset[:n])
        least = np.minimum(least[:n], least[step:])
        size += step
    return offset


def _anchors_of(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, span: int, seed: int):
    """(anchor, first window, last window, hash of the seed) of texts inside ``data``."""
    ok = ends - begins >= span
    if not ok.any():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    grams = _grams(data, seed)
    offset = _leftmost_least((grams >> np.uint64(32)).astype(np.uint32), span - seed + 1)
    change = np.zeros(len(data) + 1, np.int8)
    np.add.at(change, begins[ok], 1)
    np.add.at(change, ends[ok] - span + 1, -1)
    window = np.flatnonzero(np.cumsum(change[:-1], dtype=np.int8))
    anchor = window + offset[window]
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    at = anchor[first]
    return at, window[first], window[np.append(first[1:], len(window)) - 1], grams[at]


def anchors(data: np.ndarray, offsets: np.ndarray, span: int, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of all rows, piece by piece; a long text comes in several pieces that share no window."""
    for i, j in row_ranges(offsets, PIECE):
        begin, end = int(offsets[i]), int(offsets[j])
        if end - begin <= 2 * PIECE:
            found = [(begin, _anchors_of(data[begin:end], offsets[i:j] - begin, offsets[i + 1:j + 1] - begin, span, seed))]
        else:
            cuts = range(begin, end - span + 1, PIECE)
            found = ((x, _anchors_of(data[x:min(x + PIECE + span - 1, end)], np.array([0]), np.array([min(PIECE + span - 1, end - x)]), span, seed))
                     for x in cuts)
        for base, (at, low, high, gram) in found:
            yield at + base, low + base, high + base, gram


# --- spans -------------------------------------------------------------------------------------------------------


def merge_spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the union of [start, end) per row; rows and spans rise."""
    if not len(row):
        return row, start, end
    width = int(end.max()) + 2
    s, e = row.astype(np.int64) * width + start, row.astype(np.int64) * width + end
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    first = np.flatnonzero(np.append(True, s[1:] > e[:-1]))
    last = np.append(first[1:], len(s)) - 1
    return s[first] // width, s[first] % width, e[last] % width


def _span_rows(docs: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(doc, h, spans) per row; ``docs``: (n, 2) of doc and h."""
    row, start, end = merge_spans(row, start, end)
    if not len(row):
        return []
    first = np.flatnonzero(np.diff(row, prepend=-1))
    pairs = np.stack([start, end], axis=1).astype("<u4")
    return [(*docs[row[a]].tolist(), pairs[a:b].tobytes()) for a, b in zip(first.tolist(), np.append(first[1:], len(row)).tolist())]


# --- seeds that more than one document holds ----------------------------------------------------------------------

_HASHES = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("hs", pa.binary()), ("counts", pa.binary()), ("lows", pa.binary()), ("many", pa.binary())])
_HASHES_SQL = "bucket int, kind int, hs binary, counts binary, lows binary, many binary"


def _code(gram: np.ndarray, bits: int) -> np.ndarray:
    """Bucket (leading bits) and trailing 32 bits of a hash in one long."""
    high = (gram >> np.uint64(64 - bits)) if bits else np.zeros_like(gram)
    return ((high << np.uint64(32)) | (gram & np.uint64(0xFFFFFFFF))).astype(np.int64)


def _grouped(h: np.ndarray, values: np.ndarray, kind: str) -> dict:
    """Values by h: the distinct h, how many values each has, the values."""
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1])) if len(h) else np.zeros(0, int)
    return {"hs": h[order][first].astype("<i8").tobytes(), "counts": np.diff(np.append(first, len(h))).astype("<u4").tobytes(),
            "lows": values[order].astype(kind).tobytes()}


def _hash_runs(span: int, seed: int, bits: int):
    """Texts -> per bucket of hashes: those of one document by document, those of several, how often they occur.

    The documents of hashes that occur in several go out at once, as rows of
    kind 1 in any bucket: a frequent hash costs its bucket one number per run."""

    def flush(codes: list[np.ndarray], hs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        code, h = np.concatenate(codes), np.concatenate(hs)
        order = np.lexsort((h, code))
        code, h = code[order], h[order]
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        times = np.diff(np.append(first, len(code)))
        several = h[first] != h[first + times - 1]
        once = np.append(True, (code[1:] != code[:-1]) | (h[1:] != h[:-1]))  # a hash counts once per document
        shared = np.repeat(several, times) & once
        rows = []
        sent_h, sent = h[shared], code[shared]
        by_h = np.argsort(sent_h, kind="stable")
        sent_h, sent = sent_h[by_h], sent[by_h]
        for a in range(0, len(sent), PASSED):  # to any bucket, as the documents' hashes have it
            rows.append({"bucket": int(sent_h[a] & ((1 << bits) - 1)), "kind": 1, "many": b"", **_grouped(sent_h[a:a + PASSED], sent[a:a + PASSED], "<i8")})
        single = ~several
        low, bucket = code[first] & 0xFFFFFFFF, code[first] >> 32
        many = several | (times > 1)
        for b in np.unique(bucket).tolist():
            a, z = np.searchsorted(bucket, [b, b + 1])
            one, more = single[a:z], many[a:z]
            extra = np.stack([low[a:z][more], np.where(one[more], times[a:z][more] - 1, times[a:z][more]), ~one[more]], axis=1)
            rows.append({"bucket": b, "kind": 0, "many": extra.astype("<u4").tobytes(), **_grouped(h[first[a:z]][one], low[a:z][one], "<u4")})
        for a in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pylist(rows[a:a + 64], _HASHES)

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, hs, held = [], [], 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            h = batch.column("h").to_numpy()
            for at, _, _, gram in anchors(data, offsets, span, seed):
                codes.append(_code(gram, bits))
                hs.append(h[np.searchsorted(offsets, at, side="right") - 1])
                held += len(at)
                if held >= HASHED:
                    yield from flush(codes, hs)
                    codes, hs, held = [], [], 0
        if held:
            yield from flush(codes, hs)

    return hash_


def _shared_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of hashes -> (h, code) of every document and seed that another document may hold; h null: a hot seed."""
    for table in groups(batches, "bucket"):
        bucket = table["bucket"][0].as_py() << 32
        lows, hs, many = [], [], []
        for kind, h, counts, values, extra in zip(*(table[c].to_pylist() for c in _HASHES.names[1:])):
            owner = np.repeat(np.frombuffer(h, "<i8"), np.frombuffer(counts, "<u4"))
            if kind:
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(np.frombuffer(values, "<i8"))], ["h", "code"])
                continue
            hs.append(owner)
            lows.append(np.frombuffer(values, "<u4"))
            many.append(np.frombuffer(extra, "<u4").reshape(-1, 3))
        if not hs:
            continue
        everything = np.concatenate(hs), np.concatenate(lows), np.concatenate(many)
        del hs, lows, many, table
        for share in range(SHARES):  # of the hashes of a bucket: bounds the memory of sorting them
            yield _shared_of(*everything, share, bucket)


def _shared_of(h: np.ndarray, low: np.ndarray, extra: np.ndarray, share: int, bucket: int) -> pa.RecordBatch:
    """The rows of ``_shared_seeds`` for one share of a bucket's hashes."""
    own, more = low % SHARES == share, extra[:, 0] % SHARES == share
    h, low, extra = h[own], low[own], extra[more]
    names, of = np.unique(np.concatenate((low, extra[:, 0])), return_inverse=True)
    times = np.bincount(of, np.concatenate((np.ones(len(low)), extra[:, 1].astype(float))), len(names))
    # runs hold different documents: two of them, or one with several
    holders = np.bincount(of, np.concatenate((np.ones(len(low)), 2.0 * extra[:, 2])), len(names))
    keep = holders[of[:len(low)]] >= 2
    hot = (holders >= 2) & (times > HOT)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.append(h[keep], np.zeros(hot.sum(), np.int64)), mask=np.append(np.zeros(keep.sum(), bool), np.ones(hot.sum(), bool))),
         pa.array(np.append(low[keep], names[hot]).astype(np.int64) + bucket)], ["h", "code"])


# --- sorted runs --------------------------------------------------------------------------------------------------

_RUN = pa.schema([("part", pa.int32()), ("kind", pa.int32()), *[(c, pa.binary()) for c in (
    "lcp", "size", "rest", "left_size", "left", "doc", "h", "count", "at")]])
_RUN_SQL = "part int, kind int, " + ", ".join(f"{c} binary" for c in _RUN.names[2:])
SPARSE, DENSE, MARKS = 0, 1, 2


def _words(matrix: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as big-endian numbers, leading ones first: they compare as the rows do."""
    wide = np.zeros((len(matrix), -(-matrix.shape[1] // 8) * 8), np.uint8)
    wide[:, :matrix.shape[1]] = matrix
    return list(wide.view(">u8").astype(np.uint64).T)


def _cut(data: np.ndarray, at: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of ``size`` bytes that begin at ``at`` and go right (step 1) or left (step -1), padded with zeros."""
    column = np.arange(width)
    out = data[np.clip(at[:, None] + step * column, 0, max(0, len(data) - 1))] if len(at) else np.zeros((0, width), np.uint8)
    out[column >= size[:, None]] = 0
    return out


def _common(matrix: np.ndarray) -> np.ndarray:
    """Bytes that every row shares with the row before (first row: 0)."""
    out = np.zeros(len(matrix), np.int64)
    if len(matrix) > 1:
        differ = matrix[1:] != matrix[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    return out


class _Suffixes:
    """Suffixes of some texts: key (padded bytes and their number), left side, where it is."""

    def __init__(self, span: int, seed: int):
        self.span, self.seed, self.width = span, seed, span - seed
        self.parts: dict[int, list] = {SPARSE: [], DENSE: []}
        self.docs: list[np.ndarray] = []
        self.rows = self.held = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, found: tuple, hot: np.ndarray) -> None:
        at, low, high = found
        row = np.searchsorted(offsets, at, side="right") - 1
        base = offsets[row]
        size, back = high + self.span - at, at - low
        for kind, pick in ((SPARSE, ~hot), (DENSE, hot)):
            a, r, s, b, lo, hi, z = (x[pick] for x in (at, row, size, back, low, high, base))
            if kind == DENSE:  # every window of a hot anchor
                n = hi - lo + 1
                a = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                r, z = np.repeat(r, n), np.repeat(z, n)
                s, b = np.full(len(a), self.span), np.zeros(len(a), np.int64)
            if len(a):
                self.parts[kind].append((_cut(data, a, s, self.span, 1), s, _cut(data, a - 1, b, self.width, -1), b, r + self.rows, a - z))
                self.held += len(a)

    def sorted(self, kind: int):
        """Heads (one per distinct suffix and speaking document) in order, their positions, and what is marked at once."""
        key, size, left, back, row, at = (np.concatenate(x) for x in zip(*self.parts[kind]))
        docs = np.concatenate(self.docs)
        doc, h = docs[row, 0], docs[row, 1]
        compare = [*_words(key), size, *_words(left), back]
        order = np.lexsort([at, h, doc, *reversed(compare)])
        key, size, left, back, row, at, doc, h = (x[order] for x in (key, size, left, back, row, at, doc, h))
        new = np.zeros(len(key), bool)
        new[0] = True
        for w in compare:
            w = w[order]
            new[1:] |= w[1:] != w[:-1]
        group = np.cumsum(new) - 1
        speaks = doc == doc[np.flatnonzero(new)][group]
        marked = (row[~speaks], (at - back)[~speaks], (at + size)[~speaks])
        key, size, left, back, at, doc, h, new = (x[speaks] for x in (key, size, left, back, at, doc, h, new))
        head = new | np.append(True, h[1:] != h[:-1]) | np.append(True, doc[1:] != doc[:-1])
        first = np.flatnonzero(head)
        count = np.diff(np.append(first, len(head)))
        return tuple(x[first] for x in (key, size, left, back, doc, h)) + (count, at), marked

    def emit(self, splitters: dict[int, np.ndarray], mix: int) -> Iterator[pa.RecordBatch]:
        marks, parts = [], 0
        for kind in (SPARSE, DENSE):
            cuts = splitters[kind]
            if self.parts[kind]:
                (key, size, left, back, doc, h, count, at), marked = self.sorted(kind)
                marks.append(marked)
                common = _common(key)
                width = self.seed if kind == SPARSE else self.span  # suffixes with one seed stay together
                names = np.ascontiguousarray(key[:, :width]).view(f"S{width}").ravel()
                ends = np.searchsorted(names, cuts) if len(cuts) else np.zeros(0, int)
                bounds, places = [0, *ends.tolist(), len(key)], np.append(0, np.cumsum(count))
                column = np.arange(self.span)
                for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    if a == b:
                        continue
                    lcp = common[a:b].copy()
                    lcp[0] = 0
                    rest = key[a:b][(column >= lcp[:, None]) & (column < size[a:b, None])]
                    side = left[a:b][np.arange(self.width) < back[a:b, None]]
                    yield pa.RecordBatch.from_pydict({
                        "part": [parts + part], "kind": [kind], "lcp": [lcp.astype(np.uint8).tobytes()], "size": [size[a:b].astype(np.uint8).tobytes()],
                        "rest": [rest.tobytes()], "left_size": [back[a:b].astype(np.uint8).tobytes()], "left": [side.tobytes()],
                        "doc": [doc[a:b].astype("<i8").tobytes()], "h": [h[a:b].astype("<i8").tobytes()], "count": [count[a:b].astype("<u4").tobytes()],
                        "at": [at[places[a]:places[b]].astype("<u4").tobytes()]}, _RUN)
            parts += len(cuts) + 1
        spans = _span_rows(np.concatenate(self.docs), *(np.concatenate(x) for x in zip(*marks))) if marks else []
        for k, a in enumerate(range(0, len(spans), 256)):
            some = spans[a:a + 256]
            empty = dict.fromkeys(_RUN.names[2:], [b""])
            yield pa.RecordBatch.from_pydict({**empty, "part": [(mix + k * 7919) % parts], "kind": [MARKS],
                                              "doc": [np.array([s[0] for s in some], "<i8").tobytes()], "h": [np.array([s[1] for s in some], "<i8").tobytes()],
                                              "count": [np.array([len(s[2]) // 8 for s in some], "<u4").tobytes()], "at": [b"".join(s[2] for s in some)]}, _RUN)


def _wanted(batch: pa.RecordBatch, rows: slice, bits: int, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors have a seed that another document holds, and which of these seeds are hot."""
    codes = batch.column("codes").slice(rows.start, rows.stop - rows.start).flatten().to_numpy()
    codes = np.unique(codes)
    code = _code(gram, bits)
    at = np.minimum(np.searchsorted(codes >> 1, code), max(0, len(codes) - 1))
    found = (codes[at] >> 1 == code) if len(codes) else np.zeros(len(code), bool)
    return found, (codes[at] & 1).astype(bool) if len(codes) else found


def _suffix_runs(span: int, seed: int, bits: int, splitters: dict[int, np.ndarray]):
    """Texts with the codes of their shared seeds -> front-coded sorted runs, cut at the splitters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Suffixes(span, seed)
        mix = 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = np.stack([batch.column(c).to_numpy() for c in ("doc", "h")], axis=1)
            held.docs.append(ids)
            for at, low, high, gram in anchors(data, offsets, span, seed):
                if not len(at):
                    continue
                rows = slice(int(np.searchsorted(offsets, at[0], side="right")) - 1, int(np.searchsorted(offsets, at[-1], side="right")))
                found, hot = _wanted(batch, rows, bits, gram)
                held.add(data, offsets, (at[found], low[found], high[found]), hot[found])
                if held.held >= SORTED:
                    mix += int(ids[rows.start, 1] & 0xFFFF)
                    yield from held.emit(splitters, mix)
                    held = _Suffixes(span, seed)
                    held.docs.append(ids)
            held.rows += len(ids)
        if held.held:
            yield from held.emit(splitters, mix + 1)

    return run


def _sample(span: int, seed: int, bits: int, every: int):
    """Keys of a hashed choice of suffixes, to place the splitters."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for at, low, high, gram in anchors(data, offsets, span, seed):
                if not len(at):
                    continue
                rows = slice(int(np.searchsorted(offsets, at[0], side="right")) - 1, int(np.searchsorted(offsets, at[-1], side="right")))
                found, hot = _wanted(batch, rows, bits, gram)
                found &= (at * 40503 >> 4) % every == 0
                a, n = np.where(hot, low, at)[found], np.where(hot, span, seed)[found]
                yield pa.RecordBatch.from_arrays([pa.array(hot[found].astype(np.int32)), pa.array([data[x:x + y].tobytes() for x, y in zip(a.tolist(), n.tolist())], pa.binary()),
                                                  pa.array(np.where(hot, high - low + 1, 1)[found])], ["kind", "key", "weight"])

    return sample


# --- merge --------------------------------------------------------------------------------------------------------


def _decoded(lcp: np.ndarray, size: np.ndarray, rest: np.ndarray, span: int) -> np.ndarray:
    """Padded keys of a front-coded run."""
    column = np.arange(span)
    own = column >= lcp[:, None]
    out = np.zeros((len(lcp), span), np.uint8)
    out[own & (column < size[:, None])] = rest
    last = np.maximum.accumulate(np.where(own, np.arange(len(lcp))[:, None], 0), axis=0)
    return np.take_along_axis(out, last, axis=0)


def merge_runs(keys: list[list[bytes]], common: list[list[int]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs of equally long keys: the run of every key taken, and the bytes it shares with the one before.

    ``common``: bytes that a key shares with the one before it in its run.
    A loser tree; the loser at a node keeps the length of the prefix it shares
    with the winner that passed there.  The longer prefix wins unread; only
    where two are as long are bytes compared, and only those behind them."""
    n = len(keys)
    leaves = 1 << max(0, (n - 1).bit_length())
    width = max((len(k[0]) for k in keys if k), default=0)
    shared = [0 if i < n and keys[i] else -1 for i in range(leaves)]  # -1: the run has ended
    now = [keys[i][0] if i < n and keys[i] else b"" for i in range(leaves)]
    at = [0] * leaves
    number = int.from_bytes

    def duel(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs with equally long known prefixes; the loser's becomes longer."""
        known = shared[a]
        x, y = number(now[a][known:]), number(now[b][known:])
        if x == y:
            a, b = (a, b) if a < b else (b, a)
            shared[b] = width
        else:
            a, b = (a, b) if x < y else (b, a)
            shared[b] = width - ((x ^ y).bit_length() + 7) // 8
        return a, b

    def play(a: int, b: int) -> tuple[int, int]:
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        return (a, b) if shared[a] < 0 else duel(a, b)

    tree, winners = [0] * leaves, list(range(leaves))
    nodes = leaves
    while nodes > 1:
        nodes //= 2
        up = []
        for i in range(nodes):
            winner, tree[nodes + i] = play(winners[2 * i], winners[2 * i + 1])
            up.append(winner)
        winners = up
    winner = winners[0] if winners else 0

    taken, prefixes = [], []
    while shared[winner] >= 0:
        taken.append(winner)
        prefixes.append(shared[winner])
        i = at[winner] + 1
        at[winner] = i
        if i < len(keys[winner]):
            now[winner], shared[winner] = keys[winner][i], common[winner][i]
        else:
            shared[winner] = -1
        node = (winner + leaves) >> 1
        while node:
            other = tree[node]
            if shared[other] > shared[winner]:
                tree[node], winner = winner, other
            elif shared[other] == shared[winner] >= 0:
                winner, tree[node] = duel(winner, other)
            node >>= 1
    return taken, prefixes


def _earlier(groups: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Is there a smaller document in the same group (numbers, in any order)?"""
    order = np.argsort(groups, kind="stable")
    first = np.flatnonzero(np.append(True, groups[order][1:] != groups[order][:-1]))
    least = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(order))))
    out = np.zeros(len(doc), bool)
    out[order] = doc[order] > least
    return out


def _covered(prefix: np.ndarray, size: np.ndarray, left: np.ndarray, back: np.ndarray, doc: np.ndarray, span: int, seed: int):
    """For sorted suffixes and the prefixes they share with the one before: the bytes to the left and to the right of
    the anchor that their repeated windows cover (0, 0: none)."""
    group = np.cumsum(prefix < seed)
    order = np.lexsort([*reversed(_words(left)), group])
    same = _common(left[order])
    edge = np.append(True, group[order][1:] != group[order][:-1])
    reach_left, reach_right = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    side = np.empty(len(doc), np.int64)
    for offset in range(span - seed + 1):  # windows that begin so many bytes before their anchor
        has = np.flatnonzero((offset >= span - size) & (offset <= back))
        if not len(has):
            continue
        right = np.cumsum(prefix < span - offset)
        side[order] = np.cumsum(edge | (same < offset))
        again = has[_earlier(right[has] * (len(doc) + 1) + side[has], doc[has])]
        reach_left[again] = offset  # offsets rise: the last is the largest
        reach_right[again] = np.maximum(reach_right[again], span - offset)
    return reach_left, reach_right


def _merged(span: int, seed: int):
    """All runs of a part -> (doc, h, spans) of the windows that a smaller document holds."""

    def solve(kind: int, table: list[dict]) -> list[tuple[int, int, bytes]]:
        cut = lambda c, t: [np.frombuffer(r[c], t) for r in table]
        lcps, sizes = cut("lcp", np.uint8), cut("size", np.uint8)
        keys = [np.column_stack([_decoded(a.astype(np.int64), b.astype(np.int64), c, span), b]) for a, b, c in zip(lcps, sizes, cut("rest", np.uint8))]
        taken, prefix = merge_runs([np.ascontiguousarray(k).view(f"V{span + 1}").ravel().tolist() for k in keys],
                                   [_common(k).tolist() for k in keys])
        order = np.empty(len(taken), np.int64)
        order[:] = np.argsort(np.argsort(np.array(taken, np.int32), kind="stable"), kind="stable")
        size, back = np.concatenate(sizes).astype(np.int64), np.concatenate(cut("left_size", np.uint8)).astype(np.int64)
        doc, h, count = (np.concatenate(cut(c, t)).astype(np.int64) for c, t in (("doc", "<i8"), ("h", "<i8"), ("count", "<u4")))
        prefix = np.minimum(np.array(prefix, np.int64), span)
        at, first = np.concatenate(cut("at", "<u4")).astype(np.int64), np.cumsum(count) - count
        if kind == DENSE:
            right = np.where(_earlier(np.cumsum(prefix < span), doc[order]), span, 0)
            before = np.zeros_like(right)
        else:
            left = np.zeros((len(size), span - seed), np.uint8)
            left[np.arange(span - seed) < back[:, None]] = np.concatenate(cut("left", np.uint8))
            before, right = _covered(prefix, size[order], left[order], back[order], doc[order], span, seed)
        some = np.flatnonzero(right > 0)
        pick = order[some]
        times = count[pick]
        place = np.repeat(first[pick], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        start, end = at[place] - np.repeat(before[some], times), at[place] + np.repeat(right[some], times)
        docs, row = np.unique(np.stack([doc[pick], h[pick]], axis=1), axis=0, return_inverse=True) if len(pick) else (np.zeros((0, 2), np.int64), pick)
        return _span_rows(docs, np.repeat(row.ravel(), times), start, end)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "part"):
            rows = table.to_pylist()
            out = []
            for r in rows:
                if r["kind"] == MARKS:
                    n = np.frombuffer(r["count"], "<u4")
                    ends = np.cumsum(n) * 8
                    out += [(int(d), int(h), r["at"][e - 8 * c:e]) for d, h, c, e in
                            zip(np.frombuffer(r["doc"], "<i8"), np.frombuffer(r["h"], "<i8"), n.tolist(), ends.tolist())]
            for kind in (SPARSE, DENSE):
                some = [r for r in rows if r["kind"] == kind]
                if some:
                    out += solve(kind, some)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], ["doc", "h", "spans"])

    return merge


_SPANS = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("docs", "hs", "counts", "spans")]])
_SPANS_SQL = "bucket int, docs binary, hs binary, counts binary, spans binary"


def _packed(merge, buckets: int):
    """The rows of ``merge``, a part's as one row per bucket of documents however many documents it holds."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merge(batches):
            spans = batch.column("spans").to_pylist()
            bucket = batch.column("h").to_numpy() % buckets
            order = np.argsort(bucket, kind="stable")
            bucket, doc, h = bucket[order], batch.column("doc").to_numpy()[order], batch.column("h").to_numpy()[order]
            count = np.array([len(s) // 8 for s in spans], "<u4")[order]
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            yield pa.RecordBatch.from_pylist(
                [{"bucket": int(bucket[a]), "docs": doc[a:z].astype("<i8").tobytes(), "hs": h[a:z].astype("<i8").tobytes(), "counts": count[a:z].tobytes(),
                  "spans": b"".join(spans[i] for i in order[a:z].tolist())} for a, z in zip(first.tolist(), np.append(first[1:], len(order)).tolist())], _SPANS)

    return pack


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed spans of a bucket, from all parts -> one row per document with the union of its spans."""
    for table in groups(batches, "bucket"):
        doc, h, count, pairs = (np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in (("docs", "<i8"), ("hs", "<i8"), ("counts", "<u4"), ("spans", "<u4")))
        count, pairs = count.astype(np.int64), pairs.reshape(-1, 2).astype(np.int64)
        begin = np.cumsum(count) - count
        order = np.lexsort([h, doc])
        doc, h, count, begin = (x[order] for x in (doc, h, count, begin))
        row = np.cumsum(np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))) - 1
        upto = np.cumsum(count)
        a = 0
        while a < len(row):  # whole documents of about PIECE spans at once
            z = int(np.searchsorted(upto, upto[a] + PIECE))
            z = int(np.searchsorted(row, row[min(z, len(row) - 1)], side="right"))
            n = count[a:z]
            place = np.repeat(begin[a:z], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            keys = np.stack([doc[a:z], h[a:z]], axis=1)[np.flatnonzero(np.diff(row[a:z], prepend=-1))]
            out = _span_rows(keys, np.repeat(row[a:z] - row[a], n), pairs[place, 0], pairs[place, 1])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], ["doc", "h", "spans"])
            a = z


# --- the operator -------------------------------------------------------------------------------------------------


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, doc (a null id behind all others), h (with doc, names the row's content), text (null: empty)."""
    body, key = F.coalesce(F.col(text).cast("string"), F.lit("")), F.col(doc_id).cast("long")
    doc = F.coalesce(key, F.lit(_LAST))
    return docs.select(key.alias("doc_id"), doc.alias("doc"), F.xxhash64(doc, body).alias("h"), body.alias("text"))


def _splitters(rows: DataFrame, span: int, seed: int, bits: int, parts: int, every: int) -> dict[int, np.ndarray]:
    """Keys that cut the suffixes of each kind into parts of about equal weight, from a sample of bounded size."""
    found = rows.mapInArrow(_sample(span, seed, bits, every), "kind int, key binary, weight long").collect()
    weight = {k: sum(r["weight"] for r in found if r["kind"] == k) for k in (SPARSE, DENSE)}
    out = {}
    for kind, width in ((SPARSE, seed), (DENSE, span)):
        some = sorted((bytes(r["key"]), r["weight"]) for r in found if r["kind"] == kind)
        n = max(1, round(parts * weight[kind] / max(1, sum(weight.values()))))
        upto = np.cumsum([w for _, w in some])
        at = np.unique(np.searchsorted(upto, np.arange(1, n) * weight[kind] / n)) if some else []
        out[kind] = np.unique(np.array([some[i][0] for i in at], f"S{width}"))
    return out


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """What to remove: (rows, spans).

    ``rows``: doc_id, doc, h, n_bytes, sha, whole (true: a copy of a smaller document, all of it goes); one per row of ``docs``.
    ``spans``: doc, h, spans (list of binaries: pairs of begin and end in bytes); no row for documents that lose nothing,
    or everything as a copy.
    """
    if not 8 <= span <= 200:
        raise ValueError("span must be between 8 and 200 bytes")
    spark = docs.sparkSession
    ship(spark)
    seed = seed_length(span)
    keyed = _keyed(docs, doc_id, text)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(0, (tasks - 1).bit_length())
    base = keyed.select("doc_id", "doc", "h", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    base = materialize(base, "suffix-rows")
    # copies of a whole document: the smallest speaks for all
    first = base.groupBy("sha").agg(F.min("doc").alias("first"), F.count("doc").alias("n")).filter("n > 1").drop("n")
    rows = base.join(bounded_broadcast(first), "sha", "left").withColumn(
        "whole", F.coalesce(F.col("doc") > F.col("first"), F.lit(False)) & (F.col("n_bytes") >= span)).drop("first")
    rows = materialize(rows, "suffix-copies")
    copies = rows.filter("whole").select("h").distinct()
    texts = keyed.select("doc", "h", "text")
    if fits_rows(copies, 1_000_000):  # else they are left out below, after the texts have been read
        texts = texts.join(F.broadcast(copies), "h", "left_anti").select("doc", "h", "text")

    # the sort makes a run the same if its task is run again
    hashes = texts.select("h", "text").sortWithinPartitions("h").mapInArrow(_hash_runs(span, seed, bits), _HASHES_SQL)
    shared = hashes.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared_seeds, "h long, code long")
    shared = materialize(shared, "suffix-seeds")
    hot = bounded_broadcast(shared.filter("h IS NULL").select("code", F.lit(1).alias("hot")).distinct())
    codes = shared.filter("h IS NOT NULL").join(copies, "h", "left_anti").join(hot, "code", "left")
    codes = codes.select("h", (F.col("code") * 2 + F.coalesce("hot", F.lit(0))).alias("code"))
    lists = codes.groupBy("h").agg(F.collect_list("code").alias("codes"))

    found, n_docs = shared.count(), max(1, rows.count())
    parts = max(tasks, -(-found * (span + 30) // PART_BYTES))
    # a sample of about SAMPLED suffixes a part, from many documents
    docs_of_sample = min(n_docs, SAMPLED * parts // 8 + 1)
    some = n_docs // docs_of_sample
    every = max(1, round(found / some / (SAMPLED * parts)))
    chosen = F.pmod(F.col("h"), F.lit(some)) == 0
    sample = texts.filter(chosen).join(codes.filter(chosen).groupBy("h").agg(F.collect_list("code").alias("codes")), "h")
    cuts = _splitters(sample, span, seed, bits, parts, every)
    ways = sum(len(c) + 1 for c in cuts.values())

    named = texts.join(lists, "h").select("doc", "h", "text", "codes").sortWithinPartitions("h")
    sorted_runs = named.mapInArrow(_suffix_runs(span, seed, bits, cuts), _RUN_SQL)
    packed = sorted_runs.repartitionById(ways, F.col("part")).mapInArrow(_packed(_merged(span, seed), tasks), _SPANS_SQL)
    packed = packed.repartitionById(tasks, F.col("bucket")).sortWithinPartitions("bucket")
    spans = materialize(packed.mapInArrow(_by_document, "doc long, h long, spans binary"), "suffix-spans")
    return rows, spans.select("doc", "h", F.array("spans").alias("spans"))


def _remove(with_text: bool):
    """Texts and their spans -> what is left of them."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            lists = batch.column("spans").to_pylist()
            out = []
            for i, spans in enumerate(lists):
                pairs = np.frombuffer(b"".join(spans), "<u4").reshape(-1, 2).astype(np.int64)
                _, start, end = merge_spans(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
                body = data[offsets[i]:offsets[i + 1]]
                kept = hashlib.sha256() if not with_text else []
                add = kept.append if with_text else kept.update
                for a, b in zip([0, *end.tolist()], [*start.tolist(), len(body)]):
                    add(body[a:b].tobytes())
                out.append((int((end - start).sum()), len(start), b"".join(kept) if with_text else kept.hexdigest()))
            n, count, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("h"), pa.array(n, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(kept, pa.binary() if with_text else pa.string())], ["doc", "h", "n_removed", "n_spans", "kept"])

    return remove


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (or, ``with_text``, the bytes ``kept``) of every row of ``docs``.

    A document loses all bytes covered by a string of ``span`` bytes of its
    UTF-8 text that also starts in a document with a smaller id; strings are
    judged on the input, overlaps count.  Rows of one id are one document: they
    do not cost each other anything, and are cut one by one.  Null ids count
    as one id behind all others; null texts as empty.  Texts shorter than
    ``span`` lose nothing, texts of any length are worked on in pieces.  Ties
    cannot occur.  An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    with settings(docs.sparkSession, STAGED):
        rows, spans = repeated_spans(docs, doc_id, text, span)
    texts = _keyed(docs, doc_id, text).select("doc", "h", "text")
    out = "doc long, h long, n_removed long, n_spans long, kept " + ("binary" if with_text else "string")
    cut = texts.join(spans, ["doc", "h"]).mapInArrow(_remove(with_text), out).dropDuplicates(["doc", "h"])
    done = rows.join(cut, ["doc", "h"], "left")
    if with_text:
        same = rows.filter("NOT whole").select("doc", "h").distinct().join(spans, ["doc", "h"], "left_anti")
        same = texts.join(same, ["doc", "h"]).select("doc", "h", F.encode("text", "UTF-8").alias("untouched")).dropDuplicates(["doc", "h"])
        done, nothing = done.join(same, ["doc", "h"], "left"), F.lit(b"")
    else:
        done, nothing = done.withColumn("untouched", F.col("sha")), F.lit(hashlib.sha256(b"").hexdigest())
    return done.select(
        "doc_id", "n_bytes", F.when(F.col("whole"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("whole"), 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("whole"), nothing).when(F.col("kept").isNotNull(), F.col("kept")).otherwise(F.col("untouched")).alias("kept" if with_text else "kept_sha256"))

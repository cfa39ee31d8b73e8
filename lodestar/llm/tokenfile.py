"""Token-id files: patched frame-of-reference blocks.

Ids are cut into blocks of ``BLOCK``.  A block stores its minimum, and each
id's difference from it in as many bits as the ``PERCENTILE``-th percentile of
the differences needs; ids that need more keep their low bits in place and
their high bits in the block's exception list (position, high bits).  The
file ends with an index of block starts and an index of documents, so any
block or document can be read alone.

file  = magic, blocks, index, uint64 index start, uint64 blocks, uint64 documents, magic
block = uint32 n, uint32 minimum, uint32 exceptions, uint8 width,
        packed low bits, exception positions (uint16), exception high bits (uint32)
index = block starts (uint64 each), document ids (int64), document lengths (uint64), null marks (uint8)
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm.common import materialize, ship
from lodestar.llm.storage import create, open_file
from lodestar.session import scratch_path

MAGIC = b"LSPFOR01"
BLOCK = 1 << 13
PERCENTILE = 95
_RUN = 32  # blocks decoded at once when a file is read through
END_ID = 0
_HEAD, _TAIL = struct.Struct("<IIIB"), struct.Struct("<QQQ8s")
_CACHED_WORDS = 1_200_000  # pieces whose ids a worker remembers
_TEXT_BYTES = 1 << 22  # texts encoded at once


def _pack(values: np.ndarray, width: int) -> bytes:
    """Lowest ``width`` bits of each value, bit-packed."""
    kind = "<u2" if width <= 16 else "<u4"
    if width in (16, 32):
        return values.astype(kind).tobytes()
    low = (values & np.uint32((1 << width) - 1)).astype(kind)
    bits = np.unpackbits(low.view(np.uint8).reshape(len(low), -1), axis=1, bitorder="little", count=width)
    return np.packbits(bits, bitorder="little").tobytes()


@lru_cache(64)
def _places(n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit at which each of n packed values begins."""
    bit = np.arange(n, dtype=np.int64) * width
    return bit >> 3, (bit & 7).astype(np.uint64)


def _unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (16, 32):
        return np.frombuffer(data, "<u2" if width == 16 else "<u4").astype(np.uint32)
    byte, bit = _places(n, width)
    # eight bytes from every byte on: a value of up to 32 bits lies within the eight from its first
    words = np.ndarray((len(data),), "<u8", data + bytes(8), strides=(1,))
    return ((words[byte] >> bit) & np.uint64((1 << width) - 1)).astype(np.uint32)


def encode_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of 1..65536 ids (uint32)."""
    least = int(ids.min())
    diff = ids - np.uint32(least)
    rank = max(0, int(np.ceil(len(diff) * percentile / 100)) - 1)
    width = int(np.partition(diff, rank)[rank]).bit_length()
    high = diff >> np.uint32(width) if width < 32 else np.zeros_like(diff)
    where = np.flatnonzero(high)
    body = _pack(diff, width) if width else b""
    return (_HEAD.pack(len(ids), least, len(where), width) + body
            + where.astype("<u2").tobytes() + high[where].astype("<u4").tobytes())


def decode_block(data: bytes) -> np.ndarray:
    n, least, exceptions, width = _HEAD.unpack_from(data)
    at, size = _HEAD.size, (n * width + 7) // 8
    out = _unpack(data[at:at + size], n, width) if width else np.zeros(n, np.uint32)
    at += size
    where = np.frombuffer(data, "<u2", exceptions, at)
    out[where] |= np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions) << np.uint32(width)
    return out + np.uint32(least)


class Writer:
    """Streams documents into one file; holds one block and the indexes."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0
        self.starts, self.ids, self.lengths, self.nulls = [], [], [], []
        self.pending, self.held = [], 0
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(len(ids))
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            self._flush(self.held - self.held % BLOCK)

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint32)
        for a in range(0, n, BLOCK):
            self.starts.append(self.at)
            self._write(encode_block(flat[a:min(n, a + BLOCK)]))
        self.pending, self.held = [flat[n:]], len(flat) - n

    def close(self) -> None:
        self._flush(self.held)
        index = self.at
        self._write(np.array(self.starts, "<u8").tobytes() + np.array(self.ids, "<i8").tobytes()
                    + np.array(self.lengths, "<u8").tobytes() + np.array(self.nulls, np.uint8).tobytes())
        self._write(_TAIL.pack(index, len(self.starts), len(self.ids), MAGIC))
        self.stream.close()


class Reader:
    """Random access by block or document; ``documents`` streams the file."""

    def __init__(self, stream):
        self.stream, size = stream, stream.size()
        self.index, blocks, docs, magic = _TAIL.unpack(stream.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC or stream.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        data = stream.read_at(size - _TAIL.size - self.index, self.index)
        self.starts = np.append(np.frombuffer(data, "<u8", blocks), np.uint64(self.index)).astype(np.int64)
        self.ids = np.frombuffer(data, "<i8", docs, 8 * blocks)
        self.lengths = np.frombuffer(data, "<u8", docs, 8 * (blocks + docs)).astype(np.int64)
        self.nulls = np.frombuffer(data, np.uint8, docs, 8 * (blocks + 2 * docs)).astype(bool)
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths)))

    def block(self, i: int) -> np.ndarray:
        return decode_block(self.stream.read_at(int(self.starts[i + 1] - self.starts[i]), int(self.starts[i])))

    def tokens(self, start: int, n: int) -> np.ndarray:
        """Ids [start, start + n) of the file."""
        parts, at, end = [], start, start + n
        while at < end:
            ids = self.block(at // BLOCK)[at % BLOCK:][:end - at]
            parts.append(ids)
            at += len(ids)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(doc_id, offset in the file, its ids in pieces) of every document, in file order."""
        span, number, ids = _RUN * BLOCK, -1, np.zeros(0, np.uint32)

        def pieces(at: int, end: int) -> Iterator[np.ndarray]:
            nonlocal number, ids
            while at < end:
                if at // span != number:
                    number = at // span
                    last = min(len(self.starts) - 1, (number + 1) * _RUN)
                    ids = np.concatenate([self.block(i) for i in range(number * _RUN, last)])
                part = ids[at % span:at % span + end - at]
                yield part
                at += len(part)

        for doc, null, a, b in zip(self.ids.tolist(), self.nulls.tolist(), self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            yield None if null else doc, a, pieces(a, b)


class Encoder:
    """Whole texts to ids with the ``tokenizers`` library.

    A byte-level BPE never merges across a single space that is followed by a
    visible character, or around a line break before and after which there is
    no white space, so the ids of a text are those of its pieces between such
    places.  Pieces repeat: each distinct one of a batch is looked up once, and
    encoded once while it is remembered.  Texts with other white space, and
    other kinds of tokenizer, are encoded as they are.
    """

    _LINE = "\x01"  # marks a piece that no space precedes

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        spec = json.load(open(path, encoding="utf-8"))
        kind = spec.get("pre_tokenizer") or {}
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t["content"] for t in spec.get("added_tokens") or ()] + [self._LINE]
        self.marks = dict(zip(",.", self._plain([",", "."])))
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.by_piece = (spec.get("normalizer") is None and kind.get("type") == "ByteLevel" and kind.get("use_regex", True)
                         and not kind.get("add_prefix_space") and (spec.get("model") or {}).get("dropout") is None
                         and len(self.line) == 1)
        self.known: dict[str, bytes | None] = {"\n": np.array(self.line, "<u4").tobytes()}  # None: the text must be encoded as it is

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of new pieces."""
        known, new = self.known, []
        for p in pieces:
            known[p] = None  # white space of another kind, unless set below
            if p.isalpha() or p != self._LINE and p.split() == [p]:
                new.append(p)
        # many pieces as one text, a line break between them; cut again at the breaks
        groups = [new[a:a + 2000] for a in range(0, len(new), 2000)]
        texts = ["\n".join(p[1:] if p[0] == self._LINE else " " + p for p in g) for g in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.line[0]), len(ids)).tolist()
            data, begin = ids.tobytes(), 0
            for p, end in zip(group, ends):
                known[p] = data[4 * begin:4 * end]
                begin = end + 1

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none) one after another, and the offset at which each begins, with the end."""
        texts = pc.fill_null(texts, "")
        odd = np.full(len(texts), not self.by_piece)
        for mark in self.added:
            odd |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        lines = pc.binary_join_element_wise(self._LINE, pc.replace_substring(texts, "\n", " \n " + self._LINE), "")
        pieces = pc.split_pattern(lines, " ")
        code = pieces.flatten().dictionary_encode()
        distinct, at, first = code.dictionary.to_pylist(), code.indices.to_numpy(), pieces.offsets.to_numpy().astype(np.int64)
        # a comma or full stop after a letter is a piece of its own for the tokenizer: look up the word before it
        marks, known = self.marks, self.known
        tails = [p[-1:] if p[-1:] in marks and p[-2:-1].isalpha() else "" for p in distinct]
        distinct = [p[:-1] if t else p for p, t in zip(distinct, tails)]
        if len(known) > _CACHED_WORDS:  # forget the older half
            for p in list(islice(known, 1, _CACHED_WORDS // 2)):
                del known[p]
        if self.by_piece:
            self._learn([p for p in dict.fromkeys(distinct) if p not in known])
        ids = [known.get(p) for p in distinct]
        ids = [x + marks[t] if t and x is not None else x for x, t in zip(ids, tails)]
        unknown = np.fromiter((x is None for x in ids), bool, len(ids))
        odd |= np.logical_or.reduceat(unknown[at], first[:-1] - first[0]) if len(at) else False
        if odd.any():  # these texts as they are: one piece each
            where = np.flatnonzero(odd)
            keep = ~np.repeat(odd, np.diff(first))
            lengths = np.where(odd, 1, np.diff(first))
            first = np.concatenate(([0], np.cumsum(lengths)))
            whole = np.empty(first[-1], np.int64)
            whole[first[where]] = np.arange(len(ids), len(ids) + len(where))
            inside = np.ones(first[-1], bool)
            inside[first[where]] = False
            whole[inside] = at[keep]
            ids += self._plain(texts.take(pa.array(where)).to_pylist())
            at = whole
        ids = [x or b"" for x in ids]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin, flat = np.cumsum(size) - size, np.frombuffer(b"".join(ids), "<u4")
        n = size[at]
        ends = np.concatenate(([0], np.cumsum(n)))
        return flat[np.repeat(begin[at] - ends[:-1], n) + np.arange(ends[-1])], ends[first - first[0]]


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``_TEXT_BYTES`` of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    cuts = [0, *(np.flatnonzero(np.diff(size // _TEXT_BYTES)) + 1).tolist(), batch.num_rows]
    yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]))


def _write_part(folder: str, tokenizer: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, uri, writer, tokens = TaskContext.get().partitionId(), None, None, 0
        for batch in batches:
            for rows in _slices(batch):
                ids, offsets = _encoder(tokenizer).encode(rows.column("text"))
                ids = np.insert(ids, offsets[1:], end_id)
                offsets = (offsets + np.arange(len(offsets))).tolist()
                for doc, i, j in zip(rows.column("doc_id").to_pylist(), offsets, offsets[1:]):
                    if writer is None:
                        uri, stream = create(folder, part, ".tok")
                        writer = Writer(stream)
                    writer.add(doc, ids[i:j])
                tokens += len(ids)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [uri], "tokens": [tokens]})

    return write


def write_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode every text, append ``end_id``, write token files in ascending doc_id order.

    Returns the manifest (part, path, tokens, start): files in order, with the
    number of ids before each.  doc_id is an integer; null doc_ids come last;
    rows of one doc_id keep the order of the input, and may be dealt over
    several files.  Null texts are empty: the end id alone.  A text of any
    length is encoded whole; its ids may run over many blocks.  An empty table
    gives no file.  Other columns are ignored.  ``tokenizer`` is the path of a
    tokenizer file that every executor can read.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "tokens")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.col(doc_id).isNull().alias("last"), F.monotonically_increasing_id().alias("row"))
    order = ["last", "doc_id", "row"]
    ranged = rows.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order)
    manifest = materialize(ranged.select("doc_id", "text").mapInArrow(
        _write_part(folder, tokenizer, end_id), "part long, path string, tokens long"), "tokens-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


def read_tokens(spark: SparkSession, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ``ids``) of every document in the files."""
    ship(spark)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with open_file(path) as stream:
                    reader = Reader(stream)
                    rows, held = [], 0
                    for (doc, at, parts), n in zip(reader.documents(), reader.lengths.tolist()):
                        crc, ids = 0, []
                        for part in parts:
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                            if with_ids:
                                ids += part.tolist()
                        rows.append((doc, start + at, n, crc) + ((ids,) if with_ids else ()))
                        held += n if with_ids else 1
                        if held >= 200_000:
                            yield _batch(rows, with_ids)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, with_ids)

    files = max(1, manifest.count())  # one row per file
    return manifest.select("path", "start").repartition(files).mapInArrow(read, schema)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

"""Prefix trie of conversations over vertical bitmaps.

A turn is named by the digest of its role and text, so no text is moved.
Conversations, by rising id, are cut into shards of bounded size.  A shard is
indexed vertically: for every position and turn, the bitset of its
conversations that have this turn there.  A depth-first walk starts from the
set of all; a node's children are the intersections of its set with the
postings of the next position, taken only for postings that some conversation
of the rest names, so no empty intersection is made.  Popcounts are member
counts, and a node's set cut with the set of conversations of its length is
its end list.

A node is known across shards by the digest of its path.  Shards send one row
per node; sums over subtrees need no walk down the whole trie: every node is
owned by the shard of its smallest member, and each shard that has a node adds
up what it owns below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import materialize, ship
from lodestar.operators.ordering import dense_row_ids

SHARD = 1 << 15  # turns per shard; a conversation is never cut
ROOT = b"\0" * 16

_NODES = pa.schema([("shard", pa.int64()), ("local", pa.int32()), ("up", pa.int32()), ("key", pa.binary()), ("parent", pa.binary()),
                    ("depth", pa.int64()), ("n", pa.int64()), ("first", pa.int64()), ("bytes", pa.int64()), ("ends", pa.binary())])
_NODES_SQL = "shard long, local int, up int, key binary, parent binary, depth long, n long, first long, bytes long, ends binary"
_SUMS_SQL = ("key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, leaves long, saved long")


def numbered_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, pos (0, 1, ...), name (digest of role and text), bytes (of the text).

    Turns are ordered by ``turn`` (null first), turns of one number by their
    digest; null roles and texts count as empty, a text of any length is only
    digested; rows without a conversation id take no part.  One distributed
    sort numbers all rows, so no conversation is gathered."""
    said, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    name = F.sha2(F.encode(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, text_), "UTF-8"), 256)
    slim = rows.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.unhex(F.substring(name, 1, 32)).alias("name"), F.octet_length(text_).cast("long").alias("bytes"))
    rows = dense_row_ids(slim, "conv_id", "turn", "name", id_col="at")
    first = rows.groupBy("conv_id").agg(F.min("at").alias("from"))
    return rows.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("from")).alias("pos"), "name", "bytes")


def rebuild(turns: DataFrame, group: int = 5, longest: int = 9) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with the first h turns of c - c % group before its own turns from number h on,
    h = crc32(c) % longest: its turns (conv_id, pos, name, bytes), and all conversation ids."""
    counts = turns.groupBy("conv_id").agg(F.count("pos").alias("n"))
    c = F.col("conv_id")
    asked = F.crc32(F.encode(c.cast("string"), "UTF-8")) % longest
    ids = counts.select("conv_id", (c - c % group).alias("base"), asked.alias("h"))
    sizes = counts.select(F.col("conv_id").alias("base"), "n")
    ids = ids.join(sizes, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("head"))
    lent = turns.filter(F.col("pos") < longest - 1).withColumnRenamed("conv_id", "base")
    heads = ids.join(lent, "base").filter(F.col("pos") < F.col("h")).select("conv_id", "pos", "name", "bytes")
    own = turns.join(ids.select("conv_id", "h", "head"), "conv_id").filter(F.col("pos") >= F.col("h"))
    own = own.select("conv_id", (F.col("head") + F.col("pos") - F.col("h")).alias("pos"), "name", "bytes")
    return heads.unionByName(own), ids.select("conv_id")


def _members(bits: int, width: int) -> np.ndarray:
    """Positions of the bits that are set, rising."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes(width, "little"), np.uint8), bitorder="little"))


def _walk(table: pa.Table) -> pa.Table:
    """All nodes of one shard, in preorder."""
    table = table.sort_by([("conv_id", "ascending"), ("pos", "ascending")])
    conv, pos = table["conv_id"].to_numpy(), table["pos"].to_numpy()
    coded = table["name"].combine_chunks().dictionary_encode()
    token, names, size = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False), coded.dictionary.to_pylist(), table["bytes"].to_numpy()
    starts = np.flatnonzero(pos < 0)  # the row that stands for the conversation itself
    ids, lengths = conv[starts], np.diff(np.append(starts, len(conv))) - 1
    width = -(-len(ids) // 8)

    postings: dict[tuple[int, int], int] = {}  # (position, turn) -> its conversations
    taken: dict[int, int] = {}  # bytes of a turn's text
    number = np.cumsum(pos < 0) - 1
    for i, p, t, b in zip(number.tolist(), pos.tolist(), token.tolist(), size.tolist()):
        if p >= 0:
            postings[p, t] = postings.get((p, t), 0) | 1 << i
            taken[t] = b
    stop: dict[int, int] = {}  # length -> conversations of this length
    for i, n in enumerate(lengths.tolist()):
        stop[n] = stop.get(n, 0) | 1 << i
    begin, turn = (starts + 1).tolist(), token.tolist()

    out: dict[str, list] = {c: [] for c in _NODES.names}
    open_ = [((1 << len(ids)) - 1, 0, -1, ROOT, None, 0)]
    while open_:
        bits, depth, up, key, parent, last = open_.pop()
        ended = bits & stop.get(depth, 0)
        local = len(out["key"])
        for c, v in zip(_NODES.names, (0, local, up, key, parent, depth, bits.bit_count(), int(ids[(bits & -bits).bit_length() - 1]), last,
                                       ids[_members(ended, width)].astype("<i8").tobytes() if ended else b"")):
            out[c].append(v)
        rest, children = bits ^ ended, []
        while rest:
            t = turn[begin[(rest & -rest).bit_length() - 1] + depth]
            child = rest & postings[depth, t]
            rest ^= child
            children.append((child, depth + 1, local, hashlib.sha256(key + names[t]).digest()[:16], key, taken[t]))
        open_ += reversed(children)
    out["shard"] = [table["shard"][0].as_py()] * len(out["key"])
    return pa.Table.from_pydict(out, _NODES)


def _end_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, ends) sorted by key and shard -> digest of each key's whole list; one list of a shard is held at a time."""
    key, digest = None, None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for k, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            text = ",".join(map(str, np.frombuffer(ends, "<i8").tolist()))
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "ends_sha256"])
        done = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])


def _subtrees(table: pa.Table) -> pa.Table:
    """Sums over the subtrees of one shard's nodes of what the shard owns."""
    table = table.sort_by("local")
    up = table["up"].to_pylist()
    mine = table["owner"].to_numpy() == table["shard"].to_numpy()
    n, conv = table["n_convs"].to_numpy(), table["conv_id"].to_numpy()
    leaves = (mine & (table["n_children"].to_numpy() == 0)).astype(np.int64).tolist()
    saved = np.where(mine, (n - 1) * table["bytes"].to_numpy(), 0).tolist()
    for i in range(len(up) - 1, 0, -1):  # preorder: children come after their parent
        leaves[up[i]] += leaves[i]
        saved[up[i]] += saved[i]
    above = pa.array(conv[np.maximum(up, 0)], mask=np.array(up) < 0)
    return pa.Table.from_arrays([table["key"], table["conv_id"], table["depth"], above, table["n_convs"], table["n_children"],
                                 pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())],
                                [c.split()[0] for c in _SUMS_SQL.split(", ")])


def prefix_trie(turns: DataFrame, conversations: DataFrame, shard_turns: int = SHARD) -> DataFrame:
    """One row per distinct sequence of first turns: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: conv_id, pos (0, 1, ... without gaps), name (digest of a turn),
    bytes; ``conversations``: every conv_id once, those without turns too
    (members of the root alone).  ``conv_id`` is the smallest member; the root
    has depth 0 and no parent; ``saved_tokens`` sums (members - 1) x bytes of
    the last text over the subtree; ``ends_sha256`` digests the decimal ids of
    the members that end here, rising, comma-joined.  Conversations that are
    equal, in any number, are one path.  No conversation gives no row, not
    even a root.  Other columns are ignored.

    A shard holds about ``shard_turns`` turns; one conversation, of 24 bytes a
    turn, must fit a task.  End lists of any length are digested as a stream.
    """
    ship(turns.sparkSession)
    marks = conversations.select(F.col("conv_id"), F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("name"),
                                 F.lit(0).cast("long").alias("bytes"))
    rows = marks.unionByName(turns.select("conv_id", F.col("pos").cast("long").alias("pos"), "name", "bytes"))
    rows = dense_row_ids(rows, "conv_id", "pos", id_col="at", start=0)
    # the first row of a conversation, its mark, decides
    rows = rows.withColumn("shard", F.floor((F.col("at") - F.col("pos") - 1) / shard_turns))
    nodes = materialize(rows.groupBy("shard").applyInArrow(_walk, _NODES_SQL), "trie-nodes")

    merged = nodes.groupBy("key").agg(F.min("parent").alias("parent"), F.max("depth").alias("depth"), F.sum("n").alias("n_convs"),
                                      F.min("first").alias("conv_id"), F.max("bytes").alias("bytes"), F.min("shard").alias("owner"))
    merged = materialize(merged, "trie-merged")
    children = merged.groupBy(F.col("parent").alias("key")).agg(F.count("parent").alias("n_children"))
    merged = merged.drop("parent").join(children, "key", "left").fillna(0, ["n_children"])
    ends = nodes.filter(F.octet_length("ends") > 0).select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
    ends = ends.mapInArrow(_end_lists, "key binary, ends_sha256 string")

    located = nodes.select("shard", "local", "up", "key").join(merged, "key")
    sums = located.groupBy("shard").applyInArrow(_subtrees, _SUMS_SQL)
    whole = sums.groupBy("key").agg(*[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children")],
                                    F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    none = hashlib.sha256(b"").hexdigest()
    return whole.join(ends, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))

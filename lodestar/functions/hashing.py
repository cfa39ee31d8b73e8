"""Hashed features by built-in expressions (M6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The constants of Murmur3 (x86, 32 bits) and the seed that hashed term frequencies use.
C1, C2, ADD = 0xCC9E2D51, 0x1B873593, 0xE6546B64
FINAL1, FINAL2 = 0x85EBCA6B, 0xC2B2AE35
SEED = 42

_MASK = 0xFFFFFFFF


def _times(a: Column, c: int) -> Column:
    """a * c modulo 2^32, for 0 <= a < 2^32, without leaving 63 bits."""
    low, high = a * F.lit(c & 0xFFFF), (a * F.lit(c >> 16)).bitwiseAND(F.lit(0xFFFF))
    return (low + F.shiftleft(high, 16)).bitwiseAND(F.lit(_MASK))


def _rotated(a: Column, bits: int) -> Column:
    return F.shiftleft(a, bits).bitwiseAND(F.lit(_MASK)).bitwiseOR(F.shiftright(a, 32 - bits))


def _shift_xor(a: Column, *bits: int) -> Column:
    out = a
    for b in bits:
        out = out.bitwiseXOR(F.shiftright(a, b))
    return out


def with_hash_bucket(df: DataFrame, text: str, output: str, buckets: int) -> DataFrame:
    """``df`` with the feature number of a term, as ``HashingTF`` has it: the Murmur3
    of its UTF-8 bytes as a signed number, modulo ``buckets`` (null: null).

    The SQL function ``hash`` is the same Murmur3 for whole groups of four
    bytes, but mixes the last one to three bytes in another way.  So the whole
    groups are hashed by it, its final mixing is taken back, and the rest is
    mixed in here.  Each step is a projection of its own: all of it is
    generated code, and no step repeats the one before."""
    h, k = "_murmur_h", "_murmur_k"
    body, size = F.encode(F.col(text), "UTF-8"), F.octet_length(text)
    whole = size - size % 4
    byte = lambda j: F.coalesce(F.conv(F.hex(F.substring(body, whole + F.lit(1 + j), F.lit(1))), 16, 10).cast("long"), F.lit(0))
    out = df.withColumns({h: F.pmod(F.hash(F.substring(body, F.lit(1), whole)).cast("long"), F.lit(1 << 32)),
                          k: byte(0) + F.shiftleft(byte(1), 8) + F.shiftleft(byte(2), 16)})
    back = [lambda x: _shift_xor(x, 16), lambda x: _times(x, pow(FINAL2, -1, 1 << 32)), lambda x: _shift_xor(x, 13, 26),
            lambda x: _times(x, pow(FINAL1, -1, 1 << 32)), lambda x: _shift_xor(x, 16).bitwiseXOR(whole.cast("long"))]
    rest = [lambda x: _times(x, C1), lambda x: _rotated(x, 15), lambda x: _times(x, C2)]
    for step in back:
        out = out.withColumn(h, step(F.col(h)))
    for step in rest:
        out = out.withColumn(k, step(F.col(k)))
    out = out.withColumn(h, F.col(h).bitwiseXOR(F.col(k)).bitwiseXOR(size.cast("long")))
    for step in (lambda x: _shift_xor(x, 16), lambda x: _times(x, FINAL1), lambda x: _shift_xor(x, 13), lambda x: _times(x, FINAL2),
                 lambda x: _shift_xor(x, 16)):
        out = out.withColumn(h, step(F.col(h)))
    signed = F.when(F.col(h) > 0x7FFFFFFF, F.col(h) - F.lit(1 << 32)).otherwise(F.col(h))
    number = F.when(F.col(text).isNotNull(), F.pmod(signed, F.lit(buckets).cast("long")))
    return out.withColumn(output, number).drop(h, k)

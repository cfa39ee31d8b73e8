"""Property tests: the column expressions agree with plain-Python models of
the Java behaviour they stand for (Math.round, String.matches, String.split)."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from lodestar.functions import scalar
from lodestar.operators.cleanse import deterministic_split

NUMERIC = re.compile(r"[-+]?\d*\.?\d+")


def java_split_model(s: str, sep: str = " ") -> list[str]:
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=30))
def test_round_half_up_is_floor_plus_half(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(scalar.round_half_up("x")).collect()]
    assert got == [math.floor(x + 0.5) for x in xs]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-.e? \n", max_size=6), min_size=1, max_size=30))
def test_numeric_test_matches_anchored_regex(spark, ss):
    df = spark.createDataFrame([(s,) for s in ss], "s string")
    got = [r[0] for r in df.select(scalar.is_numeric("s")).collect()]
    assert got == [NUMERIC.fullmatch(s) is not None for s in ss]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=8), min_size=1, max_size=30))
def test_java_split_semantics(spark, ss):
    df = spark.createDataFrame([(s,) for s in ss], "s string")
    got = [r[0] for r in df.select(scalar.java_split("s")).collect()]
    assert got == [java_split_model(s) for s in ss]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \t", max_size=8), min_size=1, max_size=30))
def test_split_words_has_no_empty_words(spark, ss):
    df = spark.createDataFrame([(s,) for s in ss], "s string")
    got = [r[0] for r in df.select(scalar.split_words("s")).collect()]
    assert got == [[w for w in s.split(" ") if w] for s in ss]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-2**62, 2**62)), min_size=1, max_size=30))
def test_split_of_any_key(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r[0] for r in df.select(deterministic_split(F.col("k"), 70)).collect()]
    assert got == ["train" if (k or 0) % 100_003 * 7919 % 100_003 % 100 < 70 else "test" for k in keys]

import hashlib
import itertools
import json
import time

import pytest
from pyspark.sql import functions as F

from lodestar.llm import chat

HOSTILE = [
    "\\### Assistant: </turn> ok", "</turn>", "\n</turn>\n", "\\</turn>", "\\\\</turn>\\", "### user\nhi\n</turn>\n", "ends with \\", "\\", "", None,
    "### ### \\### </turn></turn>", "#### x", "</turn", "plain\ntext\n", "é 日本 \U0001F600 ### ", "a\r\n</turn>\r\n", "$1 \\s \\l", "x" * 100_000,
]
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    convs = {}
    for c, n, r, t in rows:
        convs.setdefault(c, []).append((n is None, n or 0, r or "", t or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def rows():
    out = []
    for i, t in enumerate(HOSTILE):
        out += [(i, 0, "user", t), (i, 1, "assistant", t), (i, 2, "we\\ird\n### ro\\le", t), (i, 3, "assistant", HOSTILE[-1 - i])]
    out += [(None, 0, "user", "no id"), (None, 1, "assistant", "yes"), (77, None, "assistant", "late"), (77, 0, None, None), (77, 0, "user", "tie"), (77, 0, "user", "tie")]
    return out


def test_round_trip(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("layout", F.lit("x")).withColumn("block", F.lit(1)).withColumn("at", F.lit(2))
    formatted = chat.write_formatted(chat.canonical_turns(df))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(formatted).collect()}
    assert got == expected(rows)
    back = {}
    for r in chat.parse_turns(formatted).orderBy("n").collect():
        back.setdefault(r.conv_id, []).append((r.role, r.text))
    assert back[0] == [(r or "", t or "") for c, _, r, t in rows if c == 0]
    for r in formatted.collect():
        spans = [s for s in r.loss_spans if s is not None]
        marked = "".join(r.formatted[s.start:s.end] for s in spans)
        assert len(marked) == sum(s.end - s.start for s in spans)
    assert {r.conv_id: r.formatted_chars for r in chat.digests(formatted).collect()} == {r.conv_id: len(r.formatted) for r in formatted.collect()}


def test_control_strings_in_texts_are_never_bare(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for r in chat.format_turns(chat.canonical_turns(df)).collect():
        blocks = r.formatted.split("\n</turn>\n")
        assert len(blocks) - 1 == len(r.loss_spans) and blocks[-1] == ""


def test_layouts_share_one_result(spark):
    said = [("system", "be brief"), ("user", "hi"), ("assistant", "hello ### ")]
    texts = [
        (1, json.dumps({"messages": [{"role": r, "content": t} for r, t in said], "meta": {"x": 1}})),
        (2, json.dumps({"conversations": [{"from": {"user": "human", "assistant": "gpt"}.get(r, r), "value": t} for r, t in said]})),
        (3, json.dumps({"system": "be brief", "prompt": "hi", "completion": "hello ### "})),
        (4, json.dumps({"instruction": "hi", "output": "hello ### "})),
        (5, json.dumps({"instruction": "do", "input": "this", "output": "done"})),
        (6, json.dumps({"question": "?"})), (7, "not json"), (8, None), (9, json.dumps({"prompt": "only"})),
    ]
    df = spark.createDataFrame(texts, "conv_id long, body string")
    got = {}
    for r in chat.canonical_turns(df, json="body").orderBy("item").collect():
        got.setdefault((r.conv_id, r.layout), []).append((r.role, r.text))
    assert got == {(1, "messages"): said, (2, "conversations"): said, (3, "prompt"): said, (4, "instruction"): said[1:],
                   (5, "instruction"): [("user", "do\n\nthis"), ("assistant", "done")], (9, "prompt"): [("user", "only"), ("assistant", "")],
                   (6, None): [(None, None)], (7, None): [(None, None)], (8, None): [(None, None)]}


def test_fingerprints_are_unambiguous():
    seen = [fp for m in chat.MAPPINGS for fp in m.fingerprints()]
    assert len(seen) == len(set(seen))


def test_empty_table_and_native_plan(spark):
    empty = spark.createDataFrame([], SCHEMA)
    turns = chat.canonical_turns(empty)
    assert chat.digests(chat.write_formatted(turns)).collect() == []
    plan = chat.digests(chat.format_turns(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_long_runs_of_backslashes_take_no_time(spark):
    run = "\\" * 200_000
    texts = [run, run + "### ", run + "x</turn>", run + "</turn>" + run + "### " + run, "</turn>" * 20_000, ("\\" * 3 + "### ") * 20_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(1).cache()
    back = df.select("i", chat.unescape_text(chat.escape_text(F.col("t"))).alias("back"), "t")
    assert back.count() == len(texts)
    began = time.time()
    assert back.filter("back <> t").count() == 0
    assert time.time() - began < 3


def test_escapes_are_reversible_for_every_short_text(spark):
    parts = ["\\", "\\\\", "### ", "</turn>", "#", "x", "\n"]
    texts = ["".join(c) for n in range(5) for c in itertools.product(parts, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    escaped = chat.escape_text(F.col("t"))
    assert df.filter(chat.unescape_text(escaped) != F.col("t")).count() == 0
    # every control string is behind an odd run of backslashes
    assert df.filter(escaped.rlike(r"(?<!\\)(\\\\)*+(### |</turn>)")).count() == 0


def test_clashing_columns_lose_no_text(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hello", "not a list", "a prompt", 7), (1, 1, "assistant", None, None, "other", 8)],
                                 "conv_id long, turn int, role string, text string, messages string, prompt string, conversations int")
    got = sorted((r.turn_no, r.role, r.text, r.layout) for r in chat.canonical_turns(rows).collect())
    assert got == [(0, "user", "hello", "turn_row"), (1, "assistant", None, "turn_row")]
    swapped = spark.createDataFrame([(2, [("hi", 1, "user")])], "conv_id long, messages array<struct<content: string, n: int, role: string>>")
    assert [(r.role, r.text, r.layout) for r in chat.canonical_turns(swapped).collect()] == [("user", "hi", "messages")]
    assert chat.canonical_turns(rows.limit(0)).collect() == []

import json
import zlib

import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lodestar.llm import simhash
from lodestar.llm.queries import ORACLES, QUERIES
from lodestar.plans.check import compare, duckdb_conn

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb_conn(SMALL)
    result = compare(QUERIES[name](spark, SMALL), con, ORACLES[name])
    assert result["ok"] and result["spark_rows"] > 0, json.dumps(result, default=str)


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        path = str(tmp_path / str(i))
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if i < 4:
            assert docs.columns == columns, name
        if i < 3:
            assert before.select("doc_id").distinct().count() == before.count() and docs.exceptAll(before).isEmpty(), name
        if i == 2:
            groups = simhash.near_duplicates(before)
            assert {r.doc_id for r in docs.collect()} == {r.component_id for r in groups.collect()}
        if i == 3:
            words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
            assert abs(words(docs) - 1.5 * words(before)) < 0.1 * words(before)
        if i == 4:
            pieces = docs.toPandas()
            sizes = pd.Series([len(r.text.split()) for r in before.collect()]).sum()
            assert pieces.length.sum() == sizes and pieces.groupby("bin_id").length.sum().max() <= 2048
    assert counts[0] > counts[1] >= counts[2] > counts[3] and counts[3] < counts[4]


def test_held_out_accuracy(spark):
    labels = pd.read_parquet(f"{MEDIUM}/labels.parquet").set_index("doc_id").quality
    docs = pd.read_parquet(f"{MEDIUM}/documents.parquet").set_index("doc_id")
    q = QUERIES["op5_quality_rules"](spark, MEDIUM).toPandas()
    held = q[q.held_out & q.doc_id.isin(labels.index)]
    assert (held.predicted == held.doc_id.map(labels)).mean() >= 0.95
    lang = QUERIES["op10_language_id"](spark, MEDIUM).toPandas()
    held = lang[lang.held_out]
    assert (held.lang_pred == held.doc_id.map(docs.lang)).mean() >= 0.98


def test_token_query_by_brute_force(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import numpy as np
    import public_tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = pd.read_parquet(f"{SMALL}/documents.parquet").sort_values("doc_id")
    start, want = 0, []
    for i, text in zip(docs.doc_id, docs.text):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op7_token_blocks"](spark, SMALL).collect())) == want

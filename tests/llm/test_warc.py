import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from lodestar.llm import warc
from lodestar.llm.storage import open_file

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    first = {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        p = (h or "").encode()
        if len(p) >= 100:
            first.setdefault(p, i)
    seen, out = set(), []
    for i, u, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        p = (h or "").encode()
        again = len(p) >= 100 and p in seen
        seen.add(p)
        out.append((None if i is None else str(i), u, "revisit" if again else "response", None if not again or first[p] is None else str(first[p]),
                    len(p), hashlib.sha256(p).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    big = "long påge " * 40_000
    return [(3, "http://a/é?q=1\r\nX: y", "<p>" + "x" * 200), (1, None, "<p>" + "x" * 200), (2, "u", "<p>" + "x" * 200), (2, "u", "<p>" + "x" * 200),
            (4, "", None), (5, "u%20v w", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", big), (9, "u", big), (10, "u", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 9),
            (None, "n", "y" * 100), (None, "n", "y" * 100), (11, "n", "z" * 99), (12, "n", "z" * 99)]


@pytest.mark.parametrize("chunk", [1000, 1 << 16])
def test_round_trip(spark, rows, chunk):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("row", F.lit(1)).withColumn("key", F.lit("k")).withColumn("digest", F.lit("d"))
    manifest = warc.write_archives(df, "page_id", "html", "url", chunk_bytes=chunk)
    got = warc.read_archives(spark, manifest, chunk_bytes=chunk).collect()
    last = sorted(((r.record_key, r.target_uri, r.record_type, r.refers_to, r.total_bytes, r.digest) for r in got if r.is_last), key=str)
    assert last == expected(rows)
    assert all(r.n_bytes <= chunk and r.n_bytes == len(r.data) for r in got)
    texts = {i: (h or "").encode() for i, _, h in rows}
    by_record = {}
    for r in sorted(got, key=lambda r: (r.record_id, r.chunk_no)):
        if r.record_type == "response":
            so_far = by_record.setdefault(r.record_id, [r.record_key, b""])
            so_far[1] += bytes(r.data)
            assert r.digest == hashlib.sha256(so_far[1]).hexdigest() and r.total_bytes == len(so_far[1])  # digests run along the chunks
    for key, body in by_record.values():
        assert key is None or body == texts[int(key)]


def test_archives_are_plain_warc(spark, rows):
    manifest = warc.write_archives(spark.createDataFrame(rows[:3], SCHEMA), "page_id", "html", "url").collect()
    with open_file(manifest[0].path) as f:
        text = gzip.decompress(f.read())
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.count(b"WARC/1.1\r\n") == 3 and text.endswith(b"\r\n\r\n")
    assert sum(m.records for m in manifest) == 3


def test_empty_table(spark):
    manifest = warc.write_archives(spark.createDataFrame([], SCHEMA), "page_id", "html", "url")
    assert manifest.count() == 0 and warc.read_archives(spark, manifest).collect() == []


def test_damage_is_noticed(spark, rows, tmp_path):
    manifest = warc.write_archives(spark.createDataFrame(rows[6:7], SCHEMA), "page_id", "html", "url").first()
    with open_file(manifest.path) as f:
        text = gzip.decompress(f.read())
    import io

    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(text.replace(b"short", b"shore"))), 100, True))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(text[:-8])), 100, True))

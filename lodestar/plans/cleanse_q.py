"""Cleansing and scalar-function queries; the CSV/JSON round trips live here too."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.fixed import (
    CLASSIFIER_TRAIN_PERCENT, MISSING_FILL, MISSING_MARKER, NUMERIC_PATTERN, RECODE_EQUAL, RECODE_OTHER,
)
from lodestar.functions.scalar import is_numeric, split_words
from lodestar.operators import cleanse
from lodestar.operators.partitioning import spread
from lodestar.plans.registry import query
from lodestar.session import scratch_path
from lodestar.sources import files
from lodestar.sources.tables import load

LINEITEM_FIELDS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"),
]


@query(
    "parse_delimited",
    sql="SELECT " + ", ".join(n for n, _ in LINEITEM_FIELDS) + " FROM lineitem",
)
def parse_delimited(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", *[n for n, _ in LINEITEM_FIELDS])
    lines = li.select(cleanse.to_line([n for n, _ in LINEITEM_FIELDS]).alias("value"))
    return lines.select(*cleanse.parse_line("value", LINEITEM_FIELDS))


@query(
    "line_rewrite",
    sql="""
SELECT p_partkey,
       concat_ws(',', CAST(floor(p_retailprice + 0.5) AS BIGINT),
                      CAST(floor(CAST(p_size AS DOUBLE) + 0.5) AS BIGINT),
                      upper(p_name)) AS line
FROM part
""",
)
def line_rewrite(spark, sf_dir):
    part = load(spark, sf_dir, "part", "p_partkey", "p_retailprice", "p_size", "p_name")
    lines = part.select("p_partkey", cleanse.to_line(["p_retailprice", "p_size", "p_name"]).alias("value"))
    return lines.select("p_partkey", cleanse.rewrite_line("value").alias("line"))


ORDERS_FIELDS = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderpriority", "string"),
]


@query(
    "typed_cast",
    sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def typed_cast(spark, sf_dir):
    # Export without header, read back positionally (all strings, _c0.._c4),
    # then apply the target schema by position.
    orders = load(spark, sf_dir, "orders", *[n for n, _ in ORDERS_FIELDS])
    path = scratch_path(spark, "orders-csv")
    files.write_csv(orders, path, header=False)
    raw = files.read_csv(spark, path, header=False)
    return cleanse.positional_retype(raw, ORDERS_FIELDS)


@query("scan_csv_roundtrip", sql="SELECT * FROM customer")
def scan_csv_roundtrip(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer-csv")
    files.write_csv(customer, path, header=True)
    return files.read_csv(spark, path, schema=customer.schema, header=True)


@query("scan_json_roundtrip", sql="SELECT * FROM nation")
def scan_json_roundtrip(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    path = scratch_path(spark, "nation-json")
    files.write_json(nation, path)
    return files.read_json(spark, path, schema=nation.schema)


@query("scan_csv_semicolon_parts", sql="SELECT * FROM supplier",
       note="S4 + S11: a folder of ';' parts of which only some begin with the header")
def scan_csv_semicolon_parts(spark, sf_dir):
    supplier = load(spark, sf_dir, "supplier")
    path = scratch_path(spark, "supplier-parts")
    odd = F.col("s_suppkey") % 2 == 1
    files.write_csv(supplier.filter(odd), path, header=True, sep=";", mode="append")
    files.write_csv(supplier.filter(~odd), path, header=False, sep=";", mode="append")
    return files.read_csv_parts(spark, path, supplier.schema, sep=";")


@query("scan_json_inferred", sql="SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
       note="S5 as in the reference: no schema given, whole numbers are read as bigint")
def scan_json_inferred(spark, sf_dir):
    path = scratch_path(spark, "customer-json")
    files.write_json(load(spark, sf_dir, "customer"), path)
    return files.read_json(spark, path)


IMPUTE_FILL = MISSING_FILL


@query(
    "impute_marker",
    sql=f"""
SELECT event_id, CASE WHEN event_type = 'error' THEN CAST({IMPUTE_FILL} AS DOUBLE) ELSE value END AS value_filled
FROM events
""",
    note="events render error readings as the marker '?'; every row is kept",
)
def impute_marker(spark, sf_dir):
    events = load(spark, sf_dir, "events", "event_id", "event_type", "value")
    raw = events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(MISSING_MARKER))
        .otherwise(F.col("value").cast("string")).alias("value_text"),
    )
    return cleanse.impute_marker(raw, "value_text", IMPUTE_FILL, MISSING_MARKER, alias="value_filled") \
        .select("event_id", "value_filled")


@query(
    "recode_binary",
    sql="SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 2.0 END::DOUBLE AS segment_code FROM customer",
)
def recode_binary(spark, sf_dir):
    customer = load(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return cleanse.recode_binary(customer, "c_mktsegment", "BUILDING", RECODE_EQUAL, RECODE_OTHER,
                                 alias="segment_code") \
        .select("c_custkey", "segment_code")


ORDER_STATUSES = ["F", "O", "P"]


@query(
    "indicator_columns",
    sql="""
SELECT o_orderkey,
       CAST(o_orderstatus = 'F' AS DOUBLE) AS o_orderstatus_f,
       CAST(o_orderstatus = 'O' AS DOUBLE) AS o_orderstatus_o,
       CAST(o_orderstatus = 'P' AS DOUBLE) AS o_orderstatus_p
FROM orders
""",
)
def indicator_columns(spark, sf_dir):
    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    return cleanse.indicator_columns(orders, "o_orderstatus", ORDER_STATUSES).drop("o_orderstatus")


SPLIT_TRAIN_PERCENT = CLASSIFIER_TRAIN_PERCENT


@query(
    "train_test_split",
    sql=f"""
SELECT o_orderkey,
       CASE WHEN ((o_orderkey % 100003 + 100003) % 100003 * 7919 % 100003) % 100 < {SPLIT_TRAIN_PERCENT}
            THEN 'train' ELSE 'test' END AS split
FROM orders
""",
)
def train_test_split(spark, sf_dir):
    orders = load(spark, sf_dir, "orders", "o_orderkey")
    return orders.select("o_orderkey", cleanse.deterministic_split(F.col("o_orderkey"), SPLIT_TRAIN_PERCENT).alias("split"))


@query(
    "is_numeric_flag",
    sql=f"""
WITH w AS (
  SELECT doc_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS words FROM documents
)
SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words,
       CAST(len(list_filter(words, lambda x: regexp_full_match(x, '{NUMERIC_PATTERN[1:-2]}'))) AS INTEGER) AS n_numeric
FROM w
""",
)
def is_numeric_flag(spark, sf_dir):
    docs = spread(load(spark, sf_dir, "documents", "doc_id", "text"))
    words = split_words("text")
    return docs.select(
        "doc_id",
        F.size(words).alias("n_words"),
        F.size(F.filter(words, lambda w: is_numeric(w))).alias("n_numeric"),
    )


@query(
    "mean_skip_invalid",
    sql=f"""
WITH w AS (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
SELECT CAST(printf('%.9e', avg(CAST(word AS DOUBLE))) AS DOUBLE) AS mean_value,
       count(*) AS n_valid
FROM w WHERE regexp_full_match(word, '{NUMERIC_PATTERN[1:-2]}')
""",
    note="mean of the numeric words of all documents",
)
def mean_skip_invalid(spark, sf_dir):
    from lodestar.operators.relational import mean_skip_invalid as _mean

    docs = spread(load(spark, sf_dir, "documents", "text"))
    words = docs.select(F.explode(F.split("text", " ")).alias("word"))
    # ten significant digits: the sum of doubles depends on the order of partitions
    return _mean(words, "word", alias="mean_value").withColumn(
        "mean_value", F.format_string("%.9e", "mean_value").cast("double"))


@query(
    "observed_load",
    sql=f"""
WITH w AS (SELECT unnest(string_split(text, ' ')) AS word FROM documents),
     v AS (SELECT word, regexp_full_match(word, '{NUMERIC_PATTERN[1:-2]}') AS valid FROM w)
SELECT count(*) AS n_read, count(*) FILTER (NOT valid) AS n_skipped,
       CAST(printf('%.9e', avg(CASE WHEN valid THEN CAST(word AS DOUBLE) END)) AS DOUBLE) AS mean_value,
       count(*) FILTER (valid) AS n_written
FROM v
""",
    note="A1/A5 in one pass: rows read, rows skipped and the mean, gathered while the numeric words are written",
)
def observed_load(spark, sf_dir):
    from lodestar.functions.scalar import is_numeric
    from lodestar.session import scratch_path
    from lodestar.sources.files import write_observed

    docs = spread(load(spark, sf_dir, "documents", "text"))
    words = docs.select(F.explode(F.split("text", " ")).alias("word"))
    valid, path = is_numeric("word"), scratch_path(spark, "observed")
    seen = write_observed(words, path, keep=valid, n_read=F.count(F.lit(1)), n_skipped=F.count_if(~valid),
                          mean_value=F.avg(F.when(valid, F.col("word").cast("double"))))
    row = spark.createDataFrame([(seen["n_read"], seen["n_skipped"], seen["mean_value"])], "n_read long, n_skipped long, mean_value double")
    written = spark.read.parquet(path).agg(F.count(F.lit(1))).scalar()
    return row.select("n_read", "n_skipped", F.format_string("%.9e", "mean_value").cast("double").alias("mean_value"), written.alias("n_written"))

"""Relational queries: projection, filters, joins, aggregates, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import relational as rel
from lodestar.plans.registry import query
from lodestar.sources.tables import load

# Query parameter (ours): price threshold of the flagship filter, in the role of the reference's age > 30.
FLAGSHIP_MIN_PRICE = 100000.0


@query(
    "filter_join_agg",
    sql=f"""
SELECT c.c_mktsegment,
       round(avg(o.o_totalprice), 4) AS avg_o_totalprice,
       max(o.o_totalprice) AS max_o_totalprice,
       count(*) AS n_rows
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_totalprice > {FLAGSHIP_MIN_PRICE}
GROUP BY c.c_mktsegment
""",
)
def filter_join_agg(spark, sf_dir):
    orders = load(spark, sf_dir, "orders", "o_custkey", "o_totalprice")
    customer = load(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    out = rel.filter_join_aggregate(
        orders, customer, "o_custkey", "c_custkey", "c_mktsegment", "o_totalprice",
        F.col("o_totalprice") > F.lit(FLAGSHIP_MIN_PRICE),
    )
    return out.select(
        "c_mktsegment",
        F.round("avg_o_totalprice", 4).alias("avg_o_totalprice"),
        "max_o_totalprice",
        "n_rows",
    )


@query(
    "filter_join_agg_columns",
    sql="""
SELECT s.s_nationkey, round(avg(l.l_extendedprice), 4) AS avg_l_extendedprice, max(l.l_discount) AS max_l_discount, count(*) AS n_rows
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE l.l_quantity > 30
GROUP BY s.s_nationkey
""",
    note="J2 as in the reference: predicate, mean and maximum on three different columns",
)
def filter_join_agg_columns(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    supplier = load(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    out = rel.filter_join_aggregate(lines, supplier, "l_suppkey", "s_suppkey", "s_nationkey", "l_extendedprice",
                                    F.col("l_quantity") > F.lit(30.0), max_of="l_discount")
    return out.withColumn("avg_l_extendedprice", F.round("avg_l_extendedprice", 4))


@query("select_cols", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_cols(spark, sf_dir):
    return rel.select_cols(load(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_totalprice")


# Query parameter (ours): equality probe, in the role of the reference's age == 40.
EQ_QUANTITY = 40.0


@query("filter_eq", sql=f"SELECT * FROM lineitem WHERE l_quantity = {EQ_QUANTITY}")
def filter_eq(spark, sf_dir):
    return rel.filter_eq(load(spark, sf_dir, "lineitem"), "l_quantity", EQ_QUANTITY)


@query(
    "filter_gt_select",
    sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000",
)
def filter_gt_select(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return rel.filter_gt(orders, "o_totalprice", 200000.0).select("o_orderkey", "o_totalprice")


@query("sql_where", sql="SELECT * FROM part WHERE p_retailprice > 915")
def sql_where(spark, sf_dir):
    # P4 + P21: register the table as a view and query it with SQL.
    load(spark, sf_dir, "part").createOrReplaceTempView("part")
    return spark.sql("SELECT * FROM part WHERE p_retailprice > 915")


@query(
    "filter_contains_count",
    sql="SELECT count(*) AS n FROM documents WHERE contains(text, 'the')",
)
def filter_contains_count(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "text")
    return rel.count_rows(rel.filter_contains(docs, "text", "the"))


@query(
    "filter_startswith",
    sql="SELECT page_id, url FROM pages WHERE starts_with(url, 'https://')",
)
def filter_startswith(spark, sf_dir):
    pages = load(spark, sf_dir, "pages", "page_id", "url")
    return rel.filter_startswith(pages, "url", "https://")


# Java's toUpperCase applies the full Unicode mapping, where 'ß' becomes "SS";
# DuckDB's upper keeps it as one letter, so the oracle spells that mapping out.
@query(
    "upper_lines",
    sql="SELECT doc_id, upper(replace(text, 'ß', 'SS')) AS upper_text FROM documents",
)
def upper_lines(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", F.upper("text").alias("upper_text"))


@query(
    "join_inner",
    sql="""
SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_nationkey, n.n_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
)
def join_inner(spark, sf_dir):
    from lodestar.operators.joins import inner_join

    customer = load(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    nation = load(spark, sf_dir, "nation", "n_nationkey", "n_name")
    out = inner_join(customer, nation, customer.c_nationkey == nation.n_nationkey,
                     broadcast_right=True, max_rows=10_000)
    return out.select("c_custkey", "c_name", "c_nationkey", "n_nationkey", "n_name")


@query(
    "dimension_lookup",
    sql="""
SELECT c.c_custkey, n.n_name, r.r_name
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""",
)
def dimension_lookup(spark, sf_dir):
    from lodestar.operators.joins import lookup

    customer = load(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = load(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = load(spark, sf_dir, "region", "r_regionkey", "r_name")
    # Resolve the two small code tables into one first, then one lookup on the fact.
    geo = lookup(nation, region, "n_regionkey", "r_regionkey", max_rows=10_000)
    out = lookup(customer, geo.select("n_nationkey", "n_name", "r_name"),
                 "c_nationkey", "n_nationkey", max_rows=100_000)
    return out.select("c_custkey", "n_name", "r_name")


@query("count_rows", sql="SELECT count(*) AS n FROM lineitem")
def count_rows(spark, sf_dir):
    return rel.count_rows(load(spark, sf_dir, "lineitem", "l_orderkey"))


@query(
    "group_count",
    sql="SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
)
def group_count(spark, sf_dir):
    return rel.group_count(load(spark, sf_dir, "orders", "o_orderstatus"), "o_orderstatus")


@query(
    "group_avg_max",
    sql="""
SELECT l_returnflag, round(avg(l_extendedprice), 4) AS avg_extendedprice,
       max(l_quantity) AS max_quantity
FROM lineitem GROUP BY l_returnflag
""",
)
def group_avg_max(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_returnflag", "l_extendedprice", "l_quantity")
    return li.groupBy("l_returnflag").agg(
        F.round(F.avg("l_extendedprice"), 4).alias("avg_extendedprice"),
        F.max("l_quantity").alias("max_quantity"),
    )


@query(
    "sql_group_order",
    sql="""
SELECT o_orderpriority, max(o_totalprice) AS max_totalprice
FROM orders GROUP BY o_orderpriority ORDER BY 2
""",
)
def sql_group_order(spark, sf_dir):
    load(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(
        "SELECT o_orderpriority, max(o_totalprice) AS max_totalprice "
        "FROM orders GROUP BY o_orderpriority ORDER BY 2"
    )


@query(
    "keyed_mean",
    sql="""
SELECT l_partkey, round(sum(l_quantity) / count(l_quantity), 6) AS mean_quantity,
       count(l_quantity) AS n
FROM lineitem GROUP BY l_partkey
""",
)
def keyed_mean(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_partkey", "l_quantity")
    out = rel.keyed_mean(li, "l_partkey", "l_quantity", alias="mean_quantity")
    return out.select("l_partkey", F.round("mean_quantity", 6).alias("mean_quantity"), "n")


@query(
    "keyed_max",
    sql="SELECT l_partkey, max(l_extendedprice) AS max_extendedprice FROM lineitem GROUP BY l_partkey",
)
def keyed_max(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_partkey", "l_extendedprice")
    return rel.keyed_max(li, "l_partkey", "l_extendedprice", alias="max_extendedprice")


@query(
    "count_above_mean",
    sql="""
SELECT count(*) FILTER (WHERE l_extendedprice > (SELECT avg(l_extendedprice) FROM lineitem)) AS n_above,
       count(*) AS n_total
FROM lineitem
""",
)
def count_above_mean(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_extendedprice")
    return rel.count_above_mean(li, "l_extendedprice")


@query("preview_limit", sql="SELECT * FROM orders ORDER BY o_orderkey LIMIT 20")
def preview_limit(spark, sf_dir):
    from lodestar.operators.ordering import preview

    return preview(load(spark, sf_dir, "orders"), 20, "o_orderkey")


@query(
    "top_k",
    sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_k(spark, sf_dir):
    from lodestar.operators.ordering import top_k as _top_k

    orders = load(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    return _top_k(orders, 10, "o_totalprice", "o_orderkey")


@query(
    "row_ids",
    sql="SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_id FROM orders",
)
def row_ids(spark, sf_dir):
    from lodestar.operators.ordering import dense_row_ids

    return dense_row_ids(load(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey")


@query(
    "text_lines_upper",
    sql=r"""
SELECT upper(replace(line, 'ß', 'SS')) AS line
FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents)
""",
    note="S1 + P17: documents exported as a text folder, read back one row per line",
)
def text_lines_upper(spark, sf_dir):
    from lodestar.session import scratch_path
    from lodestar.sources import files

    docs = load(spark, sf_dir, "documents", "text")
    path = scratch_path(spark, "documents-text")
    docs.write.mode("overwrite").text(path)
    lines = files.read_text_lines(spark, path)
    return lines.select(F.upper("value").alias("line"))

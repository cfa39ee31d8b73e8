"""Statistics, metrics and token-level text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.fixed import CLASSIFIER_TRAIN_PERCENT
from lodestar.operators import metrics, stats, text
from lodestar.operators.cleanse import deterministic_split
from lodestar.operators.joins import DEFAULT_BROADCAST_ROWS, fits_rows
from lodestar.operators.partitioning import spread
from lodestar.plans.registry import query
from lodestar.session import materialize
from lodestar.sources.tables import load

PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union_sql(template: str, cols) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


@query(
    "profile_mean_std",
    sql=_union_sql(
        "SELECT '{c}' AS \"column\", round(avg({c}), 6) + 0.0 AS mean, round(stddev_samp({c}), 6) + 0.0 AS stddev FROM lineitem",
        PROFILE_COLS,
    ),
)
def profile_mean_std(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", *PROFILE_COLS)
    return stats.profile(li, PROFILE_COLS, digits=6)


@query(
    "standardize",
    sql="SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS z_{c}" for c in PROFILE_COLS
    )
    + " FROM lineitem",
)
def standardize(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", *PROFILE_COLS)
    z = stats.standardize(li, PROFILE_COLS, keep=("l_orderkey", "l_linenumber"))
    return z.select("l_orderkey", "l_linenumber", *[F.round(f"z_{c}", 6).alias(f"z_{c}") for c in PROFILE_COLS])


CORR_COLS = ["l_quantity", "l_discount", "l_tax"]


@query(
    "corr_with_target",
    sql=_union_sql(
        "SELECT '{c}' AS \"column\", round(corr(l_extendedprice, {c}), 6) + 0.0 AS corr FROM lineitem", CORR_COLS
    ),
)
def corr_with_target(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", "l_extendedprice", *CORR_COLS)
    return stats.corr_with_target(li, "l_extendedprice", CORR_COLS, digits=6)


# Query parameter (ours): the rule "long documents are good quality" that is
# scored against the quality labels.
LONG_DOC_CHARS = 1000

_RULE_SQL = f"""
SELECT l.quality AS label, CASE WHEN d.n_chars >= {LONG_DOC_CHARS} THEN 1 ELSE 0 END AS prediction
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""


def _rule_predictions(spark, sf_dir):
    labels = load(spark, sf_dir, "labels", "doc_id", "quality")
    docs = load(spark, sf_dir, "documents", "doc_id", "n_chars")
    return labels.join(docs, "doc_id").select(
        F.col("quality").alias("label"),
        F.when(F.col("n_chars") >= LONG_DOC_CHARS, 1).otherwise(0).alias("prediction"),
    )


@query(
    "confusion_matrix",
    sql=f"SELECT label, prediction, count(*) AS n FROM ({_RULE_SQL}) GROUP BY label, prediction",
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_rule_predictions(spark, sf_dir))


@query(
    "accuracy",
    sql=f"""
WITH a AS (SELECT avg(CAST(label = prediction AS DOUBLE)) AS accuracy, count(*) AS n FROM ({_RULE_SQL}))
SELECT accuracy, CAST(floor(accuracy * 100.0 + 0.5) AS BIGINT) AS accuracy_pct, n FROM a
""",
)
def accuracy(spark, sf_dir):
    return metrics.accuracy(_rule_predictions(spark, sf_dir))


# Word split of the streaming demo: one space, empty words dropped.
@query(
    "word_count",
    sql="""
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations)
WHERE word <> '' GROUP BY word
""",
)
def word_count(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations", "text")
    return text.word_count(spread(conv), "text")


_TOKENS_SQL = (
    "list_filter(regexp_split_to_array(lower({t}), '" + text.WHITESPACE + "'), lambda x: x <> '')"
)


@query(
    "tokenize",
    sql=f"""
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, CAST(len(list_distinct(toks)) AS INTEGER) AS n_distinct
FROM (SELECT doc_id, {_TOKENS_SQL.format(t='text')} AS toks FROM documents)
""",
)
def tokenize(spark, sf_dir):
    docs = spread(load(spark, sf_dir, "documents", "doc_id", "text"))
    toks = text.tokens("text")
    return docs.select("doc_id", F.size(toks).alias("n_tokens"), F.size(F.array_distinct(toks)).alias("n_distinct"))


_TF_SQL = f"""
SELECT doc_id, token, count(*) AS tf
FROM (SELECT doc_id, unnest({_TOKENS_SQL.format(t='text')}) AS token FROM documents)
GROUP BY doc_id, token
"""


@query("term_frequency", sql=_TF_SQL)
def term_frequency(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return text.term_frequency(spread(docs), "doc_id", "text")


@query(
    "tf_idf",
    sql=f"""
WITH tf AS ({_TF_SQL}),
     n AS (SELECT count(*) AS n_docs FROM documents),
     dfq AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
     w AS (SELECT token, ln((n_docs + 1.0) / (df + 1.0)) AS idf FROM dfq, n)
SELECT tf.doc_id, tf.token, tf.tf, round(w.idf, 6) AS idf, round(tf.tf * w.idf, 6) AS tf_idf
FROM tf JOIN w ON tf.token = w.token
""",
)
def tf_idf(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    out = text.tf_idf(spread(docs), "doc_id", "text")
    return out.select("doc_id", "token", "tf", F.round("idf", 6).alias("idf"), F.round("tf_idf", 6).alias("tf_idf"))


def _labels(spark, sf_dir):
    labels = load(spark, sf_dir, "labels", "doc_id", "quality").filter("quality is not null")
    return labels.select("doc_id", F.col("quality").alias("label"),
                         deterministic_split(F.col("doc_id"), CLASSIFIER_TRAIN_PERCENT).alias("split"))


def _labelled_ids(spark, sf_dir):
    """doc_id, label, split of the labelled documents; reads no text."""
    return load(spark, sf_dir, "documents", "doc_id").join(_labels(spark, sf_dir), "doc_id")


def labelled_texts(spark, sf_dir):
    """doc_id, text of the documents that have a label.  While the labels are few
    enough to broadcast, the scan drops all other documents before any work on
    their texts; beyond that they are dropped after their tokens are counted."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    wanted = _labels(spark, sf_dir).select("doc_id").distinct()
    return spread(docs.join(F.broadcast(wanted), "doc_id", "left_semi") if fits_rows(wanted, DEFAULT_BROADCAST_ROWS) else docs)


def _labelled_counts(spark, sf_dir):
    """Token counts of the labelled documents, and their ids.  Tokens are
    counted where the text is read and labels are attached to the counts, so
    the text itself is never shuffled; stored once for all uses."""
    docs = labelled_texts(spark, sf_dir)
    tf = materialize(text.term_frequency(docs, "doc_id", "text").join(_labels(spark, sf_dir), "doc_id"), "nb-tf")
    return tf, _labelled_ids(spark, sf_dir)


@query(
    "naive_bayes_params",
    sql=f"""
WITH ld AS (SELECT d.doc_id, l.quality AS label, d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
     tf AS (SELECT doc_id, label, token, count(*) AS tf
            FROM (SELECT doc_id, label, unnest({_TOKENS_SQL.format(t='text')}) AS token FROM ld)
            GROUP BY doc_id, label, token),
     n AS (SELECT count(*) AS n_docs FROM ld),
     dfq AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
     w AS (SELECT token, ln((n_docs + 1.0) / (df + 1.0)) AS idf FROM dfq, n),
     f AS (SELECT tf.label, tf.token, sum(tf.tf * w.idf) AS f FROM tf JOIN w ON tf.token = w.token GROUP BY tf.label, tf.token),
     fc AS (SELECT label, sum(f) AS fc FROM f GROUP BY label),
     v AS (SELECT count(DISTINCT token) AS v FROM f)
SELECT f.label, f.token, round(ln((f.f + 1.0) / (fc.fc + v.v)), 6) AS log_prob,
       round(ln(1.0 / (fc.fc + v.v)), 6) AS log_prob_unseen
FROM f JOIN fc ON f.label = fc.label, v
""",
)
def naive_bayes_params(spark, sf_dir):
    tf, ids = _labelled_counts(spark, sf_dir)
    params, _ = text.naive_bayes_fit_tf(tf, ids.agg(F.count(F.lit(1))).scalar(), "label")
    return params.select("label", "token", F.round("log_prob", 6).alias("log_prob"),
                         F.round("log_prob_unseen", 6).alias("log_prob_unseen"))


@query(
    "naive_bayes_priors",
    sql="""
WITH c AS (SELECT l.quality AS label, count(*) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1)
SELECT label, round(ln((n + 1.0) / ((SELECT sum(n) FROM c) + (SELECT count(*) FROM c) * 1.0)), 6) AS log_prior FROM c
""",
)
def naive_bayes_priors(spark, sf_dir):
    pri = text.naive_bayes_priors(_labelled_ids(spark, sf_dir), "label")
    return pri.select("label", F.round("log_prior", 6).alias("log_prior"))


NB_TRAIN_PERCENT = CLASSIFIER_TRAIN_PERCENT


def _nb_sql() -> str:
    split = f"(((d.doc_id % 100003 + 100003) % 100003 * 7919 % 100003) % 100 < {NB_TRAIN_PERCENT})"
    toks = _TOKENS_SQL.format(t="text")
    return f"""
WITH ld AS (SELECT d.doc_id, l.quality AS label, d.text, {split} AS is_train
            FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
     tf AS (SELECT doc_id, label, is_train, token, count(*) AS tf
            FROM (SELECT doc_id, label, is_train, unnest({toks}) AS token FROM ld)
            GROUP BY ALL),
     n AS (SELECT count(*) AS n_docs FROM ld WHERE is_train),
     dfq AS (SELECT token, count(*) AS df FROM tf WHERE is_train GROUP BY token),
     w AS (SELECT token, ln((n_docs + 1.0) / (df + 1.0)) AS idf FROM dfq, n),
     f AS (SELECT tf.label, tf.token, sum(tf.tf * w.idf) AS f FROM tf JOIN w ON tf.token = w.token
           WHERE tf.is_train GROUP BY tf.label, tf.token),
     fc AS (SELECT label, sum(f) AS fc FROM f GROUP BY label),
     v AS (SELECT count(*) AS v FROM w),
     theta AS (SELECT f.label, f.token, ln((f.f + 1.0) / (fc.fc + v.v)) AS lp FROM f JOIN fc ON f.label = fc.label, v),
     unseen AS (SELECT fc.label, ln(1.0 / (fc.fc + v.v)) AS lpu FROM fc, v),
     cnt AS (SELECT label, count(*) AS c FROM ld WHERE is_train GROUP BY label),
     pri AS (SELECT label, ln((c + 1.0) / ((SELECT sum(c) FROM cnt) + (SELECT count(*) FROM cnt))) AS lpr FROM cnt),
     test AS (SELECT doc_id, label FROM ld WHERE NOT is_train),
     x AS (SELECT tf.doc_id, tf.token, tf.tf * w.idf AS x FROM tf JOIN w ON tf.token = w.token WHERE NOT tf.is_train),
     cls AS (SELECT pri.label AS c, pri.lpr, unseen.lpu FROM pri JOIN unseen ON pri.label = unseen.label),
     xs AS (SELECT x.doc_id, cls.c, sum(x.x * coalesce(th.lp, cls.lpu)) AS v
            FROM x CROSS JOIN cls LEFT JOIN theta th ON th.token = x.token AND th.label = cls.c
            GROUP BY x.doc_id, cls.c),
     sc AS (SELECT t.doc_id, cls.c, cls.lpr + coalesce(xs.v, 0.0) AS s
            FROM test t CROSS JOIN cls LEFT JOIN xs ON xs.doc_id = t.doc_id AND xs.c = cls.c)
SELECT t.doc_id, t.label, first(sc.c ORDER BY sc.s DESC, sc.c) AS prediction
FROM test t JOIN sc ON t.doc_id = sc.doc_id
GROUP BY t.doc_id, t.label
"""


@query("naive_bayes_predict", sql=_nb_sql(),
       note="M8/M9 end to end: TF-IDF + Naive Bayes trained and applied as joins and aggregations")
def naive_bayes_predict(spark, sf_dir):
    tf, ids = _labelled_counts(spark, sf_dir)
    train_docs, test_docs = ids.filter("split = 'train'"), ids.filter("split = 'test'")
    vocab, priors = text.naive_bayes_model(tf.filter("split = 'train'"), train_docs, "label")
    pred = text.naive_bayes_predict(tf.filter("split = 'test'"), test_docs, "doc_id", vocab, priors, "label")
    return test_docs.select("doc_id", "label").join(pred, "doc_id")


@query(
    "naive_bayes_accuracy",
    sql=f"""
WITH p AS ({_nb_sql()}),
     a AS (SELECT avg(CAST(label = prediction AS DOUBLE)) AS accuracy, count(*) AS n FROM p)
SELECT accuracy, CAST(floor(accuracy * 100.0 + 0.5) AS BIGINT) AS accuracy_pct, n FROM a
""",
    note="M17 on the trained model: accuracy of naive_bayes_predict on the test split",
)
def naive_bayes_accuracy(spark, sf_dir):
    return metrics.accuracy(naive_bayes_predict(spark, sf_dir))
